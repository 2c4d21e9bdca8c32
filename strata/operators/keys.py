"""Scale-safe global numbering: dense surrogate keys, global RANK and NTILE.

A plain ``Window.orderBy(...)`` without ``partitionBy`` moves every row into
one task (``Exchange SinglePartition``).  These operators instead

1. range-partition on the ordering (``repartitionByRange``) and sort inside
   each partition,
2. number rows locally (``monotonically_increasing_id`` keeps the in-partition
   order), materialise that once with a reliable ``checkpoint`` so the
   partition layout can not change between the two passes below,
3. count rows per partition (one number per partition), turn the counts
   into offsets and add them back as a literal array indexed by partition.

Global RANK with heavy ties is computed on the *distinct* ordering values
(pre-aggregated with a map-side combine), so a value shared by a third of
all rows costs one row, not one task; ranks are joined back on the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, publish_once

_PID, _MID, _LOC, _OFF, _TOT = "_k_pid", "_k_mid", "_k_loc", "_k_off", "_k_tot"


def prefix_positions(df: DataFrame, order: list[Column], weight: str | None = None) -> DataFrame:
    """Add ``_k_off`` = exclusive global prefix sum of ``weight`` (1 per row when
    None) in ``order``, and ``_k_tot`` = grand total.  ``order`` must be a
    total order (include a unique tie-breaker) for a deterministic result."""
    ensure_checkpoint_dir(df.sparkSession)
    # No explicit partition count: with AQE the range partitions are sized to
    # the data (coalesced partitions are contiguous ranges, so the global
    # order survives); the ids written below are what the offsets refer to.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id())
    tagged = publish_once(tagged)
    if weight is None:
        local = tagged.withColumn(_LOC, F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33))
        w = F.lit(1).cast("bigint")
    else:
        wcol = F.col(weight).cast("bigint")
        local = tagged.withColumn(
            _LOC,
            F.coalesce(F.sum(wcol).over(Window.partitionBy(_PID).orderBy(_MID)
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint"))
        w = wcol
    # One count per partition: bounded by the partition count, not by the
    # data, so it is read as a small list and applied as a literal array.
    counts = {int(r[0]): int(r[1] or 0) for r in tagged.groupBy(_PID).agg(F.sum(w)).collect()}
    n_parts = (max(counts) + 1) if counts else 1
    offsets, run = [], 0
    for pid in range(n_parts):
        offsets.append(run)
        run += counts.get(pid, 0)
    # One text literal, folded once into an array: no expression per partition.
    listed = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    base = F.element_at(listed, F.col(_PID) + 1)
    out = local.withColumn(_OFF, base + F.col(_LOC)).withColumn(_TOT, F.lit(run).cast("bigint"))
    return out.drop(_LOC, _PID, _MID)


def assign_keys(df: DataFrame, order: list[Column], name: str, start=0) -> DataFrame:
    """Dense 1-based keys in ``order`` starting after ``start`` (a number or a
    Column such as the max key already used).  DM6 / ROW_NUMBER() global."""
    s = start if isinstance(start, Column) else F.lit(start)
    out = prefix_positions(df, order)
    return out.withColumn(name, (s + F.col(_OFF) + 1).cast("bigint")).drop(_OFF, _TOT)


def sort_exprs(spec: list[tuple[str, str]]) -> list[Column]:
    """[(column, 'asc'|'desc')] -> sort expressions with NULLs last (the
    warehouse puts NULL last in both directions for every rank we build)."""
    out = []
    for c, d in spec:
        out.append(F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last())
    return out


def global_rank(df: DataFrame, spec: list[tuple[str, str]], name: str, unique_key: str | None = None) -> DataFrame:
    """RANK() OVER (ORDER BY spec) without a single-partition exchange.

    With ``unique_key`` (one row per key, e.g. one row per product) the rows
    are numbered once over ``spec + key`` -- a single materialisation of the
    input -- and every row takes the first position of its tie group, read
    from that same checkpoint.  Without it, ties are counted on the distinct
    ordering values (partial aggregation) and joined back."""
    cols = [c for c, _ in spec]
    if unique_key is not None:
        numbered = prefix_positions(df, sort_exprs(spec) + [F.col(unique_key).asc_nulls_last()])
        firsts = numbered.groupBy(*cols).agg(F.min(_OFF).alias("_k_first"))
        firsts = firsts.select(*[F.col(c).alias(f"_k_r_{c}") for c in cols], "_k_first")
        cond = None
        for c in cols:
            e = F.col(c).eqNullSafe(F.col(f"_k_r_{c}"))
            cond = e if cond is None else cond & e
        out = numbered.join(firsts, cond, "left")
        return (out.withColumn(name, (F.col("_k_first") + 1).cast("bigint"))
                   .drop("_k_first", _OFF, _TOT, *[f"_k_r_{c}" for c in cols]))
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_k_cnt"))
    ranked = prefix_positions(distinct, sort_exprs(spec), weight="_k_cnt")
    ranked = ranked.select(*[F.col(c).alias(f"_k_r_{c}") for c in cols],
                           (F.col(_OFF) + 1).cast("bigint").alias(name))
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_k_r_{c}"))
        cond = e if cond is None else cond & e
    return df.join(ranked, cond, "left").drop(*[f"_k_r_{c}" for c in cols])


def global_ntile(df: DataFrame, n: int, order: list[Column], name: str) -> DataFrame:
    """NTILE(n) OVER (ORDER BY order); ``order`` must be total (unique tie-break)."""
    out = prefix_positions(df, order)
    rn = F.col(_OFF) + 1
    total = F.col(_TOT)
    q = F.floor(total / n)
    r = total - q * n
    big = r * (q + 1)
    tile = F.when(rn <= big, F.ceil(rn / (q + 1))).otherwise(
        r + F.ceil((rn - big) / F.greatest(q, F.lit(1))))
    return out.withColumn(name, tile.cast("bigint")).drop(_OFF, _TOT)


def global_positions(df: DataFrame, key: str, ranks: dict[str, tuple[str, str]] | None = None,
                     ntiles: dict[str, tuple[int, str, str]] | None = None) -> DataFrame:
    """Several RANK() and NTILE(n) over a whole table with one sort.

    ``ranks``: name -> (column, 'asc' | 'desc'); ``ntiles``: name -> (n, column, direction), whose ties go by
    ``key`` (one row each).  NULLs sort last.  The input is written once as it is; what is sorted are
    rows (measure, value, key), all measures in one range partitioning.  Every measure has a row for each key, so
    a position inside its measure is the global one less whole measures."""
    ranks, ntiles = ranks or {}, ntiles or {}
    wanted = {**{n: (c, d) for n, (c, d) in ranks.items()}, **{n: (c, d) for n, (_, c, d) in ntiles.items()}}
    measures = list(dict.fromkeys(wanted.values()))
    df = publish_once(df)

    def entry(i: int, c: str, direction: str) -> Column:
        sign = -1 if direction == "desc" else 1
        real = dict(df.dtypes)[c] in ("double", "float")
        value = F.col(c) * sign + F.lit(0.0) if real else F.col(c).cast("decimal(38,8)") * sign
        none = F.lit(None)
        return F.struct(F.lit(i).alias("_m"), F.col(c).isNull().alias("_null"), (value if real else none).cast("double").alias("_real"),
                        (none if real else value).cast("decimal(38,8)").alias("_exact"))

    long = df.select(F.col(key).alias("_key"), F.explode(F.array(*[entry(i, c, d) for i, (c, d) in enumerate(measures)])).alias("_e")).select("_key", "_e.*")
    value = ["_m", "_null", "_real", "_exact"]
    numbered = prefix_positions(long, [*(F.col(c).asc_nulls_first() for c in value), F.col("_key").asc_nulls_last()])
    rows = F.col(_TOT) / len(measures)
    numbered = numbered.withColumn("_n", rows.cast("bigint")).withColumn("_at", (F.col(_OFF) - F.col("_m") * F.col("_n")).cast("bigint"))
    if ranks:
        firsts = numbered.groupBy(*value).agg(F.min("_at").alias("_first")).select(*[F.col(c).alias(f"_f{c}") for c in value], "_first")
        same = F.col("_m") == F.col("_f_m")
        for c in value[1:]:
            same = same & F.col(c).eqNullSafe(F.col(f"_f{c}"))
        numbered = numbered.join(firsts, same)
    at = lambda name, c: F.max(F.when(F.col("_m") == measures.index(wanted[name]), F.col(c)))
    wide = numbered.groupBy("_key").agg(*[(at(n, "_first") + 1).cast("bigint").alias(n) for n in ranks],
                                        *[at(n, "_at").alias(n) for n in ntiles], F.max("_n").alias("_n"))
    out = df.join(wide, df[key].eqNullSafe(wide["_key"]))
    for n, (tiles, _, _) in ntiles.items():
        q, rn = F.floor(F.col("_n") / tiles), F.col(n) + 1
        r = F.col("_n") - q * tiles
        big = r * (q + 1)
        out = out.withColumn(n, F.when(rn <= big, F.ceil(rn / (q + 1))).otherwise(r + F.ceil((rn - big) / F.greatest(q, F.lit(1)))).cast("bigint"))
    return out.select(*df.columns, *ranks, *ntiles)
