"""Silver load patterns as DataFrame -> DataFrame operators.

Plain parquet tables reject MERGE/UPDATE/DELETE, so every upsert is expressed
as a keyed join that produces the *next version* of the table; the caller
writes it to a new version folder (``strata.sources.sinks``).

Skew: ``latest_per_key`` uses a grouped ``max(struct(...))`` which Spark
pre-aggregates map-side, so a key holding a third of all rows is reduced in
every map task before the shuffle (a ``row_number`` window would sort that
whole key in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.compat import lit_ts
from strata.operators.keys import assign_keys

END_OF_TIME = "9999-12-31 00:00:00"


def max_key(target: DataFrame, sk: str) -> int:
    """Largest surrogate key already used (one scalar; 0 for an empty table)."""
    v = target.agg(F.max(sk)).first()[0]
    return int(v) if v is not None else 0


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """SV8: keep rows whose typed key values are all present."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def split_required(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """SV8 / IN8: (rows with all keys, quarantined rows without)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond), df.filter(~cond)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """SV1: one row per key -- the row that is greatest on ``order_by``
    (lexicographic, all descending: latest load first, then tie-breakers).
    NULL order values lose against any value.  ``order_by`` should end in
    enough tie-breakers to make the winner unique."""
    # Each column is packed once: an ordering column of the payload keeps its name.
    payload_cols = [c for c in df.columns if c not in keys]
    order_cols, named = [], []
    for i, o in enumerate(order_by):
        if not isinstance(o, str):
            order_cols.append(o.alias(f"_lp_o{i}"))
        elif o not in named:
            named.append(o)
            order_cols.append(F.col(o))
    packed = F.struct(*order_cols, *[F.col(c) for c in payload_cols if c not in named])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_lp_w"))
    return best.select(*keys, *[F.col(f"_lp_w.{c}").alias(c) for c in payload_cols]).select(*df.columns)


def append(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """SV5: plain append."""
    return source if target is None else target.unionByName(source)


def insert_if_absent(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """SV4: rows of ``source`` whose key is not in ``target`` (left anti join)
    are appended.  ``source`` should already be one row per key."""
    if target is None:
        return source
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def replace_partition(target: DataFrame | None, fresh: DataFrame, part_col: str) -> DataFrame:
    """SV6 / DM4: delete the partitions present in ``fresh`` and insert it
    (the DataFrame form of dynamic partition overwrite)."""
    if target is None:
        return fresh
    parts = fresh.select(part_col).distinct()
    kept = target.join(parts, part_col, "left_anti")
    return kept.unionByName(fresh)


def full_refresh(df: DataFrame) -> DataFrame:
    """SV7 / DM5 TRUNCATE+INSERT: the new table is the query result."""
    return df


def scd1_upsert(target: DataFrame | None, source: DataFrame, keys: list[str], sk: str,
                update_cols: list[str], run_ts, sk_order: list[Column] | None = None,
                created_col: str = "dw_created_at", updated_col: str = "dw_updated_at", top: int | None = None) -> DataFrame:
    """SV2 (MERGE ... WHEN MATCHED UPDATE chosen columns / NOT MATCHED INSERT).

    ``source`` holds one row per key with the target's business columns
    (no ``sk``/audit columns).  Matched rows take ``update_cols`` from the
    source; new keys get dense surrogate keys after the current maximum, or after ``top``
    where ``target`` is only a part of its table."""
    ts = lit_ts(run_ts)
    order = sk_order or [F.col(k).asc() for k in keys]
    if target is None:
        keyed = assign_keys(source, order, sk, start=top or 0)
        return keyed.withColumn(created_col, ts).withColumn(updated_col, ts)
    biz = [c for c in source.columns if c not in keys]
    # matched / untouched target rows: target LEFT JOIN source
    s = source.withColumn("_s_present", F.lit(True))
    j = target.alias("t").join(s.alias("s"), keys, "left")
    in_s = F.col("s._s_present").isNotNull()
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in update_cols:
            cols.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c == updated_col:
            cols.append(F.when(in_s, ts).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    existing = j.select(*cols)
    # new keys: source LEFT ANTI target, keys continue after the current maximum
    fresh = source.join(target.select(*keys), keys, "left_anti")
    fresh = assign_keys(fresh, order, sk, start=max_key(target, sk) if top is None else top)
    fresh = fresh.withColumn(created_col, ts).withColumn(updated_col, ts)
    return existing.unionByName(fresh.select(*existing.columns))


def scd2_upsert(target: DataFrame | None, source: DataFrame, keys: list[str], sk: str,
                tracked: list[str], run_ts, atomic: bool = True,
                sk_order: list[Column] | None = None,
                created_col: str = "dw_created_at", updated_col: str = "dw_updated_at") -> DataFrame:
    """SV3 type-2 history.

    * current row whose tracked columns changed (null-safe compare) -> closed:
      ``is_current=false, effective_to=run_ts``;
    * ``atomic=True``: the new version is inserted in the same run with
      ``effective_from=run_ts`` (``atomic=False`` reproduces the two-run
      behaviour: the new version appears on the next run, when no current row
      matches any more);
    * keys without a current row are inserted as current;
    * history rows are carried over untouched (append-only).
    """
    ts = lit_ts(run_ts)
    eot = lit_ts(END_OF_TIME)
    order = sk_order or [F.col(k).asc() for k in keys]

    def versions(df: DataFrame) -> DataFrame:
        return (df.withColumn("effective_from", ts).withColumn("effective_to", eot)
                  .withColumn("is_current", F.lit(True))
                  .withColumn(created_col, ts).withColumn(updated_col, ts))

    if target is None:
        return assign_keys(versions(source), order, sk)

    cur = target.filter(F.col("is_current"))
    hist = target.filter(~F.col("is_current"))
    s = source.withColumn("_s_present", F.lit(True))
    j = cur.alias("t").join(s.alias("s"), keys, "full_outer")
    in_t = F.col(f"t.{sk}").isNotNull()
    in_s = F.col("s._s_present").isNotNull()
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    j = j.withColumn("_in_t", in_t).withColumn("_in_s", in_s).withColumn("_chg", in_t & in_s & changed)

    tcols = [c for c in target.columns]
    # current rows, possibly closed
    kept = j.filter("_in_t").select(*[
        (F.when(F.col("_chg"), F.lit(False)).otherwise(F.col("t.is_current")).alias(c) if c == "is_current"
         else F.when(F.col("_chg"), ts).otherwise(F.col("t.effective_to")).alias(c) if c == "effective_to"
         else F.when(F.col("_chg"), ts).otherwise(F.col(f"t.{updated_col}")).alias(c) if c == updated_col
         else (F.col(c) if c in keys else F.col(f"t.{c}")).alias(c))
        for c in tcols])
    new_cond = ~F.col("_in_t") & F.col("_in_s")
    if atomic:
        new_cond = new_cond | F.col("_chg")
    src_cols = [c for c in source.columns]
    fresh = j.filter(new_cond).select(*[(F.col(c) if c in keys else F.col(f"s.{c}")).alias(c) for c in src_cols])
    fresh = versions(fresh)
    fresh = assign_keys(fresh, order, sk, start=max_key(target, sk))
    return hist.unionByName(kept).unionByName(fresh.select(*tcols))
