"""DM2 / SV2: tables in hash buckets of their key, merged bucket by bucket.

A table is ``buckets`` sets of files, dealt by a hash of the key.  A merge finds the buckets that
its batch touches, reads and rewrites those alone, and leaves the files of all others as they are:
the work follows the batch, not the table.

Files are never changed in place.  A merge writes the touched buckets to a folder of its own, then adds
a numbered manifest (one row a bucket: the folder its files are in, and the largest surrogate key so
far).  Readers use the newest manifest, so they see the table before or after a merge, never
between; a merge that fails or is replayed before its manifest is written leaves nothing visible, and
one that is replayed afterwards (same ``version``) is skipped.

The driver holds a manifest (one row a bucket, a fixed number for a table) and no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class Manifest:
    """Where each bucket's files are: {bucket: version}, the last merge's version, the table's
    number of buckets and its largest surrogate key."""

    def __init__(self, number: int = 0, version: str | None = None, places: dict[int, str] | None = None, buckets: int = 0, top: int = 0):
        self.number, self.version, self.places, self.buckets, self.top = number, version, places or {}, buckets, top


def manifest(spark: SparkSession, base: str, table: str) -> Manifest | None:
    """The newest manifest, None before the first merge."""
    schema = "bucket int, place string, version string, buckets int, top long, n long"
    try:
        rows = spark.read.schema(schema).parquet(f"{_root(base, table)}/_manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    n = rows.agg(F.max("n")).first()[0]
    found = rows.where(F.col("n") == n).collect()
    first = found[0]
    return Manifest(n, first["version"], {r["bucket"]: r["place"] for r in found if r["bucket"] is not None}, first["buckets"], first["top"])


def _root(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def _read(spark: SparkSession, base: str, table: str, places: dict[int, str]) -> DataFrame | None:
    if not places:
        return None
    root = _root(base, table)
    return spark.read.option("basePath", root).parquet(*[f"{root}/{place}/{BUCKET}={b}" for b, place in sorted(places.items())])


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(BUCKET, "_version")


def read(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The whole table (None before the first merge)."""
    now = manifest(spark, base, table)
    found = _read(spark, base, table, now.places) if now else None
    return None if found is None else _plain(found)


def merge(batch: DataFrame, base: str, table: str, keys: list[str], sk: str, job: Callable[[DataFrame, DataFrame | None, int], DataFrame],
          version: str, buckets: int = 64) -> list[int]:
    """Merge ``batch`` (one row a key) into the table; returns the touched buckets.

    ``job(source, target, top)`` makes the new rows of some buckets from the batch's rows and
    the buckets' old ones (None if they have none); new surrogate keys start after ``top``, the
    largest of the whole table.  ``buckets`` is fixed when the table is first written."""
    spark = batch.sparkSession
    now = manifest(spark, base, table)
    if now and now.version == version:
        return []
    now = now or Manifest(buckets=buckets)
    dealt = bucket_of(keys, now.buckets)
    touched = sorted(r[0] for r in batch.select(dealt.alias("b")).distinct().collect())  # at most one number a bucket
    place = f"_version={version}"
    if touched:
        old = _read(spark, base, table, {b: now.places[b] for b in touched if b in now.places})
        new = job(batch, None if old is None else _plain(old), now.top).withColumn(BUCKET, dealt)
        # one task a bucket: a merge adds one file to each, whatever the number of tasks before
        path = f"{_root(base, table)}/{place}"
        new.repartition(len(touched), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        written = spark.read.option("basePath", path).parquet(path)
        now.top = max(now.top, written.agg(F.max(sk)).first()[0] or 0)
        now.places |= {b: place for b in touched}
    rows = [(b, p, version, now.buckets, now.top) for b, p in sorted(now.places.items())] or [(None, None, version, now.buckets, now.top)]
    (spark.createDataFrame(rows, "bucket int, place string, version string, buckets int, top long").coalesce(1)
     .write.mode("overwrite").parquet(f"{_root(base, table)}/_manifest/n={now.number + 1}"))
    return touched


def changed(spark: SparkSession, base: str, table: str, keys: list[str], before: Manifest | None, after: Manifest,
            columns: list[str]) -> DataFrame | None:
    """Rows (keys, old, new) whose ``columns`` differ between two states of the table, ``old`` and
    ``new`` being structs of the columns (null where the row is missing).  Only buckets whose files
    differ are read; None if none do."""
    had = before.places if before else {}
    differ = [b for b, p in after.places.items() if had.get(b) != p]
    new = _read(spark, base, table, {b: after.places[b] for b in differ})
    if new is None:
        return None
    new = new.select(*keys, F.struct(*columns).alias("new"))
    old = _read(spark, base, table, {b: had[b] for b in differ if b in had})
    if old is None:
        return new.select(*keys, F.lit(None).cast(new.schema["new"].dataType).alias("old"), "new")
    return old.select(*keys, F.struct(*columns).alias("old")).join(new, keys, "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, "old", "new")
