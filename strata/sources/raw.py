"""Raw landing layer: files -> (lifted keys, variant payload, lineage, batch).

Readers keep the whole record as a ``VARIANT`` so that schema drift in a feed
never fails the load; typing happens in silver with ``try_variant_get``.
Bad records are *quarantined* (returned separately) instead of silently
skipped (``ON_ERROR = CONTINUE``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.compat import lit_ts
from strata.session import materialize

# Fixed values of the landing contract: null tokens per format.
JSON_NULL_TOKENS = ["", "null", "NULL"]
CSV_NULL_TOKENS = ["", "NULL", "N/A"]

ENVELOPE = ["payload", "file_name", "file_row_number", "load_timestamp", "batch_id"]


@dataclass(frozen=True)
class Stage:
    """A named landing location with its default file format (IN4)."""
    path: str
    fmt: str


def STAGES(root: str) -> dict[str, Stage]:
    """Landing locations under ``root`` (one sub-folder per entity avoids the
    cross-entity leakage of a shared location)."""
    return {
        "customers": Stage(f"{root}/customers", "csv"),
        "orders": Stage(f"{root}/orders", "json"),
        "products": Stage(f"{root}/products", "csv"),
        "inventory": Stage(f"{root}/inventory", "parquet"),
        "events": Stage(f"{root}/events", "json"),
    }


@dataclass(frozen=True)
class Source:
    name: str
    fmt: str
    keys: dict          # lifted key column -> JSON path
    refresh: str        # full_daily | full_weekly | 15min | 30min | hourly | daily | realtime
    streaming: bool = False


# IN11 source catalog: format, lifted keys and refresh mode per feed.
SOURCES: dict[str, Source] = {s.name: s for s in [
    Source("customers", "json", {"src_customer_id": "$.customer_id"}, "full_daily"),
    Source("orders", "json", {"src_order_id": "$.order_id"}, "15min"),
    Source("order_items", "json", {"src_order_id": "$.order_id", "src_item_id": "$.item_id"}, "15min"),
    Source("products", "json", {"src_product_id": "$.product_id"}, "full_daily"),
    Source("categories", "json", {"src_category_id": "$.category_id"}, "full_weekly"),
    Source("suppliers", "parquet", {"src_supplier_id": "$.supplier_id"}, "full_weekly"),
    Source("inventory", "parquet", {"src_product_id": "$.product_id", "src_location_id": "$.location_id"}, "hourly"),
    Source("payments", "json", {"src_payment_id": "$.payment_id", "src_order_id": "$.order_id"}, "realtime", True),
    Source("returns", "json", {"src_return_id": "$.return_id", "src_order_id": "$.order_id"}, "daily"),
    Source("reviews", "json", {"src_review_id": "$.review_id", "src_product_id": "$.product_id"}, "daily"),
    Source("employees", "csv", {"src_employee_id": "$.employee_id"}, "full_daily"),
    Source("stores", "csv", {"src_store_id": "$.store_id"}, "full_weekly"),
    Source("promotions", "json", {"src_promotion_id": "$.promotion_id"}, "full_daily"),
    Source("campaigns", "json", {"src_campaign_id": "$.campaign_id"}, "daily"),
    Source("web_sessions", "json", {"src_session_id": "$.session_id"}, "realtime", True),
    Source("page_views", "json", {"src_session_id": "$.session_id", "src_page_url": "$.page_url"}, "realtime", True),
    Source("cart_events", "json", {"src_session_id": "$.session_id", "src_customer_id": "$.customer_id",
                                   "event_type": "$.event_type"}, "realtime", True),
    Source("shipments", "json", {"src_shipment_id": "$.shipment_id", "src_order_id": "$.order_id"}, "hourly"),
    Source("addresses", "json", {"src_address_id": "$.address_id", "src_customer_id": "$.customer_id"}, "daily"),
    Source("loyalty_points", "json", {"src_transaction_id": "$.transaction_id",
                                      "src_customer_id": "$.customer_id"}, "30min"),
]}


def read_json_raw(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """IN1: JSON lines (a line may hold an array of records), or with ``multi_line`` files of one
    value each, arrays over many lines included -> one variant per record.
    Unparseable lines keep their text in ``_corrupt_record`` and a null payload."""
    return with_lineage(json_records(spark.read, path, multi_line))


def json_records(reader, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """The records of JSON files, by a batch or a streaming reader; arrays are taken apart in the same
    pass, and an empty one has no record."""
    df = (reader.schema("payload variant, _corrupt_record string")
          .option("singleVariantColumn", "payload")
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .option("multiLine", multi_line)
          .json(path))
    items = F.coalesce(F.try_variant_get("payload", "$", "array<variant>"), F.array("payload"))
    return df.select(F.explode(items).alias("payload"), "_corrupt_record", F.col("_metadata.file_path").alias("file_name"),
                     F.col("_metadata.file_block_start").alias("_block"))


def read_csv_raw(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """IN2: header CSV, optional double quotes, null tokens -> variant payload."""
    r = spark.read.option("header", True).option("quote", '"').option("mode", "PERMISSIVE")
    fields = (r.schema(schema).csv(path) if schema else r.csv(path)).columns
    typed = schema or ", ".join(f"`{c}` string" for c in fields)
    # rows with too many or too few fields keep their text for the quarantine
    df = r.option("columnNameOfCorruptRecord", "_corrupt_record").schema(f"{typed}, _corrupt_record string").csv(path)
    cols = [F.when(F.col(f"`{c}`").isin(*CSV_NULL_TOKENS), None).otherwise(F.col(f"`{c}`")).alias(c) for c in fields]
    out = df.select(F.to_variant_object(F.struct(*cols)).alias("payload"), "_corrupt_record",
                    F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("_block"))
    return with_lineage(out)


def read_parquet_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """IN3: parquet -> variant payload; exact file row number from the reader."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    out = df.select(F.to_variant_object(F.struct(*[F.col(c) for c in df.columns])).alias("payload"),
                    F.lit(None).cast("string").alias("_corrupt_record"),
                    F.col("_metadata.file_path").alias("file_name"),
                    F.col("_metadata.row_index").alias("file_row_number"))
    return out


def with_lineage(df: DataFrame) -> DataFrame:
    """IN6: ``file_row_number`` of records that carry ``file_name`` and ``_block``, the start of the
    file block they were read in: numbered from 0 in a file, as the Parquet reader does, bad
    records included.

    Row ids rise within a block wherever it is read.  The rows are written once with their ids, so
    numbers and rows come from the same reading; then one row a block (its first id and its size)
    gives each block the number it starts at."""
    rows = materialize(df.withColumn("_at", F.monotonically_increasing_id()))
    blocks = rows.groupBy("file_name", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.select("file_name", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    others = [c for c in df.columns if c not in ("_block", "file_row_number")]
    return rows.join(shift, ["file_name", "_block"]).select(*others, (F.col("_at") + F.col("_shift")).alias("file_row_number"))


def with_batch(df: DataFrame, batch_id: str | None, run_ts) -> DataFrame:
    """IN7: load stamp and batch id (streams leave ``batch_id`` NULL)."""
    return (df.withColumn("load_timestamp", lit_ts(run_ts))
              .withColumn("batch_id", F.lit(batch_id).cast("string")))


def lift_keys(df: DataFrame, keys: dict) -> DataFrame:
    """IN5: ``PAYLOAD:field::VARCHAR`` -> typed key columns, soft cast."""
    for name, path in keys.items():
        v = F.try_variant_get("payload", path, "string")
        df = df.withColumn(name, F.when(~v.isin(*JSON_NULL_TOKENS), v))
    return df


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """IN8: (good records, quarantine).  A record is bad when it did not parse."""
    bad = F.col("payload").isNull() | F.col("_corrupt_record").isNotNull()
    return df.filter(~bad).drop("_corrupt_record"), df.filter(bad)


#: Readers by format; each takes a path or a list of paths.
READERS = {"json": read_json_raw, "csv": read_csv_raw, "parquet": read_parquet_raw}


def land(spark: SparkSession, source: str, path: str, batch_id: str | None, run_ts,
         already_loaded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Read one feed into the raw envelope -> (raw rows, quarantine).

    IN10: files already present in ``already_loaded`` (the landed table) are
    skipped by an anti join on ``file_name``, which holds the whole path (dated
    folders repeat base names)."""
    src = SOURCES[source]
    df = READERS[src.fmt](spark, path)
    if already_loaded is not None:
        df = df.join(already_loaded.select("file_name").distinct(), "file_name", "left_anti")
    good, bad = split_bad(df)
    good = with_batch(lift_keys(good, src.keys), None if src.streaming else batch_id, run_ts)
    return good.select(*src.keys.keys(), *ENVELOPE), bad
