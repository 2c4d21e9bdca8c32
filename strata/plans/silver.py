"""Silver jobs S01-S20: typed, cleaned, deduplicated, upserted tables.

Each job reads raw envelope rows (variant payload), extracts typed fields
with soft casts, applies the cleaning rules, keeps the latest version per key
(SV1) and upserts it into the previous version of the table (SV2-SV7).
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.compat import lit_date, lit_ts, money, money4
from strata.operators.keys import assign_keys, global_positions
from strata.sources.raw import JSON_NULL_TOKENS
from strata.operators.load import (
    max_key, latest_per_key, replace_partition, require_keys, scd1_upsert, scd2_upsert,
)


# ------------------------------------------------------------------ extraction
# Every job extracts the payload fields it uses in ONE variant pass: the
# helpers below register the field they read, and ``_select`` turns the
# registered names into a single ``try_variant_get(payload, '$', struct<...>)``
# (all fields as text, as ``PAYLOAD:f::VARCHAR``) before projecting.  The
# typed helpers then apply the warehouse's soft casts to that text.
_LOCAL = threading.local()   # per thread, so concurrent builds do not mix fields


def _requested() -> set:
    if not hasattr(_LOCAL, "fields"):
        _LOCAL.fields = set()
    return _LOCAL.fields


def _text(path: str) -> Column:
    _requested().add(path)
    return F.col("_p").getField(path)


def _select(raw: DataFrame, *cols: Column) -> DataFrame:
    fields = sorted(_requested())
    _requested().clear()
    schema = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    # As a generator's row, not a projected column: a projection is repeated in every filter on a
    # typed column that is pushed below it, and the payload would be built and parsed again for each.
    once = F.explode(F.array(F.try_variant_get("payload", "$", schema))).alias("_p")
    return raw.select("*", once).select(*cols)


def vs(path: str) -> Column:
    """PAYLOAD:path::VARCHAR (soft); the landing format's null tokens
    ('', 'null', 'NULL') read as SQL NULL (IN1)."""
    v = _text(path)
    return F.when(~v.isin(*JSON_NULL_TOKENS), v)


def vnum(path: str) -> Column:
    """TRY_TO_NUMBER(text): a whole number rounded half away from zero
    ('1.5' -> 2, 2.5 -> 3); unparseable text -> NULL.  Text of a whole number needs no decimal."""
    t = _text(path)
    return F.coalesce(t.try_cast("bigint"), t.try_cast("decimal(38,0)").try_cast("bigint"))


def vdbl(path: str) -> Column:
    """TRY_TO_DOUBLE(text)."""
    return _text(path).try_cast("double")


def vbool(path: str) -> Column:
    """PAYLOAD:path::BOOLEAN, soft (unparseable text -> NULL)."""
    return _text(path).try_cast("boolean")


def vmoney(path: str, to=money, default: float | None = None) -> Column:
    """``to(TRY_TO_DOUBLE(text))``, a missing one read as ``default``.  Up to 15 digits without an exponent a double
    keeps every digit, so such text is read as the decimal that it is, which is cheaper."""
    t, via = _text(path), vdbl(path)
    short = (F.octet_length(t) <= 15) & (F.octet_length(t) == F.length(t)) & ~t.contains("e") & ~t.contains("E")
    return F.coalesce(F.when(short, t.try_cast({money: "decimal(18,2)", money4: "decimal(18,4)"}[to])),
                      to(via if default is None else F.coalesce(via, F.lit(default))))


def vdate(path: str) -> Column:
    """TRY_TO_DATE(text) with the ISO format.  Text that is a date's own has no need of the pattern."""
    t = _text(path)
    plain = t.try_cast("date")
    return F.coalesce(F.when((F.length(t) == 10) & (plain.cast("string") == t), plain),
                      F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date"))


def vts(path: str) -> Column:
    """TRY_TO_TIMESTAMP_NTZ(text)."""
    return _text(path).try_cast("timestamp_ntz")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9+]", "")


def _latest(src: DataFrame, keys: list[str], *tie: str) -> DataFrame:
    src = require_keys(src, keys)
    return latest_per_key(src, keys, ["src_load_timestamp", *tie])


# ------------------------------------------------------------------ S01 customers
CUSTOMER_TRACKED = ["email", "phone", "customer_tier", "is_active"]


def customers_src(raw: DataFrame) -> DataFrame:
    return _select(
        raw,
        vs("customer_id").alias("customer_id"),
        F.trim(vs("first_name")).alias("first_name"),
        F.trim(vs("last_name")).alias("last_name"),
        F.concat(F.trim(vs("first_name")), F.lit(" "), F.trim(vs("last_name"))).alias("full_name"),
        F.lower(F.trim(vs("email"))).alias("email"),
        digits(vs("phone")).alias("phone"),
        vdate("date_of_birth").alias("date_of_birth"),
        F.upper(vs("gender")).alias("gender"),
        F.coalesce(F.upper(vs("tier")), F.lit("BRONZE")).alias("customer_tier"),
        vdate("registration_date").alias("registration_date"),
        vbool("is_active").alias("is_active"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )


def s01_customers(raw: DataFrame, target: DataFrame | None, run_ts, atomic: bool = True) -> DataFrame:
    src = _latest(customers_src(raw), ["customer_id"])
    return scd2_upsert(target, src, ["customer_id"], "customer_sk", CUSTOMER_TRACKED, run_ts, atomic=atomic)


# ------------------------------------------------------------------ S02 orders
def orders_src(raw: DataFrame) -> DataFrame:
    return _select(
        raw,
        vs("order_id").alias("order_id"),
        vs("customer_id").alias("customer_id"),
        vs("store_id").alias("store_id"),
        vdate("order_date").alias("order_date"),
        vts("order_timestamp").alias("order_timestamp"),
        F.upper(vs("status")).alias("order_status"),
        F.upper(F.coalesce(vs("channel"), F.lit("WEB"))).alias("channel"),
        F.coalesce(vs("currency"), F.lit("USD")).alias("currency_code"),
        vmoney("subtotal").alias("subtotal_amount"),
        vmoney("discount", default=0.0).alias("discount_amount"),
        vmoney("tax", default=0.0).alias("tax_amount"),
        vmoney("shipping", default=0.0).alias("shipping_amount"),
        vmoney("total").alias("total_amount"),
        vs("promotion_id").alias("promotion_id"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )


def with_first_order(orders: DataFrame) -> DataFrame:
    """IS_FIRST_ORDER = first order of the customer by (timestamp, id).

    The first order per customer is found with a grouped ``min(struct)``
    (map-side partial aggregation, safe for a customer holding a third of
    all orders) and joined back on the unique order id.  An order is the first of one
    customer only; distinct says so to the planner, which drops the join for readers of other columns."""
    firsts = (orders.filter(F.col("customer_id").isNotNull())
              .groupBy("customer_id")
              .agg(F.min(F.struct(F.col("order_timestamp").isNull().alias("n"), "order_timestamp", "order_id"))
                   .alias("_f"))
              .select(F.col("_f.order_id").alias("_first_id")).distinct().withColumn("is_first_order", F.lit(True)))
    out = orders.drop("is_first_order").join(firsts, orders.order_id == firsts._first_id, "left")
    return out.withColumn("is_first_order", F.coalesce("is_first_order", F.lit(False))).drop("_first_id")


def s02_orders(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _latest(orders_src(raw), ["order_id"])
    merged = scd1_upsert(target.drop("is_first_order") if target is not None else None, src,
                         ["order_id"], "order_sk", ["order_status", "total_amount"], run_ts)
    return with_first_order(merged)


def employee_links(raw_orders: DataFrame) -> DataFrame:
    """Order -> employee link carried in the order payload (F25), latest
    version per order (D18)."""
    src = _select(
        raw_orders,
        vs("employee_id").alias("employee_id"), vs("order_id").alias("order_id"),
        vdate("order_date").alias("order_date"), F.col("load_timestamp").alias("src_load_timestamp"))
    return _latest(src, ["order_id"]).filter(F.col("employee_id").isNotNull()).drop("src_load_timestamp")


# ------------------------------------------------------------------ S03 order items
def s03_order_items(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("order_id").alias("order_id"),
        vs("item_id").alias("item_id"),
        vs("product_id").alias("product_id"),
        F.coalesce(vnum("quantity"), F.lit(1)).cast("bigint").alias("quantity"),
        vmoney("unit_price", money4).alias("unit_price"),
        vmoney("discount", money4, default=0.0).alias("discount_amount"),
        vmoney("tax", money4, default=0.0).alias("tax_amount"),
        vmoney("line_total", money4).alias("line_total"),
        F.coalesce(vbool("return_flag"), F.lit(False)).alias("return_flag"),
        F.col("load_timestamp").alias("src_load_timestamp"),
        # tie-breakers for duplicate versions inside one load
        vdate("ship_date").alias("_ship"), vnum("product_id").alias("_pk"), vnum("supplier_id").alias("_sk"),
    )
    src = _latest(src, ["order_id", "item_id"], "_ship", "_pk", "_sk", "quantity", "line_total",
                  "discount_amount", "tax_amount").drop("_ship", "_pk", "_sk")
    if target is not None:
        new = src.join(target.select("order_id", "item_id"), ["order_id", "item_id"], "left_anti")
        new = assign_keys(new, [F.col("order_id"), F.col("item_id")], "order_item_sk",
                          start=max_key(target, "order_item_sk"))
        return target.unionByName(new.withColumn("dw_created_at", lit_ts(run_ts)))
    keyed = assign_keys(src, [F.col("order_id"), F.col("item_id")], "order_item_sk")
    return keyed.withColumn("dw_created_at", lit_ts(run_ts))


# ------------------------------------------------------------------ S04 products
def s04_products(raw: DataFrame, target: DataFrame | None, run_ts, atomic: bool = True) -> DataFrame:
    src = _select(
        raw,
        vs("product_id").alias("product_id"),
        vs("sku").alias("sku"),
        F.trim(vs("name")).alias("product_name"),
        vs("category_id").alias("category_id"),
        vs("supplier_id").alias("supplier_id"),
        vs("brand").alias("brand"),
        vmoney("cost", money4).alias("unit_cost"),
        vmoney("price", money4).alias("unit_price"),
        vdbl("weight").cast("decimal(10,4)").alias("weight_kg"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        F.coalesce(vbool("is_digital"), F.lit(False)).alias("is_digital"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["product_id"])
    return scd2_upsert(target, src, ["product_id"], "product_sk", ["unit_price", "is_active"], run_ts, atomic=atomic)


# ------------------------------------------------------------------ S05 categories
def s05_categories(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("category_id").alias("category_id"),
        F.trim(vs("name")).alias("category_name"),
        vs("parent_id").alias("parent_category_id"),
        vnum("level").alias("category_level"),
        vs("path").alias("category_path"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["category_id"])
    return scd1_upsert(target, src, ["category_id"], "category_sk",
                       ["category_name", "category_path", "is_active"], run_ts)


# ------------------------------------------------------------------ S06 suppliers
def s06_suppliers(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("supplier_id").alias("supplier_id"),
        F.trim(vs("name")).alias("supplier_name"),
        F.trim(vs("contact_name")).alias("contact_name"),
        F.lower(F.trim(vs("email"))).alias("email"),
        digits(vs("phone")).alias("phone"),
        vs("country").alias("country"),
        vs("region").alias("region"),
        vnum("payment_terms_days").alias("payment_terms_days"),
        vnum("lead_time_days").alias("lead_time_days"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        vdbl("rating").cast("decimal(3,1)").alias("supplier_rating"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["supplier_id"])
    return scd1_upsert(target, src, ["supplier_id"], "supplier_sk",
                       ["supplier_name", "supplier_rating", "is_active"], run_ts)


# ------------------------------------------------------------------ S07 inventory
def _of_type(raw: DataFrame, record_type: str) -> DataFrame:
    """Keep one record type of a mixed feed when the feed labels it."""
    return raw.filter(F.col("record_type") == record_type) if "record_type" in raw.columns else raw


def s07_inventory(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    raw = _of_type(raw, "inventory_snapshot")
    on_hand = F.coalesce(vnum("qty_on_hand"), F.lit(0))
    reserved = F.coalesce(vnum("qty_reserved"), F.lit(0))
    src = _select(
        raw,
        vs("product_id").alias("product_id"),
        vs("location_id").alias("location_id"),
        F.upper(F.coalesce(vs("location_type"), F.lit("WAREHOUSE"))).alias("location_type"),
        on_hand.alias("quantity_on_hand"),
        reserved.alias("quantity_reserved"),
        (on_hand - reserved).alias("quantity_available"),
        vnum("reorder_point").alias("reorder_point"),
        vnum("reorder_qty").alias("reorder_quantity"),
        vdate("snapshot_date").alias("snapshot_date"),
        vts("snapshot_ts").alias("snapshot_timestamp"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    keys = ["product_id", "location_id", "snapshot_timestamp"]
    # a snapshot without a readable time is kept
    src = latest_per_key(require_keys(src, ["product_id", "location_id"]), keys, ["src_load_timestamp"])
    order = [F.col(k) for k in keys]
    if target is not None:
        # null-safe: a snapshot without a readable time that is there already is not new
        had = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
        new = src.join(had, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]), "left_anti")
        new = assign_keys(new, order, "inventory_sk", start=max_key(target, "inventory_sk"))
        return target.unionByName(new.withColumn("dw_created_at", lit_ts(run_ts)))
    return assign_keys(src, order, "inventory_sk").withColumn("dw_created_at", lit_ts(run_ts))


def purchase_orders(raw_inventory: DataFrame) -> DataFrame:
    """Purchase orders carried in the inventory feed (F23 source)."""
    return _select(
        _of_type(raw_inventory, "purchase_order"),
        vs("po_number").alias("po_number"),
        vs("supplier_id").alias("supplier_id"),
        vs("product_id").alias("product_id"),
        vdate("order_date").alias("order_date"),
        vdate("expected_delivery").alias("expected_delivery"),
        vdate("actual_delivery").alias("actual_delivery"),
        vnum("quantity_ordered").alias("quantity_ordered"),
        vnum("quantity_received").alias("quantity_received"),
        vdbl("unit_cost").alias("unit_cost"),
        vdbl("total_cost").alias("total_cost"),
        F.upper(vs("status")).alias("po_status"),
    ).filter(F.col("po_number").isNotNull())


# ------------------------------------------------------------------ S08 payments
def payments_src(raw: DataFrame) -> DataFrame:
    src = _select(
        raw,
        vs("payment_id").alias("payment_id"),
        vs("order_id").alias("order_id"),
        vs("customer_id").alias("customer_id"),
        F.upper(vs("method")).alias("payment_method"),
        F.upper(vs("status")).alias("payment_status"),
        vmoney("amount").alias("amount"),
        F.coalesce(vs("currency"), F.lit("USD")).alias("currency_code"),
        vts("timestamp").alias("payment_timestamp"),
        vs("gateway_ref").alias("gateway_reference"),
        F.coalesce(vbool("is_refund"), F.lit(False)).alias("is_refund"),
        vs("original_payment_id").alias("original_payment_id"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    return _latest(src, ["payment_id"])


def s08_payments(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    return upsert_payments(payments_src(raw), target, run_ts)


def upsert_payments(src: DataFrame, target: DataFrame | None, run_ts, top: int | None = None) -> DataFrame:
    return scd1_upsert(target, src, ["payment_id"], "payment_sk", ["payment_status"], run_ts, top=top)


def merge_payments(raw: DataFrame, base: str, version: str, run_ts, buckets: int = 64) -> list[int]:
    """The same into a table in key buckets (``sources.buckets``): only the batch's buckets are
    read and written."""
    from strata.sources import buckets as B
    return B.merge(payments_src(raw), base, "payments", ["payment_id"], "payment_sk",
                   lambda src, target, top: upsert_payments(src, target, run_ts, top), version, buckets)


# ------------------------------------------------------------------ S09 returns
def s09_returns(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("return_id").alias("return_id"),
        vs("order_id").alias("order_id"),
        vs("customer_id").alias("customer_id"),
        vdate("return_date").alias("return_date"),
        F.upper(F.coalesce(vs("reason"), F.lit("OTHER"))).alias("return_reason"),
        F.upper(vs("status")).alias("return_status"),
        vmoney("refund_amount").alias("refund_amount"),
        F.upper(vs("refund_method")).alias("refund_method"),
        vnum("items_count").alias("items_count"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["return_id"])
    return scd1_upsert(target, src, ["return_id"], "return_sk", ["return_status", "refund_amount"], run_ts)


# ------------------------------------------------------------------ S10 reviews
def s10_reviews(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    rating = vdbl("rating")
    src = _select(
        raw,
        rating.alias("_raw_rating"),
        vs("review_id").alias("review_id"),
        vs("product_id").alias("product_id"),
        vs("customer_id").alias("customer_id"),
        vs("order_id").alias("order_id"),
        F.least(F.lit(5.0), F.greatest(F.lit(1.0), rating)).cast("decimal(2,1)").alias("rating"),
        F.trim(vs("title")).alias("review_title"),
        F.trim(vs("body")).alias("review_body"),
        vdate("review_date").alias("review_date"),
        F.coalesce(vbool("verified_purchase"), F.lit(False)).alias("is_verified_purchase"),
        F.coalesce(vbool("is_flagged"), F.lit(False)).alias("is_flagged"),
        F.coalesce(vnum("helpful_votes"), F.lit(0)).alias("helpful_votes"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    ).filter(F.col("_raw_rating").between(1, 5)).drop("_raw_rating")
    return _append_new(target, _latest(src, ["review_id"]), ["review_id"], "review_sk", run_ts)


def _append_new(target, src, keys, sk, run_ts) -> DataFrame:
    """SV4 with dense keys for the inserted rows."""
    ts = lit_ts(run_ts)
    order = [F.col(k) for k in keys]
    if target is None:
        return assign_keys(src, order, sk).withColumn("dw_created_at", ts)
    new = src.join(target.select(*keys), keys, "left_anti")
    new = assign_keys(new, order, sk, start=max_key(target, sk))
    return target.unionByName(new.withColumn("dw_created_at", ts))


# ------------------------------------------------------------------ S11 employees
def s11_employees(raw: DataFrame, target: DataFrame | None, run_ts, atomic: bool = True) -> DataFrame:
    src = _select(
        raw,
        vs("employee_id").alias("employee_id"),
        F.trim(vs("first_name")).alias("first_name"),
        F.trim(vs("last_name")).alias("last_name"),
        F.concat(F.trim(vs("first_name")), F.lit(" "), F.trim(vs("last_name"))).alias("full_name"),
        vs("job_title").alias("job_title"),
        vs("department").alias("department"),
        vs("store_id").alias("store_id"),
        vs("manager_id").alias("manager_id"),
        vdate("hire_date").alias("hire_date"),
        vdate("termination_date").alias("termination_date"),
        F.upper(F.coalesce(vs("status"), F.lit("ACTIVE"))).alias("employment_status"),
        F.upper(F.coalesce(vs("employment_type"), F.lit("FULL_TIME"))).alias("employment_type"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["employee_id"])
    return scd2_upsert(target, src, ["employee_id"], "employee_sk",
                       ["job_title", "store_id", "employment_status"], run_ts, atomic=atomic)


# ------------------------------------------------------------------ S12 stores
def s12_stores(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("store_id").alias("store_id"),
        F.trim(vs("name")).alias("store_name"),
        F.upper(F.coalesce(vs("type"), F.lit("STANDARD"))).alias("store_type"),
        vs("address_line1").alias("address_line1"),
        vs("city").alias("city"),
        vs("state").alias("state_province"),
        vs("postal_code").alias("postal_code"),
        F.upper(vs("country_code")).alias("country_code"),
        vdbl("latitude").alias("latitude"),
        vdbl("longitude").alias("longitude"),
        vs("timezone").alias("timezone"),
        vdate("opening_date").alias("opening_date"),
        vdate("closing_date").alias("closing_date"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        vs("manager_id").alias("store_manager_id"),
        vnum("sq_footage").alias("square_footage"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["store_id"])
    return scd1_upsert(target, src, ["store_id"], "store_sk", ["is_active", "store_manager_id"], run_ts)


# ------------------------------------------------------------------ S13 promotions
def s13_promotions(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("promotion_id").alias("promotion_id"),
        F.trim(vs("name")).alias("promotion_name"),
        F.upper(vs("type")).alias("promotion_type"),
        vdbl("discount_value").cast("decimal(10,4)").alias("discount_value"),
        vmoney("min_order_amount").alias("min_order_amount"),
        vmoney("max_discount").alias("max_discount_amount"),
        vdate("start_date").alias("start_date"),
        vdate("end_date").alias("end_date"),
        F.upper(F.coalesce(vs("applies_to"), F.lit("ALL"))).alias("applies_to"),
        F.upper(vs("promo_code")).alias("promo_code"),
        F.coalesce(vbool("is_stackable"), F.lit(False)).alias("is_stackable"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        vnum("usage_limit").alias("usage_limit"),
        F.coalesce(vnum("times_used"), F.lit(0)).alias("times_used"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["promotion_id"])
    return scd1_upsert(target, src, ["promotion_id"], "promotion_sk", ["is_active", "times_used"], run_ts)


# ------------------------------------------------------------------ S14 campaigns
def s14_campaigns(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("campaign_id").alias("campaign_id"),
        F.trim(vs("name")).alias("campaign_name"),
        F.upper(vs("type")).alias("campaign_type"),
        F.upper(vs("channel")).alias("channel"),
        vdate("start_date").alias("start_date"),
        vdate("end_date").alias("end_date"),
        vmoney("budget").alias("budget_amount"),
        vmoney("spend", default=0.0).alias("spend_amount"),
        vs("target_audience").alias("target_audience"),
        F.coalesce(vnum("impressions"), F.lit(0)).alias("impressions"),
        F.coalesce(vnum("clicks"), F.lit(0)).alias("clicks"),
        F.coalesce(vnum("conversions"), F.lit(0)).alias("conversions"),
        vmoney("revenue_attributed", default=0.0).alias("revenue_attributed"),
        F.coalesce(vbool("is_active"), F.lit(True)).alias("is_active"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["campaign_id"])
    return scd1_upsert(target, src, ["campaign_id"], "campaign_sk",
                       ["spend_amount", "impressions", "clicks", "conversions", "revenue_attributed"], run_ts)


# ------------------------------------------------------------------ S15 web sessions
def s15_web_sessions(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("session_id").alias("session_id"),
        vs("customer_id").alias("customer_id"),
        F.upper(vs("device_type")).alias("device_type"),
        vs("browser").alias("browser"),
        vs("os").alias("os"),
        F.upper(F.coalesce(vs("channel"), F.lit("DIRECT"))).alias("channel"),
        vs("campaign_id").alias("campaign_id"),
        vts("session_start").alias("session_start"),
        vts("session_end").alias("session_end"),
        vnum("duration_sec").alias("session_duration_sec"),
        F.coalesce(vnum("page_views"), F.lit(1)).alias("page_views"),
        F.coalesce(vbool("is_bounce"), F.lit(False)).alias("is_bounce"),
        F.coalesce(vbool("converted"), F.lit(False)).alias("converted"),
        vs("order_id").alias("order_id"),
        vs("landing_page").alias("landing_page"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    return _append_new(target, _latest(src, ["session_id"]), ["session_id"], "session_sk", run_ts)


# ------------------------------------------------------------------ S16 shipments
def s16_shipments(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    actual = vdate("actual_delivery")
    est = vdate("estimated_delivery")
    ship = vdate("ship_date")
    src = _select(
        raw,
        vs("shipment_id").alias("shipment_id"),
        vs("order_id").alias("order_id"),
        vs("customer_id").alias("customer_id"),
        F.upper(vs("carrier")).alias("carrier"),
        vs("tracking_number").alias("tracking_number"),
        ship.alias("ship_date"),
        est.alias("estimated_delivery"),
        actual.alias("actual_delivery"),
        F.upper(vs("status")).alias("shipment_status"),
        F.upper(F.coalesce(vs("shipping_method"), F.lit("STANDARD"))).alias("shipping_method"),
        vs("origin_zip").alias("origin_zip"),
        vs("destination_zip").alias("destination_zip"),
        F.upper(vs("destination_country")).alias("destination_country"),
        vdbl("weight_kg").cast("decimal(10,4)").alias("weight_kg"),
        vmoney("shipping_cost").alias("shipping_cost"),
        F.coalesce(actual > est, F.lit(False)).alias("is_late"),
        F.datediff(actual, ship).cast("bigint").alias("days_to_deliver"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["shipment_id"])
    return scd1_upsert(target, src, ["shipment_id"], "shipment_sk",
                       ["shipment_status", "actual_delivery", "is_late", "days_to_deliver"], run_ts)


# ------------------------------------------------------------------ S17 addresses
def s17_addresses(raw: DataFrame, target: DataFrame | None, run_ts, atomic: bool = True) -> DataFrame:
    src = _select(
        raw,
        vs("address_id").alias("address_id"),
        vs("customer_id").alias("customer_id"),
        F.upper(F.coalesce(vs("type"), F.lit("SHIPPING"))).alias("address_type"),
        F.trim(vs("line1")).alias("address_line1"),
        F.trim(vs("line2")).alias("address_line2"),
        F.trim(vs("city")).alias("city"),
        F.trim(vs("state")).alias("state_province"),
        F.trim(vs("postal_code")).alias("postal_code"),
        F.upper(F.trim(vs("country_code"))).alias("country_code"),
        F.coalesce(vbool("is_default"), F.lit(False)).alias("is_default"),
        F.coalesce(vbool("is_validated"), F.lit(False)).alias("is_validated"),
        vdbl("lat").alias("latitude"),
        vdbl("lon").alias("longitude"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    src = _latest(src, ["address_id"])
    return scd2_upsert(target, src, ["address_id"], "address_sk", ["address_line1", "postal_code"],
                       run_ts, atomic=atomic)


# ------------------------------------------------------------------ S18 loyalty
def s18_loyalty_points(raw: DataFrame, target: DataFrame | None, run_ts) -> DataFrame:
    src = _select(
        raw,
        vs("transaction_id").alias("transaction_id"),
        vs("customer_id").alias("customer_id"),
        vs("order_id").alias("order_id"),
        F.upper(F.coalesce(vs("type"), F.lit("EARN"))).alias("transaction_type"),
        vnum("points_change").alias("points_change"),
        vnum("balance_after").alias("points_balance_after"),
        vdate("transaction_date").alias("transaction_date"),
        vts("transaction_timestamp").alias("transaction_timestamp"),
        vdate("expiry_date").alias("expiry_date"),
        vs("reference_code").alias("reference_code"),
        vs("notes").alias("notes"),
        F.col("load_timestamp").alias("src_load_timestamp"),
    )
    return _append_new(target, _latest(src, ["transaction_id"]), ["transaction_id"], "loyalty_sk", run_ts)


# ------------------------------------------------------------------ S19 customer segments (RFM)
def s19_customer_segments(orders: DataFrame, as_of, target: DataFrame | None = None) -> DataFrame:
    """Daily RFM snapshot; replaces the ``segment_date`` partition (SV6).

    The three NTILE(5) scores are global windows over every customer; they come from one
    narrow sort of all three measures (``global_positions``) instead of
    single-partition windows.  Ties are broken by customer id."""
    today = lit_date(as_of)
    rfm = (orders.filter(~F.col("order_status").isin("CANCELLED", "RETURNED"))
           .groupBy("customer_id")
           .agg(F.datediff(today, F.max("order_date")).cast("bigint").alias("recency_days"),
                F.count(F.lit(1)).alias("frequency_orders"),
                F.sum("total_amount").alias("monetary_total")))
    scored = global_positions(rfm, "customer_id", ntiles={
        "rfm_recency_score": (5, "recency_days", "desc"), "rfm_frequency_score": (5, "frequency_orders", "asc"),
        "rfm_monetary_score": (5, "monetary_total", "asc")})
    r, f, m = F.col("rfm_recency_score"), F.col("rfm_frequency_score"), F.col("rfm_monetary_score")
    # Most frequent order channel, ties alphabetical (pre-aggregated per customer x channel)
    # ties alphabetical: max(n) then smallest channel -> use min over equal counts
    ch = (orders.filter(~F.col("order_status").isin("CANCELLED", "RETURNED"))
          .groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("_n")))
    best = ch.groupBy("customer_id").agg(F.max("_n").alias("_mx"))
    pref = (ch.join(best, "customer_id").filter(F.col("_n") == F.col("_mx"))
            .groupBy("customer_id").agg(F.min("channel").alias("channel_preference")))
    out = scored.join(pref, "customer_id", "left").select(
        "customer_id",
        today.alias("segment_date"),
        "recency_days", "frequency_orders",
        F.col("monetary_total").cast("decimal(18,2)").alias("monetary_total"),
        r.alias("rfm_recency_score"), f.alias("rfm_frequency_score"), m.alias("rfm_monetary_score"),
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_combined_score"),
        F.when((r >= 4) & (f >= 4) & (m >= 4), "CHAMPION").when((r >= 3) & (f >= 3), "LOYAL")
         .when((r <= 2) & (f >= 3), "AT_RISK").when((r == 1) & (f == 1), "LOST")
         .when(F.col("frequency_orders") == 1, "NEW").otherwise("POTENTIAL").alias("lifecycle_segment"),
        F.when(F.col("monetary_total") >= 5000, "HIGH").when(F.col("monetary_total") >= 500, "MEDIUM")
         .otherwise("LOW").alias("value_segment"),
        "channel_preference",
        ((F.col("monetary_total") >= 5000) & (f >= 4)).alias("is_vip"),
        (F.col("recency_days") > 365).alias("has_churned"),
    )
    return replace_partition(target, out, "segment_date")


# ------------------------------------------------------------------ S20 product catalog
def s20_product_catalog(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Truncate-and-reload (SV7) of the pre-joined catalog, current products only.
    ``product_sk`` is carried (D7)."""
    p = products.filter(F.col("is_current")).alias("p")
    c = categories.alias("c")
    pc = categories.select(F.col("category_id").alias("_pc_id"), F.col("category_name").alias("parent_category_name"))
    s = suppliers.select(F.col("supplier_id").alias("_s_id"), "supplier_name")
    j = (p.join(c, F.col("p.category_id") == F.col("c.category_id"), "left")
          .join(pc, F.col("c.parent_category_id") == F.col("_pc_id"), "left")
          .join(s, F.col("p.supplier_id") == F.col("_s_id"), "left"))
    price = F.col("p.unit_price").cast("double")
    out = j.select(
        F.col("p.product_sk").alias("product_sk"),
        F.col("p.product_id").alias("product_id"), F.col("p.sku").alias("sku"),
        F.col("p.product_name").alias("product_name"), F.col("p.brand").alias("brand"),
        F.col("c.category_id").alias("category_id"), F.col("c.category_name").alias("category_name"),
        F.col("c.parent_category_id").alias("parent_category_id"), F.col("parent_category_name"),
        F.split_part(F.col("c.category_path"), F.lit(" > "), F.lit(1)).alias("top_category_name"),
        F.col("c.category_path").alias("category_path"),
        F.col("_s_id").alias("supplier_id"), F.col("supplier_name"),
        F.col("p.unit_cost").alias("unit_cost"), F.col("p.unit_price").alias("unit_price"),
        F.when(price > 0, (price - F.col("p.unit_cost").cast("double")) / price * 100)
         .cast("decimal(8,4)").alias("margin_pct"),
        F.col("p.is_active").alias("is_active"), F.col("p.is_digital").alias("is_digital"),
        F.col("p.weight_kg").alias("weight_kg"),
    )
    return assign_keys(out, [F.col("product_id")], "catalog_sk")
