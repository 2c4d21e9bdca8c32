"""Binding of the driver's test tables to the twenty retail raw feeds.

The driver ships TPC-H-like parquet tables, not retail feeds.  This module
turns them into raw landing rows (lifted keys + variant payload + lineage),
deterministically, so that the whole raw -> silver -> gold pipeline runs on
data that grows with the scale factor.  The oracle SQL (``oracle/``) encodes
the same rules.  Every rule is a column expression; no row leaves Spark.

Rules (k = the source key):
  customers   customer; two loads: run 1 all customers, run 2 a new e-mail for
              k % 7 = 3 (type-2 change).  tier from c_acctbal bands.
  stores      one per nation with customers ('S' || n_nationkey); floor space
              from the nation's customer count.
  orders      orders x customer (store = customer's nation) + line sums;
              status F/O/P -> delivered/shipped/pending, k%20=0 cancelled,
              k%20=1 returned; channel from the priority digit (5 -> null).
  order_items every lineitem row (duplicates of (order, line) included).
  products    part; categories = p_type (level 1) and p_type > p_brand (2).
  suppliers   supplier x nation x region.
  inventory   part x 2 locations x 3 snapshot days + purchase orders per
              (supplier, part) from lineitem, in the same raw table.
  payments    one capture per order, a refund for returned orders.
  returns     deduplicated lines flagged 'R'.
  reviews     deduplicated lines with l_partkey % 4 = 0.
  shipments   one per order with lines.
  loyalty     EARN per order, REDEEM k%5=0, EXPIRE k%17=0.
  sessions    events: per user, a gap over 30 minutes starts a new session.
  cart_events events click/error/view -> add/remove/checkout.
  promotions, campaigns, employees, addresses: derived from orders / events /
              customers by grouping on fixed key rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.compat import lit_ts, second_diff
from strata.sources.raw import SOURCES, lift_keys

# Fixed values of the binding.
RUN1 = dt.datetime(2001, 8, 1, 1, 0, 0)
RUN2 = dt.datetime(2001, 8, 1, 2, 0, 0)
RETAIL_AS_OF = dt.date(2001, 8, 1)
SESSION_RUN = dt.datetime(2024, 1, 31, 0, 0, 0)
SESSION_AS_OF = dt.date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table, split as its row groups are."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A narrow table over all tasks.  Its file has few row groups, and all that is made of a row would be made,
    sorted and encoded in the task that reads its group."""
    n = max(3 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df.repartition(n, key)


def lines(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Columns of lineitem, spread by order over partitions that are sized to the data.  What is grouped or joined by
    order next needs no other shuffle, and no task sorts or encodes all that it has read of a large row group."""
    return table(spark, sf_dir, "lineitem").select(*cols).repartition("l_orderkey")


def _raw(fields: DataFrame, source: str, run_ts, batch_id: str | None, load_ts=None) -> DataFrame:
    """Wrap a frame of payload fields into the raw envelope."""
    src = SOURCES[source]
    cols = [F.col(c) for c in fields.columns if not c.startswith("_")]
    out = fields.select(
        F.to_variant_object(F.struct(*cols)).alias("payload"),
        F.lit(f"testdata/{source}").alias("file_name"),
        F.lit(None).cast("bigint").alias("file_row_number"),
        (F.col("_load_ts") if load_ts == "column" else lit_ts(run_ts)).alias("load_timestamp"),
        F.lit(None if src.streaming else batch_id).cast("string").alias("batch_id"),
    )
    out = lift_keys(out, src.keys)
    return out.select(*src.keys.keys(), "payload", "file_name", "file_row_number", "load_timestamp", "batch_id")


def _ds(c) -> F.Column:
    """date -> 'yyyy-MM-dd' text, as a JSON feed carries it.  Plain casts are
    zone-free (``date_format`` would pass wall-clock values through the
    session time zone and shift times inside a DST gap)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date").cast("string")


def _ts(c) -> F.Column:
    """wall-clock timestamp -> 'yyyy-MM-dd HH:mm:ss[.ffffff]' text (zone-free)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz").cast("string")


# ---------------------------------------------------------------- customers
def _customer_fields(c: DataFrame, second: bool) -> DataFrame:
    k = F.col("c_custkey")
    email = (F.concat(F.lit("user"), k.cast("string"), F.lit("@new.example")) if second
             else F.concat(F.lit(" User"), k.cast("string"), F.lit("@Shop.COM ")))
    return c.select(
        k.cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        email.alias("email"),
        F.concat(F.lit("(555) 01-"), k.cast("string")).alias("phone"),
        F.when(k % 10 != 0, _ds(F.date_add(F.lit(dt.date(1950, 1, 1)), ((k * 37) % 18000).cast("int"))))
         .alias("date_of_birth"),
        F.when(k % 3 == 0, "m").when(k % 3 == 1, "f").alias("gender"),
        F.when(F.col("c_acctbal") >= 7500, "platinum").when(F.col("c_acctbal") >= 5000, "gold")
         .when(F.col("c_acctbal") >= 2500, "silver").alias("tier"),
        _ds(F.date_add(F.lit(dt.date(1994, 1, 1)), (k % 2500).cast("int"))).alias("registration_date"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def raw_customers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(run-1 rows, run-2 rows)."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    r1 = _raw(_customer_fields(c, False), "customers", RUN1, "b1")
    r2 = _raw(_customer_fields(c.filter(F.col("c_custkey") % 7 == 3), True), "customers", RUN2, "b2")
    return r1, r2


# ---------------------------------------------------------------- stores
def raw_stores(spark, sf_dir) -> DataFrame:
    """One store per nation that has customers; the floor space grows with
    the nation's customer count (customers are aggregated per nation first)."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_cust"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
    f = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "inner").select(
        F.concat(F.lit("S"), k.cast("string")).alias("store_id"),
        F.col("n_name").alias("name"),
        F.when(k % 3 == 0, "flagship").when(k % 3 == 1, "outlet").alias("type"),
        F.concat(k.cast("string"), F.lit(" Main St")).alias("address_line1"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        (k + 10000).cast("string").alias("postal_code"),
        F.lower(F.substring("r_name", 1, 2)).alias("country_code"),
        (k * 1.5).cast("double").alias("latitude"),
        (k * -2.25).cast("double").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        _ds(F.date_add(F.lit(dt.date(1990, 1, 1)), (k * 100).cast("int"))).alias("opening_date"),
        F.lit(None).cast("string").alias("closing_date"),
        F.lit(True).alias("is_active"),
        F.concat(F.lit("E"), k.cast("string")).alias("manager_id"),
        (k * 500 + 1000 + F.col("_cust") % 1000).cast("bigint").alias("sq_footage"),
    )
    return _raw(f, "stores", RUN1, "b1")


# ---------------------------------------------------------------- orders
def _line_sums(spark, sf_dir) -> DataFrame:
    li = lines(spark, sf_dir, "l_orderkey", "l_extendedprice", "l_discount", "l_tax")
    return li.groupBy("l_orderkey").agg(
        _sum_of_products("l_extendedprice", "l_discount").cast("decimal(18,2)").alias("_disc"),
        _sum_of_products("l_extendedprice", "l_tax").cast("decimal(18,2)").alias("_tax"),
    )


def _sum_of_products(a: str, b: str) -> F.Column:
    """The exact sum of the products of two columns as decimal(18,2), NULL if there is none.  Products of whole cents
    are added as numbers, in ten-thousandths, all others as decimals."""
    whole, n = _cents(a, b)
    whole = F.coalesce(whole & (F.abs(n) < 1e12), F.lit(False))
    few = F.sum(F.when(whole, n.cast("bigint"))).cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(4,4)")
    rest = F.sum(F.when(~whole, F.col(a).cast("decimal(18,2)") * F.col(b).cast("decimal(18,2)")))
    return F.coalesce(few + rest, few, rest)


def _order_base(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def raw_orders(spark, sf_dir) -> DataFrame:
    o = _order_base(spark, sf_dir)
    sums = _line_sums(spark, sf_dir)
    k = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    channel = (F.when(prio == "1", "web").when(prio == "2", "mobile").when(prio == "3", "store")
                .when(prio == "4", "phone"))
    sub = F.col("o_totalprice").cast("decimal(18,2)")
    ship = F.when(k % 4 != 0, (k % 50).cast("decimal(18,2)") + F.lit(0.99).cast("decimal(18,2)"))
    total = (sub - F.coalesce(F.col("_disc"), F.lit(0)) + F.coalesce(F.col("_tax"), F.lit(0))
             + F.coalesce(ship, F.lit(0))).cast("decimal(18,2)")
    f = o.join(sums, o.o_orderkey == sums.l_orderkey, "left").select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("store_id"),
        _ds(F.col("o_orderdate")).alias("order_date"),
        _ts(F.timestamp_add("SECOND", (k % 86400).cast("int"), F.col("o_orderdate"))).alias("order_timestamp"),
        F.when(k % 20 == 0, "cancelled").when(k % 20 == 1, "returned")
         .when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
         .otherwise("pending").alias("status"),
        channel.alias("channel"),
        F.when(k % 2 == 1, "USD").alias("currency"),
        sub.cast("double").alias("subtotal"),
        F.col("_disc").cast("double").alias("discount"),
        F.col("_tax").cast("double").alias("tax"),
        ship.cast("double").alias("shipping"),
        total.cast("double").alias("total"),
        F.when(k % 3 == 0, F.concat(F.lit("P"), (k % 8).cast("string"))).alias("promotion_id"),
        F.when(prio == "3", F.concat(F.lit("E"), (F.col("o_custkey") % 40).cast("string"))).alias("employee_id"),
    )
    return _raw(f, "orders", RUN1, "b1")


# ---------------------------------------------------------------- order items
def _cents(a: str, b: str) -> tuple[F.Column, F.Column]:
    """(whether two columns are whole cents, their product in ten-thousandths)."""
    def cents(c):
        return F.rint(F.col(c) * 100)

    whole = (cents(a) / 100 == F.col(a)) & (cents(b) / 100 == F.col(b)) & (F.abs(cents(a)) < 1e13) & (F.abs(cents(b)) < 1e13)
    return whole, cents(a) * cents(b)


def _cents_product(a: str, b: str) -> F.Column:
    """The double of the exact product of two columns as decimal(18,2).  Where both are whole cents and their
    product is a whole number below 2^53, one division gives that double."""
    whole, n = _cents(a, b)
    exact = F.col(a).cast("decimal(18,2)") * F.col(b).cast("decimal(18,2)")
    return F.when(whole & (F.abs(n) < 9e15), n / 10000 + F.lit(0.0)).otherwise(exact.cast("double"))


def raw_order_items(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    # priced first, then spread by order: copies of a line are in one task, which keeps one of them before silver's shuffle
    li = li.join(p, li.l_partkey == p.p_partkey, "left").drop("p_partkey").repartition("l_orderkey")
    f = li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("supplier_id"),
        _ds(F.col("l_shipdate")).alias("ship_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        _cents_product("l_extendedprice", "l_discount").alias("discount"),
        _cents_product("l_extendedprice", "l_tax").alias("tax"),
        F.col("l_extendedprice").alias("line_total"),
        (F.col("l_returnflag") == "R").alias("return_flag"),
    )
    return _raw(f, "order_items", RUN1, "b1")


def dedup_lines(spark, sf_dir) -> DataFrame:
    """One lineitem per (order, line): the greatest on (shipdate, partkey,
    suppkey, quantity, extendedprice, discount, tax) -- the same tie-break
    the order-items silver job uses."""
    from strata.operators.load import latest_per_key
    li = lines(spark, sf_dir, "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"],
                          ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                           "l_discount", "l_tax"])


# ---------------------------------------------------------------- products / categories / suppliers
def raw_products(spark, sf_dir) -> DataFrame:
    p = spread(table(spark, sf_dir, "part"), "p_partkey")
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    f = p.select(
        k.cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("C-"), F.col("p_type"), F.lit("-"), F.col("p_brand")).alias("category_id"),
        (k % 100).cast("string").alias("supplier_id"),
        F.col("p_brand").alias("brand"),
        (price * F.lit(0.6).cast("decimal(2,1)")).cast("double").alias("cost"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 0.25).cast("double").alias("weight"),
        F.when(k % 13 != 0, F.col("p_size") % 10 != 0).alias("is_active"),
        F.lit(None).cast("boolean").alias("is_digital"),
    )
    return _raw(f, "products", RUN1, "b1")


def raw_categories(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    top = p.select("p_type").distinct().select(
        F.concat(F.lit("C-"), F.col("p_type")).alias("category_id"),
        F.col("p_type").alias("name"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(1).cast("bigint").alias("level"),
        F.col("p_type").alias("path"),
        F.lit(None).cast("boolean").alias("is_active"),
    )
    leaf = p.select("p_type", "p_brand").distinct().select(
        F.concat(F.lit("C-"), F.col("p_type"), F.lit("-"), F.col("p_brand")).alias("category_id"),
        F.col("p_brand").alias("name"),
        F.concat(F.lit("C-"), F.col("p_type")).alias("parent_id"),
        F.lit(2).cast("bigint").alias("level"),
        F.concat(F.col("p_type"), F.lit(" > "), F.col("p_brand")).alias("path"),
        F.lit(True).alias("is_active"),
    )
    return _raw(top.unionByName(leaf), "categories", RUN1, "b1")


def raw_suppliers(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("s_suppkey")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
    f = s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey, "left").select(
        k.cast("string").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("Contact "), k.cast("string")).alias("contact_name"),
        F.concat(F.lit(" Sup"), k.cast("string"), F.lit("@Vendor.COM")).alias("email"),
        F.concat(F.lit("+1-800-"), k.cast("string")).alias("phone"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        (F.lit(30) + (k % 3) * 15).cast("bigint").alias("payment_terms_days"),
        (F.lit(5) + k % 20).cast("bigint").alias("lead_time_days"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        ((k % 51) / 10.0).alias("rating"),
    )
    return _raw(f, "suppliers", RUN1, "b1")


# ---------------------------------------------------------------- inventory + purchase orders
def raw_inventory(spark, sf_dir) -> DataFrame:
    p = spread(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")
    k = F.col("p_partkey")
    grid = F.explode(F.array(*[F.struct(F.lit(l).alias("loc"), F.lit(d).alias("day"))
                               for l in (0, 1) for d in (0, 1, 2)]))
    g = p.select("p_partkey", grid.alias("g")).select("p_partkey", "g.loc", "g.day")
    snap = F.date_add(F.lit(dt.date(2001, 7, 30)), F.col("day"))
    snap_fields = g.select(
        k.cast("string").alias("product_id"),
        F.when(F.col("loc") == 0, "WH-1").otherwise("ST-1").alias("location_id"),
        F.when(F.col("loc") == 1, "STORE").alias("location_type"),
        ((k * 7 + F.col("loc") * 11 + F.col("day") * 3) % 150).cast("bigint").alias("qty_on_hand"),
        F.when(k % 9 != 0, k % 10).cast("bigint").alias("qty_reserved"),
        F.lit(20).cast("bigint").alias("reorder_point"),
        F.lit(100).cast("bigint").alias("reorder_qty"),
        _ds(snap).alias("snapshot_date"),
        _ts(F.timestamp_add("HOUR", F.lit(6), snap.cast("timestamp_ntz"))).alias("snapshot_ts"),
    )
    # whole rows are shuffled once: most pairs are on one line, so hashing them before the shuffle would only fill memory
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_quantity").repartition("l_suppkey", "l_partkey")
    po = li.groupBy("l_suppkey", "l_partkey").agg(
        F.min(F.to_date("l_shipdate")).alias("_od"), F.sum(F.col("l_quantity").cast("bigint")).alias("_q"))
    s = F.col("l_suppkey")
    unit = (F.lit(10) + s % 7).cast("decimal(18,2)")
    po_fields = po.select(
        F.concat(F.lit("PO-"), s.cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("po_number"),
        s.cast("string").alias("supplier_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        _ds(F.col("_od")).alias("order_date"),
        _ds(F.date_add(F.col("_od"), 14)).alias("expected_delivery"),
        _ds(F.date_add(F.col("_od"), (s % 21).cast("int"))).alias("actual_delivery"),
        F.col("_q").alias("quantity_ordered"),
        (F.col("_q") - F.col("l_partkey") % 3).alias("quantity_received"),
        unit.cast("double").alias("unit_cost"),
        (unit * F.col("_q")).cast("double").alias("total_cost"),
        F.lit("received").alias("status"),
    )
    # The feed mixes two record types; a plain record-type column lets each
    # reader prune the other branch at planning time.
    snaps = _raw(snap_fields, "inventory", RUN1, "b1").withColumn("record_type", F.lit(SNAPSHOT))
    pos = _raw(po_fields, "inventory", RUN1, "b1").withColumn("record_type", F.lit(PURCHASE_ORDER))
    return snaps.unionByName(pos)


SNAPSHOT, PURCHASE_ORDER = "inventory_snapshot", "purchase_order"


# ---------------------------------------------------------------- payments / returns / reviews / shipments / loyalty
def raw_payments(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    orders = raw_order_totals(spark, sf_dir)
    k = F.col("o_orderkey")
    base = o.select("o_orderkey", "o_custkey", "o_orderdate").join(orders, "o_orderkey", "left")
    otime = F.timestamp_add("SECOND", (k % 86400).cast("int"), F.col("o_orderdate"))
    method = (F.when(k % 5 == 0, "credit_card").when(k % 5 == 1, "debit_card").when(k % 5 == 2, "paypal")
               .when(k % 5 == 3, "apple_pay").otherwise("bank_transfer"))
    cap = base.select(
        F.concat(F.lit("PAY"), k.cast("string")).alias("payment_id"),
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        method.alias("method"),
        F.lit("captured").alias("status"),
        F.col("_total").cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        _ts(F.timestamp_add("HOUR", F.lit(1), otime)).alias("timestamp"),
        F.concat(F.lit("GW"), k.cast("string")).alias("gateway_ref"),
        F.lit(None).cast("boolean").alias("is_refund"),
        F.lit(None).cast("string").alias("original_payment_id"),
    )
    ref = base.filter(k % 20 == 1).select(
        F.concat(F.lit("REF"), k.cast("string")).alias("payment_id"),
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        method.alias("method"),
        F.lit("refunded").alias("status"),
        F.col("_total").cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        _ts(F.timestamp_add("DAY", F.lit(10), otime)).alias("timestamp"),
        F.concat(F.lit("GW"), k.cast("string"), F.lit("R")).alias("gateway_ref"),
        F.lit(True).alias("is_refund"),
        F.concat(F.lit("PAY"), k.cast("string")).alias("original_payment_id"),
    )
    return _raw(cap.unionByName(ref), "payments", RUN1, None)


def raw_payments_second(spark, sf_dir) -> DataFrame:
    """A second load: captures of k % 11 = 0 are settled, orders of k % 13 = 0 have a tip (a new
    payment), and for k % 17 = 0 there is a row without a payment id, which silver rejects."""
    k = F.col("o_orderkey")
    at = _ts(F.timestamp_add("DAY", F.lit(20), F.col("o_orderdate")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")

    def rows(chosen, payment_id, status, amount):
        return o.filter(chosen).select(
            payment_id.cast("string").alias("payment_id"), k.cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
            F.lit("credit_card").alias("method"), F.lit(status).alias("status"), amount.cast("double").alias("amount"), F.lit("USD").alias("currency"),
            at.alias("timestamp"), F.concat(F.lit("GX"), k.cast("string")).alias("gateway_ref"), F.lit(None).cast("boolean").alias("is_refund"),
            F.lit(None).cast("string").alias("original_payment_id"))

    settled = rows(k % 11 == 0, F.concat(F.lit("PAY"), k.cast("string")), "settled", F.lit(0))
    tips = rows(k % 13 == 0, F.concat(F.lit("TIP"), k.cast("string")), "captured", k % 40)
    lost = rows(k % 17 == 0, F.lit(None), "captured", F.lit(1))
    return _raw(settled.unionByName(tips).unionByName(lost), "payments", RUN2, None)


def raw_order_totals(spark, sf_dir) -> DataFrame:
    """Order total exactly as the orders feed carries it (decimal)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sums = _line_sums(spark, sf_dir)
    k = F.col("o_orderkey")
    ship = F.when(k % 4 != 0, (k % 50).cast("decimal(18,2)") + F.lit(0.99).cast("decimal(18,2)"))
    total = (F.col("o_totalprice").cast("decimal(18,2)") - F.coalesce(F.col("_disc"), F.lit(0))
             + F.coalesce(F.col("_tax"), F.lit(0)) + F.coalesce(ship, F.lit(0))).cast("decimal(18,2)")
    return o.join(sums, o.o_orderkey == sums.l_orderkey, "left").select("o_orderkey", total.alias("_total"))


def _lines_with_customer(spark, sf_dir) -> DataFrame:
    lines = dedup_lines(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(o, lines.l_orderkey == o.o_orderkey, "left")


def raw_returns(spark, sf_dir) -> DataFrame:
    l = _lines_with_customer(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    rid = F.concat(F.lit("RT"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    pk = F.col("l_partkey") % 5
    f = l.select(
        rid.alias("return_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _ds(F.date_add(F.to_date("l_shipdate"), 7)).alias("return_date"),
        F.when(pk == 0, "defective").when(pk == 1, "wrong_item").when(pk == 2, "not_as_described")
         .when(pk == 3, "changed_mind").alias("reason"),
        F.when(F.col("l_orderkey") % 3 == 0, "REFUNDED").when(F.col("l_orderkey") % 3 == 1, "APPROVED")
         .otherwise("RECEIVED").alias("status"),
        F.col("l_extendedprice").alias("refund_amount"),
        F.when(F.col("l_linenumber") % 3 == 0, "ORIGINAL_PAYMENT").when(F.col("l_linenumber") % 3 == 1, "STORE_CREDIT")
         .otherwise("GIFT_CARD").alias("refund_method"),
        F.col("l_quantity").cast("bigint").alias("items_count"),
    )
    return _raw(f, "returns", RUN1, "b1")


def raw_reviews(spark, sf_dir) -> DataFrame:
    l = _lines_with_customer(spark, sf_dir).filter(F.col("l_partkey") % 4 == 0)
    ln = F.col("l_linenumber")
    f = l.select(
        F.concat(F.lit("RV"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("review_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        (F.col("l_quantity").cast("bigint") % 6).cast("double").alias("rating"),
        F.lit("Review").alias("title"),
        F.lit("Body").alias("body"),
        _ds(F.date_add(F.to_date("l_shipdate"), 14)).alias("review_date"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
        (F.col("l_orderkey") % 50 == 0).alias("is_flagged"),
        F.when(ln != 1, ln % 3).cast("bigint").alias("helpful_votes"),
    )
    return _raw(f, "reviews", RUN1, "b1")


def raw_shipments(spark, sf_dir) -> DataFrame:
    lines = dedup_lines(spark, sf_dir)
    per = lines.groupBy("l_orderkey").agg(
        F.min(F.to_date("l_shipdate")).alias("_ship"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("_open"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("_qty"))
    o = _order_base(spark, sf_dir).select("o_orderkey", "o_custkey", "c_nationkey")
    j = per.join(o, per.l_orderkey == o.o_orderkey, "left")
    k = F.col("l_orderkey")
    actual = F.when(F.col("_open") == 0, F.date_add(F.col("_ship"), (k % 10).cast("int")))
    nk = F.col("c_nationkey") % 4
    f = j.select(
        F.concat(F.lit("SH"), k.cast("string")).alias("shipment_id"),
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(k % 5 == 0, "FEDEX").when(k % 5 == 1, "UPS").when(k % 5 == 2, "DHL").when(k % 5 == 3, "USPS")
         .otherwise("LOCAL").alias("carrier"),
        F.concat(F.lit("TRK"), k.cast("string")).alias("tracking_number"),
        _ds(F.col("_ship")).alias("ship_date"),
        _ds(F.date_add(F.col("_ship"), 5)).alias("estimated_delivery"),
        _ds(actual).alias("actual_delivery"),
        F.when(actual.isNull(), "IN_TRANSIT").otherwise("DELIVERED").alias("status"),
        F.when(k % 4 == 0, "STANDARD").when(k % 4 == 1, "EXPRESS").when(k % 4 == 2, "OVERNIGHT")
         .otherwise("SAME_DAY").alias("shipping_method"),
        F.lit("10001").alias("origin_zip"),
        (F.col("o_custkey") % 89999 + 10000).cast("string").alias("destination_zip"),
        F.when(nk == 0, "US").when(nk == 1, "CA").when(nk == 2, "GB").otherwise("DE").alias("destination_country"),
        (F.col("_qty") * 0.5).cast("double").alias("weight_kg"),
        (F.lit(5) + k % 20).cast("double").alias("shipping_cost"),
    )
    return _raw(f, "shipments", RUN1, "b1")


def raw_loyalty(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = o.join(raw_order_totals(spark, sf_dir), "o_orderkey", "left")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")

    def rows(prefix, typ, pts, day_off, expiry, cond=None):
        b = base if cond is None else base.filter(cond)
        td = F.date_add(d, day_off)
        return b.select(
            F.concat(F.lit(prefix), k.cast("string")).alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            k.cast("string").alias("order_id"),
            typ.alias("type"),
            pts.cast("bigint").alias("points_change"),
            F.lit(None).cast("bigint").alias("balance_after"),
            _ds(td).alias("transaction_date"),
            _ts(F.timestamp_add("HOUR", F.lit(12), td.cast("timestamp_ntz"))).alias("transaction_timestamp"),
            (_ds(F.date_add(d, 365)) if expiry else F.lit(None).cast("string")).alias("expiry_date"),
            F.concat(F.lit("ORD"), k.cast("string")).alias("reference_code"),
            F.lit(None).cast("string").alias("notes"),
        )

    earn = rows("LE", F.when(k % 9 != 0, F.lit("EARN")), F.floor(F.col("_total") / 100), 0, True)
    redeem = rows("LR", F.lit("REDEEM"), -F.floor(F.col("_total") / 200), 3, False, k % 5 == 0)
    expire = rows("LX", F.lit("EXPIRE"), F.lit(-10), 365, False, k % 17 == 0)
    return _raw(earn.unionByName(redeem).unionByName(expire), "loyalty_points", RUN1, "b1")


# ---------------------------------------------------------------- sessions / cart / campaigns
def sessionized_events(spark, sf_dir) -> DataFrame:
    """events + session id: per user, ordered by (ts, event_id), a gap of
    more than 30 minutes starts a new session (two-level, skew-safe)."""
    from strata.operators.sequence import gap_sessions
    e = table(spark, sf_dir, "events")
    e = gap_sessions(e, "user_id", "ts", ["event_id"], F.expr("INTERVAL 30 MINUTES"), "_seq")
    return e.withColumn("session_id", F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"),
                                               F.col("_seq").cast("string")))


def raw_web_sessions(spark, sf_dir) -> DataFrame:
    e = sessionized_events(spark, sf_dir)
    s = e.groupBy("session_id", "user_id").agg(
        F.min("ts").alias("_start"), F.max("ts").alias("_end"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("event_type") == "view", 1).otherwise(0)).alias("_views"),
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("_purch"))
    u = F.col("user_id")
    f = s.select(
        F.col("session_id"),
        u.cast("string").alias("customer_id"),
        F.when(u % 3 == 0, "desktop").when(u % 3 == 1, "mobile").otherwise("tablet").alias("device_type"),
        F.when(u % 2 == 0, "chrome").otherwise("firefox").alias("browser"),
        F.lit("linux").alias("os"),
        F.when(u % 6 == 0, "organic").when(u % 6 == 1, "paid").when(u % 6 == 2, "email")
         .when(u % 6 == 4, "referral").when(u % 6 == 5, "social").alias("channel"),
        F.when((u % 6 == 1) | (u % 6 == 2), F.concat(F.lit("CMP"), (u % 10).cast("string"))).alias("campaign_id"),
        _ts(F.col("_start")).alias("session_start"),
        _ts(F.col("_end")).alias("session_end"),
        second_diff("_start", "_end").alias("duration_sec"),
        F.when(F.col("_views") > 0, F.col("_views")).cast("bigint").alias("page_views"),
        (F.col("_n") == 1).alias("is_bounce"),
        (F.col("_purch") == 1).alias("converted"),
        F.lit(None).cast("string").alias("order_id"),
        F.lit("/home").alias("landing_page"),
    )
    return _raw(f, "web_sessions", SESSION_RUN, None)


CART_TYPES = {"click": "add_to_cart", "error": "remove_from_cart", "view": "checkout_started"}


def raw_cart_events(spark, sf_dir) -> DataFrame:
    e = sessionized_events(spark, sf_dir)
    et = (F.when(F.col("event_type") == "click", "add_to_cart")
           .when(F.col("event_type") == "error", "remove_from_cart")
           .when(F.col("event_type") == "view", "checkout_started")
           .otherwise(F.col("event_type")))
    f = e.select(
        F.col("session_id"), F.col("user_id").cast("string").alias("customer_id"), et.alias("event_type"),
        F.col("event_id").cast("string").alias("event_id"), F.col("props").alias("props"),
        F.col("ts").alias("_load_ts"))
    return _raw(f, "cart_events", None, None, load_ts="column")


def raw_page_views(spark, sf_dir) -> DataFrame:
    e = sessionized_events(spark, sf_dir).filter(F.col("event_type") == "view")
    f = e.select(F.col("session_id"),
                 F.concat(F.lit("/p/"), F.get_json_object("props", "$.k")).alias("page_url"),
                 _ts(F.col("ts")).alias("viewed_at"),
                 F.col("ts").alias("_load_ts"))
    return _raw(f, "page_views", None, None, load_ts="column")


def raw_campaigns(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter((F.col("user_id") % 6 == 1) | (F.col("user_id") % 6 == 2))
    g = e.groupBy((F.col("user_id") % 10).alias("_c")).agg(
        F.count(F.lit(1)).alias("_imp"),
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("_clk"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("_conv"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("_spend"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,2)"))).alias("_rev"),
        F.min(F.to_date("ts")).alias("_s"), F.max(F.to_date("ts")).alias("_e"))
    c = F.col("_c")
    kinds = ["email", "sms", "social", "display", "search", "affiliate"]
    typ = F.when(c % 6 == 0, kinds[0])
    for i, kd in enumerate(kinds[1:], 1):
        typ = typ.when(c % 6 == i, kd)
    f = g.select(
        F.concat(F.lit("CMP"), c.cast("string")).alias("campaign_id"),
        F.concat(F.lit("Campaign "), c.cast("string")).alias("name"),
        typ.alias("type"),
        F.when(c % 2 == 0, "paid").otherwise("email").alias("channel"),
        _ds(F.col("_s")).alias("start_date"),
        _ds(F.col("_e")).alias("end_date"),
        (F.col("_spend") * 2).cast("decimal(18,2)").cast("double").alias("budget"),
        F.col("_spend").cast("double").alias("spend"),
        F.lit("ALL").alias("target_audience"),
        F.col("_imp").cast("bigint").alias("impressions"),
        F.col("_clk").cast("bigint").alias("clicks"),
        F.col("_conv").cast("bigint").alias("conversions"),
        (F.coalesce(F.col("_rev"), F.lit(0)) * 3).cast("decimal(18,2)").cast("double").alias("revenue_attributed"),
        F.lit(True).alias("is_active"),
    )
    return _raw(f, "campaigns", SESSION_RUN, "b1")


# ---------------------------------------------------------------- promotions / employees / addresses
def raw_promotions(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == 0)
    g = o.groupBy((F.col("o_orderkey") % 8).alias("_i")).agg(
        F.min(F.to_date("o_orderdate")).alias("_s"), F.max(F.to_date("o_orderdate")).alias("_e"),
        F.count(F.lit(1)).alias("_n"))
    i = F.col("_i")
    f = g.select(
        F.concat(F.lit("P"), i.cast("string")).alias("promotion_id"),
        F.concat(F.lit("Promo "), i.cast("string")).alias("name"),
        F.when(i % 4 == 0, "PERCENTAGE_OFF").when(i % 4 == 1, "FIXED_AMOUNT").when(i % 4 == 2, "BUY_X_GET_Y")
         .otherwise("FREE_SHIPPING").alias("type"),
        (i * 2.5 + 5).cast("double").alias("discount_value"),
        F.lit(50.0).alias("min_order_amount"),
        F.lit(100.0).alias("max_discount"),
        _ds(F.col("_s")).alias("start_date"),
        _ds(F.col("_e")).alias("end_date"),
        F.when(i % 2 == 1, "CATEGORY").alias("applies_to"),
        F.concat(F.lit("save"), i.cast("string")).alias("promo_code"),
        (i % 2 == 0).alias("is_stackable"),
        F.lit(True).alias("is_active"),
        F.when(i != 7, F.col("_n") * 2).cast("bigint").alias("usage_limit"),
        F.col("_n").cast("bigint").alias("times_used"),
    )
    return _raw(f, "promotions", RUN1, "b1")


def raw_employees(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.substring("o_orderpriority", 1, 1) == "3")
    g = o.groupBy((F.col("o_custkey") % 40).alias("_i")).agg(
        F.min(F.to_date("o_orderdate")).alias("_s"), F.max(F.to_date("o_orderdate")).alias("_e"))
    i = F.col("_i")
    titles = ["associate", "senior associate", "supervisor", "store manager"]
    title = F.when(i % 4 == 0, titles[0])
    for j, t in enumerate(titles[1:], 1):
        title = title.when(i % 4 == j, t)
    f = g.select(
        F.concat(F.lit("E"), i.cast("string")).alias("employee_id"),
        F.lit(" Emp ").alias("first_name"),
        i.cast("string").alias("last_name"),
        title.alias("job_title"),
        F.lit("SALES").alias("department"),
        F.concat(F.lit("S"), (i % 25).cast("string")).alias("store_id"),
        F.when(i >= 5, F.concat(F.lit("E"), (i % 5).cast("string"))).alias("manager_id"),
        _ds(F.date_sub(F.col("_s"), 30)).alias("hire_date"),
        F.when(i % 13 == 0, _ds(F.date_add(F.col("_e"), 30))).alias("termination_date"),
        F.when(i % 13 == 0, "TERMINATED").when(i % 7 == 0, F.lit(None)).otherwise("ACTIVE").alias("status"),
        F.when(i % 3 == 0, "FULL_TIME").when(i % 3 == 1, "PART_TIME").alias("employment_type"),
    )
    return _raw(f, "employees", RUN1, "b1")


def raw_addresses(spark, sf_dir) -> DataFrame:
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    k = F.col("c_custkey")
    nk = F.col("c_nationkey") % 4
    country = F.when(nk == 0, "US").when(nk == 1, "CA").when(nk == 2, "GB").otherwise("DE")

    def rows(suffix, typ, city_off, default, cond=None):
        b = c if cond is None else c.filter(cond)
        return b.select(
            F.concat(F.lit("A"), k.cast("string"), F.lit(suffix)).alias("address_id"),
            k.cast("string").alias("customer_id"),
            typ.alias("type"),
            F.concat(F.lit("  "), k.cast("string"), F.lit(" Elm St  ")).alias("line1"),
            F.lit(None).cast("string").alias("line2"),
            F.concat(F.lit("City "), ((k + city_off) % 37).cast("string")).alias("city"),
            F.concat(F.lit("ST"), F.col("c_nationkey").cast("string")).alias("state"),
            (k % 89999 + 10000).cast("string").alias("postal_code"),
            country.alias("country_code"),
            F.lit(default).alias("is_default"),
            (k % 2 == 0).alias("is_validated"),
            (F.col("c_nationkey") * 1.5).cast("double").alias("lat"),
            (F.col("c_nationkey") * -2.5).cast("double").alias("lon"),
        )

    first = rows("", F.when(k % 3 == 0, "BILLING").when(k % 3 == 1, "SHIPPING"), 0, True)
    second = rows("-2", F.lit("BILLING"), 1, False, k % 5 == 0)
    return _raw(first.unionByName(second), "addresses", RUN1, "b1")
