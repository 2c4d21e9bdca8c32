"""Gold marts M26-M50.

Conventions that make results exact and scale-safe:
* money is summed as decimal and turned into double only at the end;
  averages are ``sum / count`` on those exact sums; averages of doubles are
  rounded to 6 places (summation order differs between engines);
* window functions run on the *aggregated* frame (one row per day / month /
  store-month ...), never on raw facts; global ranks over growing entities
  (products, customers, suppliers) use ``global_rank`` / ``global_ntile``;
* LAG(12) / LAG(52) are joins on the period key (D12), so a missing month
  never shifts the comparison;
* every fact is pre-aggregated to the join key before joining another fact
  (D9), so no measure is multiplied by a fan-out;
* ``COUNT(DISTINCT order_id)`` over an order-grain fact is a plain count
  (order_id is the fact's unique key), and ``COUNT(DISTINCT IF(is_first_order,
  customer_id))`` is a plain count too (each customer has exactly one first
  order).  Fewer distinct aggregates means fewer ``Expand`` projections in
  front of the shuffle; the oracle keeps the literal COUNT(DISTINCT ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.compat import lit_date, month_diff, strict_least
from strata.operators.joins import BOUND_DATE_DIM, bounded_broadcast
from strata.operators.keys import assign_keys, global_positions, global_rank
from strata.session import publish_once


def _d(c) -> F.Column:
    return F.col(c).cast("double")


def _avg(sum_col, n_col) -> F.Column:
    return _d(sum_col) / F.col(n_col)


def _ravg(c) -> F.Column:
    return F.round(F.avg(F.col(c).cast("double")), 6)


def _dates(dim_date: DataFrame, *cols) -> DataFrame:
    return bounded_broadcast(dim_date.select("date_sk", *cols), BOUND_DATE_DIM)


def _growth(cur, prev) -> F.Column:
    return F.when(prev > 0, (cur - prev) / prev * 100)


# ------------------------------------------------------------------ M26
def daily_sales(fs: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Day KPIs, day-over-day and 7/28-row moving averages (window over
    the day grain: at most one row per calendar day)."""
    d = _dates(dim_date, "full_date", "year_number", "quarter_name", "month_name", "week_of_year",
               "is_weekend", "is_holiday")
    g = (fs.join(d, "date_sk").groupBy("full_date", "year_number", "quarter_name", "month_name", "week_of_year",
                                        "is_weekend", "is_holiday")
         .agg(F.count("order_id").alias("total_orders"),
              F.count_distinct("customer_id").alias("unique_customers"),
              F.count(F.when(F.col("is_first_order"), F.col("customer_id"))).alias("new_customers"),
              F.sum("total_amount").alias("_rev"), F.sum("discount_amount").alias("_disc"),
              F.sum("tax_amount").alias("_tax"), F.sum("shipping_amount").alias("_ship"),
              F.sum("net_revenue").alias("_net"), F.count("total_amount").alias("_n"),
              F.count(F.when(F.col("promotion_id").isNotNull(), F.col("order_id"))).alias("promo_orders"),
              F.sum(F.when(F.col("promotion_id").isNotNull(), F.col("discount_amount")).otherwise(0)).alias("_pdisc")))
    w = Window.orderBy("full_date")
    prev = F.lag("_rev").over(w)
    return g.select(
        F.col("full_date").alias("sale_date"), "year_number", "quarter_name", "month_name", "week_of_year",
        "is_weekend", "is_holiday", "total_orders", "unique_customers", "new_customers",
        _d("_rev").alias("gross_revenue"), _d("_disc").alias("total_discounts"), _d("_tax").alias("total_tax"),
        _d("_ship").alias("total_shipping"), _d("_net").alias("net_revenue"),
        _avg("_rev", "_n").alias("avg_order_value"),
        F.when(F.col("unique_customers") > 0, _d("_rev") / F.col("unique_customers")).alias("revenue_per_customer"),
        "promo_orders", _d("_pdisc").alias("promo_discount_amount"),
        prev.cast("double").alias("prev_day_revenue"),
        (F.col("_rev") - prev).cast("double").alias("revenue_dod_change"),
        (F.sum("_rev").over(w.rowsBetween(-6, 0)).cast("double") / F.count("_rev").over(w.rowsBetween(-6, 0)))
        .alias("revenue_7d_rolling_avg"),
        (F.sum("_rev").over(w.rowsBetween(-27, 0)).cast("double") / F.count("_rev").over(w.rowsBetween(-27, 0)))
        .alias("revenue_28d_rolling_avg"),
    )


# ------------------------------------------------------------------ M27
def monthly_revenue(fs: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month KPIs, previous month (row), same month last year (period
    key), MoM/YoY %, year-to-date running sum."""
    d = _dates(dim_date, "year_number", "month_number", "month_name", "month_start_date", "month_end_date",
               "fiscal_year", "fiscal_month")
    g = (fs.join(d, "date_sk")
         .groupBy("year_number", "month_number", "month_name", "month_start_date", "month_end_date", "fiscal_year",
                  "fiscal_month")
         .agg(F.count("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"),
              F.sum("total_amount").alias("_rev"), F.sum("net_revenue").alias("_net"),
              F.sum("discount_amount").alias("_disc"), F.sum("tax_amount").alias("_tax"),
              F.sum("shipping_amount").alias("_ship"), F.count("total_amount").alias("_n"),
              F.count_distinct("store_id").alias("active_stores")))
    ly = g.select((F.col("year_number") + 1).alias("year_number"), "month_number", F.col("_rev").alias("_ly"))
    g = g.join(ly, ["year_number", "month_number"], "left")
    w = Window.orderBy("year_number", "month_number")
    prev = F.lag("_rev").over(w)
    return g.select(
        "year_number", "month_number", "month_name", "month_start_date", "month_end_date", "fiscal_year",
        "fiscal_month", "orders", "customers", _d("_rev").alias("gross_revenue"), _d("_net").alias("net_revenue"),
        _d("_disc").alias("discounts"), _d("_tax").alias("tax"), _d("_ship").alias("shipping_revenue"),
        _avg("_rev", "_n").alias("aov"), "active_stores",
        prev.cast("double").alias("prev_month_revenue"),
        (F.col("_rev") - prev).cast("double").alias("revenue_mom_change"),
        _growth(_d("_rev"), prev.cast("double")).alias("revenue_mom_pct"),
        _d("_ly").alias("same_month_ly_revenue"),
        _growth(_d("_rev"), _d("_ly")).alias("revenue_yoy_pct"),
        F.sum("_rev").over(Window.partitionBy("year_number").orderBy("month_number")).cast("double")
        .alias("ytd_revenue"),
    )


# ------------------------------------------------------------------ M28
def customer_ltv(orders: DataFrame, returns: DataFrame, dim_customers: DataFrame, as_of) -> DataFrame:
    """Lifetime value per customer (two grouped inputs, left joined)."""
    today = lit_date(as_of)
    os_ = (orders.filter(~F.col("order_status").isin("CANCELLED", "RETURNED"))
           .groupBy("customer_id")
           .agg(F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
                F.count("order_id").alias("total_orders"), F.sum("total_amount").alias("_rev"),
                F.count("total_amount").alias("_n"),
                F.round(F.stddev_samp(F.col("total_amount").cast("double")), 6).alias("order_value_stddev")))
    o_cust = orders.select(F.col("order_id").alias("_o_id"), F.col("customer_id").alias("_o_cust"))
    rs = (returns.join(o_cust, returns.order_id == F.col("_o_id"), "inner")
          .groupBy(F.col("_o_cust").alias("_r_cust"))
          .agg(F.count_distinct("return_id").alias("_ret"), F.sum("refund_amount").alias("_refund")))
    cur = dim_customers.filter(F.col("is_current")).select(
        F.col("customer_id").alias("_c_id"), "customer_sk", "full_name", "customer_tier", "registration_date")
    j = (os_.join(rs, os_.customer_id == F.col("_r_cust"), "left")
         .join(cur, os_.customer_id == F.col("_c_id"), "left"))
    life = F.datediff("last_order_date", "first_order_date")
    since = F.datediff(today, F.col("last_order_date"))
    aov = _avg("_rev", "_n")
    opy = F.when(life > 0, F.col("total_orders").cast("double") / (life.cast("double") / 365.0)) \
        .otherwise(F.col("total_orders").cast("double"))
    refunds = F.coalesce(F.col("_refund"), F.lit(0).cast("decimal(18,2)"))
    rev = F.col("_rev")
    return j.select(
        "customer_sk", "customer_id", "full_name", "customer_tier", "registration_date", "first_order_date",
        "last_order_date", "total_orders", _d("_rev").alias("lifetime_revenue"), aov.alias("avg_order_value"),
        life.cast("bigint").alias("customer_lifespan_days"), since.cast("bigint").alias("days_since_last_order"),
        "order_value_stddev",
        F.coalesce(F.col("_ret"), F.lit(0)).cast("bigint").alias("total_returns"),
        refunds.cast("double").alias("total_refunds"),
        (rev - refunds).cast("double").alias("net_lifetime_revenue"),
        opy.alias("orders_per_year"),
        (aov * opy * 3).alias("projected_clv_3yr"),
        F.when(since <= 30, "LOW").when(since <= 90, "MEDIUM").when(since <= 180, "HIGH").otherwise("CHURNED")
        .alias("churn_risk"),
        F.when(rev >= 10000, "PLATINUM").when(rev >= 2500, "GOLD").when(rev >= 500, "SILVER").otherwise("BRONZE")
        .alias("clv_tier"),
    )


# ------------------------------------------------------------------ M29
def product_performance(dim_products: DataFrame, foi: DataFrame, fr: DataFrame) -> DataFrame:
    """Items and reviews are aggregated per product *before* the join
    (D9: the reference multiplies lines by reviews); two global ranks.  Orders are counted
    apart from the sums, which would go with every pair of a product and an order."""
    bought = (foi.select(F.col("product_id").alias("_b_pid"), "order_id").distinct()
              .groupBy("_b_pid").agg(F.count("order_id").alias("orders_with_product")))
    items = (foi.groupBy(F.col("product_id").alias("_i_pid"))
             .agg(F.sum("quantity").alias("_units"), F.sum("line_total").alias("_gross"), F.sum("discount_amount").alias("_disc"),
                  F.sum(F.col("line_total") - F.col("discount_amount")).alias("_net"),
                  F.sum("unit_price").alias("_sp"), F.count("unit_price").alias("_spn"),
                  F.sum("gross_profit").alias("_gp"), _ravg("margin_pct").alias("avg_realized_margin_pct"),
                  F.sum(F.when(F.col("return_flag"), F.col("quantity")).otherwise(0)).alias("_ret_units")))
    revs = (fr.groupBy(F.col("product_id").alias("_r_pid"))
            .agg(F.count("review_id").alias("_rc"), F.sum("rating").alias("_rs"), F.count("rating").alias("_rn"),
                 F.sum(F.when(F.col("is_positive"), 1).otherwise(0)).alias("_pos"),
                 F.sum(F.when(F.col("is_negative"), 1).otherwise(0)).alias("_neg")))
    j = (dim_products.join(items, dim_products.product_id == F.col("_i_pid"), "left")
         .join(bought, dim_products.product_id == F.col("_b_pid"), "left")
         .join(revs, dim_products.product_id == F.col("_r_pid"), "left"))
    out = j.select(
        "product_id", "product_name", "brand", "category_name", "top_category_name", "unit_price", "unit_cost",
        F.col("margin_pct").alias("list_margin_pct"),
        F.col("_units").alias("total_units_sold"),
        F.coalesce("orders_with_product", F.lit(0)).alias("orders_with_product"),
        _d("_gross").alias("gross_revenue"), _d("_disc").alias("total_discounts"), _d("_net").alias("net_revenue"),
        (_d("_sp") / F.col("_spn")).alias("avg_selling_price"),
        _d("_gp").alias("total_gross_profit"), "avg_realized_margin_pct",
        F.coalesce("_rc", F.lit(0)).cast("bigint").alias("review_count"),
        (_d("_rs") / F.col("_rn")).alias("avg_rating"),
        F.coalesce("_pos", F.lit(0)).cast("bigint").alias("positive_reviews"),
        F.coalesce("_neg", F.lit(0)).cast("bigint").alias("negative_reviews"),
        F.col("_ret_units").alias("units_returned"),
        F.when(F.col("_units") > 0, _d("_ret_units") / _d("_units") * 100).alias("return_rate_pct"),
    )
    return global_positions(out, "product_id", {"revenue_rank": ("gross_revenue", "desc"), "units_rank": ("total_units_sold", "desc")})


# ------------------------------------------------------------------ M30
def store_monthly(fs: DataFrame, dim_stores: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Store x month; LAG per store, same month last year by key, rank
    inside the month (windows partitioned by store / by month)."""
    d = _dates(dim_date, "year_number", "month_number", "month_name", "month_start_date")
    s = bounded_broadcast(dim_stores.select("store_sk", "store_id", "store_name", "store_type", "city",
                                            "state_province", "country_code", "square_footage"), 10_000)
    keys = ["store_id", "store_name", "store_type", "city", "state_province", "country_code", "square_footage",
            "year_number", "month_number", "month_name", "month_start_date"]
    g = (fs.drop("store_id").join(s, "store_sk").join(d, "date_sk").groupBy(*keys)
         .agg(F.count("order_id").alias("orders"), F.count_distinct("customer_id").alias("unique_customers"),
              F.sum("total_amount").alias("_rev"), F.sum("net_revenue").alias("_net"),
              F.sum("discount_amount").alias("_disc"), F.count("total_amount").alias("_n"),
              F.count(F.when(F.col("is_first_order"), F.col("customer_id"))).alias("new_customers")))
    ly = g.select("store_id", (F.col("year_number") + 1).alias("year_number"), "month_number",
                  F.col("_rev").alias("_ly"))
    g = g.join(ly, ["store_id", "year_number", "month_number"], "left")
    w = Window.partitionBy("store_id").orderBy("year_number", "month_number")
    prev = F.lag("_rev").over(w).cast("double")
    return g.select(
        *keys, "orders", "unique_customers", _d("_rev").alias("gross_revenue"), _d("_net").alias("net_revenue"),
        _d("_disc").alias("discounts"), _avg("_rev", "_n").alias("aov"), "new_customers",
        F.when(F.col("square_footage") != 0, _d("_rev") / _d("square_footage")).alias("revenue_per_sqft"),
        prev.alias("prev_month_revenue"),
        _growth(_d("_rev"), prev).alias("mom_growth_pct"),
        _d("_ly").alias("same_month_ly"),
        _growth(_d("_rev"), _d("_ly")).alias("yoy_growth_pct"),
        F.rank().over(Window.partitionBy("year_number", "month_number").orderBy(F.col("_rev").desc_nulls_last()))
        .cast("bigint").alias("revenue_rank_in_period"),
    )


# ------------------------------------------------------------------ M31
def category_revenue(foi: DataFrame, dim_products: DataFrame, dim_categories: DataFrame,
                     dim_date: DataFrame) -> DataFrame:
    """Category x month with the share of the month (window over the
    aggregated rows).  D7: the top category comes from the category path.

    Lines are grouped by two numbers, the category's key and the month; names join the groups.  Each distinct
    count is an aggregate of its own over two or three columns: together they would expand every line to three
    rows, which carry all names and the buffers of all sums through sort and shuffle."""
    p = dim_products.select(F.col("product_id").alias("_p_id"), F.col("category_id").alias("_p_cat"))
    c = dim_categories.select("category_id", F.col("category_sk").alias("_cat"))
    d = _dates(dim_date.withColumn("_month", F.col("year_number") * 12 + F.col("month_number")), "_month")
    lines = (foi.join(p, foi.product_id == F.col("_p_id"), "inner")
             .join(c, F.col("_p_cat") == c.category_id, "inner").join(d, "date_sk"))
    g = (lines.groupBy("_cat", "_month")
         .agg(F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("_gross"), F.sum("discount_amount").alias("_disc"),
              F.sum(F.col("line_total") - F.col("discount_amount")).alias("_net"),
              F.sum("gross_profit").alias("_gp"), _ravg("margin_pct").alias("avg_margin_pct")))

    def distinct(column: str, name: str) -> DataFrame:
        return lines.select("_cat", "_month", column).distinct().groupBy("_cat", "_month").agg(F.count(column).alias(name))

    names = dim_categories.select(
        F.col("category_sk").alias("_cat"), "category_id", "category_name", "parent_category_name",
        F.split_part(F.col("category_path"), F.lit(" > "), F.lit(1)).alias("top_category_name"), "category_path")
    months = ["year_number", "quarter_name", "month_number", "month_name"]
    named = dim_date.select((F.col("year_number") * 12 + F.col("month_number")).alias("_month"), *months).distinct()
    g = (g.join(distinct("order_id", "orders"), ["_cat", "_month"]).join(distinct("product_id", "distinct_products_sold"), ["_cat", "_month"])
         .join(names, "_cat").join(bounded_broadcast(named, BOUND_DATE_DIM), "_month"))
    keys = ["category_id", "category_name", "parent_category_name", "top_category_name", "category_path", *months]
    month_total = F.sum("_gross").over(Window.partitionBy("year_number", "month_number"))
    return g.select(
        *keys, "orders", "units_sold", _d("_gross").alias("gross_revenue"), _d("_disc").alias("discounts"),
        _d("_net").alias("net_revenue"), _d("_gp").alias("gross_profit"), "avg_margin_pct",
        "distinct_products_sold",
        F.when(month_total != 0, _d("_gross") / month_total.cast("double") * 100).alias("category_revenue_share_pct"),
    )


# ------------------------------------------------------------------ M32
def top_customers(ltv: DataFrame, segments: DataFrame, as_of) -> DataFrame:
    """Three global ranks + revenue decile over the LTV mart, joined to
    today's segment.  All come from one narrow sort (``global_positions``); the decile
    breaks ties by customer id."""
    seg = segments.filter(F.col("segment_date") == lit_date(as_of)).select(
        F.col("customer_id").alias("_s_id"), "lifecycle_segment", "rfm_combined_score", "is_vip")
    j = ltv.join(seg, ltv.customer_id == F.col("_s_id"), "left").select(
        "customer_sk", "customer_id", "full_name", "customer_tier", "clv_tier", "churn_risk", "first_order_date",
        "last_order_date", "total_orders", "lifetime_revenue", "net_lifetime_revenue", "avg_order_value",
        "orders_per_year", "projected_clv_3yr", "total_returns", "total_refunds", "days_since_last_order",
        "lifecycle_segment", "rfm_combined_score", "is_vip")
    return global_positions(
        j, "customer_id", {"revenue_rank": ("lifetime_revenue", "desc"), "order_frequency_rank": ("total_orders", "desc"),
                           "clv_rank": ("projected_clv_3yr", "desc")}, {"revenue_decile": (10, "lifetime_revenue", "desc")})


# ------------------------------------------------------------------ M33
def top_products(pp: DataFrame) -> DataFrame:
    """Profit / rating ranks, revenue quartile, BCG quadrant."""
    j = pp.select("product_id", "product_name", "brand", "category_name", "top_category_name", "unit_price",
                  "list_margin_pct", "total_units_sold", "orders_with_product", "gross_revenue", "net_revenue",
                  "total_gross_profit", "avg_realized_margin_pct", "review_count", "avg_rating", "return_rate_pct",
                  "revenue_rank", "units_rank")
    j = global_positions(j, "product_id", {"profit_rank": ("total_gross_profit", "desc"), "rating_rank": ("avg_rating", "desc")},
                         {"revenue_quartile": (4, "gross_revenue", "desc")})
    rr, rk = F.col("return_rate_pct"), F.col("revenue_rank")
    return j.withColumn(
        "bcg_quadrant",
        F.when((rk <= 50) & (rr < 5), "STAR").when((rk <= 50) & (rr >= 5), "QUESTION_MARK")
         .when((rk > 50) & (rr < 5), "CASH_COW").otherwise("DOG"))


# ------------------------------------------------------------------ M34
def campaign_effectiveness(dim_campaigns: DataFrame, fws: DataFrame, fs: DataFrame) -> DataFrame:
    """Session metrics per campaign; tracked revenue counts each
    converted order once per campaign (D9); bounce rate in percent (D17)."""
    sess = (fws.groupBy(F.col("campaign_id").alias("_s_cam"))
            .agg(F.count_distinct("order_id").alias("orders_tracked"),
                 F.count_distinct("customer_sk").alias("unique_customers_reached"),
                 F.sum(F.when(F.col("converted"), F.col("session_duration_sec"))).alias("_dur"),
                 F.count(F.when(F.col("converted"), F.col("session_duration_sec"))).alias("_durn"),
                 F.sum("page_views").alias("total_page_views"),
                 F.sum(F.col("is_bounce").cast("int")).alias("_b"), F.count("is_bounce").alias("_bn")))
    conv = (fws.filter(F.col("converted") & F.col("order_id").isNotNull())
            .select(F.col("campaign_id").alias("_c_cam"), F.col("order_id").alias("_c_oid")).distinct())
    rev = (conv.join(fs.select("order_id", "total_amount"), F.col("_c_oid") == F.col("order_id"), "inner")
           .groupBy("_c_cam").agg(F.sum("total_amount").alias("_rev")))
    j = (dim_campaigns.join(sess, dim_campaigns.campaign_id == F.col("_s_cam"), "left")
         .join(rev, dim_campaigns.campaign_id == F.col("_c_cam"), "left"))
    spend = _d("spend_amount")
    roas = F.when(spend > 0, _d("revenue_attributed") / spend)
    out = j.select(
        "campaign_id", "campaign_name", "campaign_type", "channel", "start_date", "end_date",
        "campaign_duration_days", "budget_amount", "spend_amount", "impressions", "clicks", "conversions",
        "revenue_attributed", "ctr_pct", "conversion_rate_pct", "cost_per_conversion", "roas_pct",
        F.coalesce("orders_tracked", F.lit(0)).cast("bigint").alias("orders_tracked"),
        F.coalesce("unique_customers_reached", F.lit(0)).cast("bigint").alias("unique_customers_reached"),
        F.coalesce(F.col("_rev"), F.lit(0)).cast("double").alias("tracked_revenue"),
        F.when(F.col("_durn") > 0, _d("_dur") / F.col("_durn")).alias("avg_session_duration_converted"),
        "total_page_views",
        F.when(F.col("_bn") > 0, _d("_b") / F.col("_bn") * 100).alias("bounce_rate_pct"),
        roas.alias("roas_ratio"),
        F.when(spend > 0, (_d("revenue_attributed") - spend) / spend * 100).alias("roi_pct"),
        F.coalesce(roas, F.lit(0.0)).alias("_roas0"),
    )
    return global_rank(out, [("_roas0", "desc")], "roas_rank", unique_key="campaign_id").drop("_roas0")


# ------------------------------------------------------------------ M36
def inventory_health(fi: DataFrame, foi: DataFrame, dim_products: DataFrame, as_of) -> DataFrame:
    """Latest snapshot (scalar max joined as a one-row broadcast), 90-day
    sales velocity per product, status classification."""
    today = lit_date(as_of)
    latest = fi.agg(F.max("snapshot_date").alias("_mx"))
    inv = fi.join(F.broadcast(latest), fi.snapshot_date == F.col("_mx"), "inner")
    sv = (foi.filter(F.col("order_date") >= F.date_sub(today, 90))
          .groupBy(F.col("product_id").alias("_v_pid"))
          .agg(F.sum("quantity").alias("_q"), F.min("order_date").alias("_first")))
    vel = F.when(F.datediff(today, F.col("_first")) != 0,
                 _d("_q") / F.datediff(today, F.col("_first")).cast("double"))
    sv = sv.select("_v_pid", vel.alias("_vel"))
    p = dim_products.select(F.col("product_id").alias("_p_id"), "product_name", "brand", "category_name",
                            "supplier_name")
    j = (inv.join(p, inv.product_id == F.col("_p_id"), "left")
         .join(sv, inv.product_id == F.col("_v_pid"), "left"))
    avail, v = F.col("quantity_available"), F.col("_vel")
    cover = F.when(v != 0, avail.cast("double") / v)
    return j.select(
        "product_id", "product_name", "brand", "category_name", "supplier_name", "location_id", "location_type",
        "quantity_on_hand", "quantity_reserved", "quantity_available", "reorder_point", "reorder_quantity",
        "inventory_value", F.coalesce(v, F.lit(0.0)).alias("daily_sales_velocity"),
        F.when(v > 0, avail.cast("double") / v).alias("days_of_stock"),
        "is_out_of_stock", "is_below_reorder",
        F.when(avail == 0, "STOCKOUT").when(avail <= F.col("reorder_point"), "LOW_STOCK")
         .when(cover > 180, "OVERSTOCK").when((v < 0.1) & (F.col("quantity_on_hand") > 50), "SLOW_MOVER")
         .otherwise("HEALTHY").alias("inventory_status"),
        "snapshot_date")


# ------------------------------------------------------------------ M37
SUPPLIER_BLOCK = 4096


def _supplied(dim_suppliers: DataFrame, fso: DataFrame) -> DataFrame:
    """(product_id, _n): each product and the number of each of its suppliers, once.  The pairs are written, as their
    count a product, their arrays and their count a supplier would shuffle the purchase orders three times."""
    number = dim_suppliers.select(F.col("supplier_id").alias("_n_sup"), F.col("supplier_sk").cast("int").alias("_n"))
    pairs = fso.where("supplier_id is not null and product_id is not null").select("supplier_id", "product_id").distinct()
    return publish_once(pairs.join(number, F.col("supplier_id") == F.col("_n_sup")).select("product_id", "_n"))


def _returns_per_supplier(dim_suppliers: DataFrame, fso: DataFrame, foi: DataFrame, fr: DataFrame,
                          sp: DataFrame | None = None) -> DataFrame:
    """(_r_sup, _rc): distinct returns of orders that hold a product the supplier supplies.

    Returns are counted per order first (a return is one row of the fact).  A product's suppliers are one
    array, or one per hash block of about ``SUPPLIER_BLOCK``; an order's arrays meet on one row, where a supplier
    of several of its products counts once.  Pairs of a return and a supplier leave a task as counts only.
    ``sp`` are the pairs of ``_supplied``, made here if they are not given."""
    number = dim_suppliers.select(F.col("supplier_id").alias("_n_sup"), F.col("supplier_sk").cast("int").alias("_n"))
    sp = _supplied(dim_suppliers, fso) if sp is None else sp
    most = sp.groupBy("product_id").count().agg(F.max("count")).first()[0] or 1   # one number
    block = F.pmod(F.xxhash64("_n"), F.lit(-(-most // SUPPLIER_BLOCK)))
    sp = sp.groupBy(F.col("product_id").alias("_s_pid"), block.alias("_block")).agg(F.collect_list("_n").alias("_of"))
    returned = (fr.where(F.col("order_id").isNotNull()).groupBy(F.col("order_id").alias("_f_oid"))
                .agg(F.count("return_id").alias("_returns")))
    per_order = (foi.select("product_id", "order_id").join(returned, F.col("order_id") == F.col("_f_oid"))
                 .join(sp, F.col("product_id") == F.col("_s_pid"))
                 .groupBy("order_id", "_block")
                 .agg(F.array_distinct(F.flatten(F.collect_list("_of"))).alias("_all"), F.max("_returns").alias("_returns")))
    counts = (per_order.select(F.explode("_all").alias("_m"), "_returns").groupBy("_m")
              .agg(F.sum("_returns").alias("_rc")))
    return counts.join(number, F.col("_m") == F.col("_n")).select(F.col("_n_sup").alias("_r_sup"), "_rc")


def supplier_performance(dim_suppliers: DataFrame, fso: DataFrame, foi: DataFrame, fr: DataFrame) -> DataFrame:
    """Purchase-order KPIs per supplier, pre-aggregated (D9); returns
    are counted distinct through supplied products; lead time from the PO
    dates (D7).  Three distinct counts beside the sums would expand every purchase
    order to four rows: numbers are counted from one row a (supplier, number), products from the supplied pairs."""
    po = (fso.groupBy(F.col("supplier_id").alias("_po_sup"))
          .agg(F.sum("quantity_ordered").alias("total_units_ordered"),
               F.sum("quantity_received").alias("total_units_received"),
               F.sum("total_cost").alias("total_spend"),
               F.sum(F.datediff("actual_delivery", "order_date")).alias("_lt"),
               F.count(F.datediff("actual_delivery", "order_date")).alias("_ltn"),
               F.sum("delivery_variance_days").alias("_dv"), F.count("delivery_variance_days").alias("_dvn")))
    numbers = (fso.groupBy(F.col("supplier_id").alias("_no_sup"), "po_number").agg(F.max("is_late_delivery").alias("_late"))
               .groupBy("_no_sup").agg(F.count("po_number").alias("total_po_count"),
                                       F.count(F.when(F.col("_late"), F.col("po_number"))).alias("late_deliveries")))
    sp = _supplied(dim_suppliers, fso)
    products = sp.groupBy("_n").agg(F.count("product_id").alias("distinct_products"))
    rc = _returns_per_supplier(dim_suppliers, fso, foi, fr, sp)
    j = (dim_suppliers.join(po, dim_suppliers.supplier_id == F.col("_po_sup"), "left")
         .join(numbers, dim_suppliers.supplier_id == F.col("_no_sup"), "left")
         .join(products, dim_suppliers.supplier_sk == F.col("_n"), "left")
         .join(rc, dim_suppliers.supplier_id == F.col("_r_sup"), "left"))
    out = j.select(
        "supplier_id", "supplier_name", "country", "region", "supplier_rating", "supplier_status_label",
        "payment_terms_days", F.col("lead_time_days").alias("contracted_lead_days"),
        F.coalesce("total_po_count", F.lit(0)).cast("bigint").alias("total_po_count"),
        "total_units_ordered", "total_units_received", "total_spend",
        F.coalesce("late_deliveries", F.lit(0)).cast("bigint").alias("late_deliveries"),
        F.when(F.col("total_po_count") > 0, _d("late_deliveries") / _d("total_po_count") * 100)
         .alias("late_delivery_rate_pct"),
        (_d("_lt") / F.col("_ltn")).alias("avg_lead_time_actual"),
        (_d("_dv") / F.col("_dvn")).alias("avg_delivery_variance_days"),
        F.when(F.col("total_units_ordered") != 0, _d("total_units_received") / _d("total_units_ordered") * 100)
         .alias("fill_rate_pct"),
        F.coalesce("_rc", F.lit(0)).cast("bigint").alias("returns_from_supplier_products"),
        F.coalesce("distinct_products", F.lit(0)).cast("bigint").alias("distinct_products"))
    return global_rank(out, [("supplier_rating", "desc")], "rating_rank", unique_key="supplier_id")


# ------------------------------------------------------------------ M38
def cohorts(orders: DataFrame) -> DataFrame:
    """First-order month x activity month.  D11: the cohort size comes
    from the first orders alone, so retention is a real rate."""
    valid = orders.filter(~F.col("order_status").isin("CANCELLED", "RETURNED"))
    fo = valid.groupBy("customer_id").agg(F.trunc(F.min("order_date"), "month").alias("cohort_month"))
    size = fo.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"))
    act = (valid.groupBy("customer_id", F.trunc("order_date", "month").alias("activity_month"))
           .agg(F.sum("total_amount").alias("_rev"), F.count_distinct("order_id").alias("_orders")))
    g = (fo.join(act, "customer_id", "left")
         .groupBy("cohort_month", "activity_month")
         .agg(F.count_distinct("customer_id").alias("active_customers"), F.sum("_rev").alias("_rev"),
              F.sum("_orders").alias("cohort_orders")))
    g = g.join(size, "cohort_month", "left")
    return g.select(
        "cohort_month", "activity_month", month_diff("cohort_month", "activity_month").alias("months_since_first_order"),
        "cohort_size", "active_customers",
        F.when(F.col("cohort_size") > 0, _d("active_customers") / _d("cohort_size") * 100).alias("retention_rate_pct"),
        _d("_rev").alias("cohort_revenue"), "cohort_orders",
        F.when(F.col("active_customers") > 0, _d("_rev") / _d("active_customers")).alias("revenue_per_active_customer"))


# ------------------------------------------------------------------ M40
def employee_monthly(fes: DataFrame, links: DataFrame, orders: DataFrame, dim_employees: DataFrame,
                     dim_date: DataFrame) -> DataFrame:
    """Employee x month.  D17: customers served is a distinct count over
    the month (from the order links), not a sum of daily distinct counts, and
    the average transaction value is month sales / month orders (an average
    of daily averages would weight a one-order day like a fifty-order day)."""
    e = dim_employees.select("employee_sk", "employee_id", "full_name", "job_title", "department", "store_id")
    d = _dates(dim_date, "year_number", "month_number", "month_name")
    keys = ["employee_id", "full_name", "job_title", "department", "store_id", "year_number", "month_number",
            "month_name"]
    g = (fes.drop("employee_id", "store_id").join(e, "employee_sk").join(d, "date_sk").groupBy(*keys)
         .agg(F.sum("orders_taken").alias("orders_taken"), F.round(F.sum("total_sales_amount"), 2).alias("_sales"),
              F.round(F.sum("total_discounts_given"), 2).alias("_disc")))
    o = orders.select(F.col("order_id").alias("_o_id"), "customer_id", F.col("order_date").alias("_o_date"))
    served = (links.join(o, links.order_id == F.col("_o_id"))
              .groupBy(F.col("employee_id").alias("_c_emp"), F.year("_o_date").alias("_c_y"),
                       F.month("_o_date").alias("_c_m"))
              .agg(F.count_distinct("customer_id").alias("customers_served")))
    g = g.join(served, (g.employee_id == F.col("_c_emp")) & (g.year_number == F.col("_c_y"))
               & (g.month_number == F.col("_c_m")), "left")
    return g.select(
        *keys, "orders_taken", F.coalesce("customers_served", F.lit(0)).cast("bigint").alias("customers_served"),
        F.col("_sales").alias("total_sales"), F.col("_disc").alias("total_discounts_given"),
        F.when(F.col("orders_taken") > 0, F.col("_sales") / F.col("orders_taken")).alias("avg_transaction_value"),
        F.when(F.col("_sales") != 0, F.col("_disc") / F.col("_sales") * 100).alias("discount_rate_pct"),
        F.rank().over(Window.partitionBy("store_id", "year_number", "month_number")
                      .orderBy(F.col("_sales").desc_nulls_last())).cast("bigint").alias("store_sales_rank"),
        F.lag("_sales").over(Window.partitionBy("employee_id").orderBy("year_number", "month_number"))
        .alias("prev_month_sales"))


# ------------------------------------------------------------------ M41
def seasonal(fs: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Reference grain (month, week, holiday ...); the seasonality index
    is relative to the year's average row; last-year comparison and the
    4-week moving average are computed on the (year, week) aggregate (D12)."""
    d = _dates(dim_date, "month_number", "month_name", "quarter_number", "quarter_name", "week_of_year",
               "is_holiday", "holiday_name", "year_number")
    keys = ["month_number", "month_name", "quarter_number", "quarter_name", "week_of_year", "is_holiday",
            "holiday_name", "year_number"]
    j = fs.join(d, "date_sk")
    g = j.groupBy(*keys).agg(F.sum("total_amount").alias("_rev"), F.count("order_id").alias("order_count"),
                             F.count("total_amount").alias("_n"),
                             F.count_distinct("customer_id").alias("unique_customers"))
    wk = j.groupBy("year_number", "week_of_year").agg(F.sum("total_amount").alias("_wrev"))
    ww = Window.orderBy("year_number", "week_of_year").rowsBetween(-3, 0)
    wk = wk.select("year_number", "week_of_year", "_wrev",
                   (F.sum("_wrev").over(ww).cast("double") / F.count("_wrev").over(ww)).alias("revenue_4w_ma"))
    ly = wk.select((F.col("year_number") + 1).alias("year_number"), "week_of_year", F.col("_wrev").alias("_ly"))
    wk = wk.join(ly, ["year_number", "week_of_year"], "left").drop("_wrev")
    yw = Window.partitionBy("year_number")
    year_avg = F.sum("_rev").over(yw).cast("double") / F.count("_rev").over(yw)
    g = g.join(wk, ["year_number", "week_of_year"], "left")
    return g.select(
        *keys, _d("_rev").alias("total_revenue"), "order_count", _avg("_rev", "_n").alias("aov"), "unique_customers",
        F.when(year_avg != 0, _d("_rev") / year_avg * 100).alias("revenue_seasonality_index"),
        _d("_ly").alias("same_week_ly_revenue"), "revenue_4w_ma")


# ------------------------------------------------------------------ M42
def geo_performance(fs: DataFrame, dim_customers: DataFrame, dim_addresses: DataFrame,
                    dim_date: DataFrame) -> DataFrame:
    """One shipping address per customer (default first, then lowest id;
    D9), state share of the country computed at state grain (D17)."""
    addr = (dim_addresses.filter(F.col("address_type").isin("SHIPPING", "BOTH"))
            .groupBy(F.col("customer_id").alias("_a_cust"))
            .agg(F.min(F.struct((~F.col("is_default")).alias("nd"), "address_id", "country_code", "state_province",
                                "city")).alias("_a")))
    addr = addr.select("_a_cust", "_a.country_code", "_a.state_province", "_a.city")
    cur = dim_customers.select("customer_sk", F.col("customer_id").alias("_c_id"))
    d = _dates(dim_date, "year_number", "quarter_name", "month_number")
    keys = ["country_code", "state_province", "city", "year_number", "quarter_name", "month_number"]
    g = (fs.join(cur, "customer_sk").join(addr, F.col("_c_id") == F.col("_a_cust")).join(d, "date_sk")
         .groupBy(*keys)
         .agg(F.count("order_id").alias("orders"), F.count_distinct("customer_id").alias("unique_customers"),
              F.sum("total_amount").alias("_rev"), F.sum("net_revenue").alias("_net"),
              F.count("total_amount").alias("_n"), F.sum("discount_amount").alias("_disc")))
    state = F.sum("_rev").over(Window.partitionBy("year_number", "month_number", "country_code", "state_province"))
    country = F.sum("_rev").over(Window.partitionBy("year_number", "month_number", "country_code"))
    return g.select(
        *keys, "orders", "unique_customers", _d("_rev").alias("gross_revenue"), _d("_net").alias("net_revenue"),
        _avg("_rev", "_n").alias("aov"), _d("_disc").alias("total_discounts"),
        F.when(country != 0, state.cast("double") / country.cast("double") * 100).alias("state_share_of_country_pct"),
        F.rank().over(Window.partitionBy("year_number", "month_number").orderBy(F.col("_rev").desc_nulls_last()))
        .cast("bigint").alias("revenue_rank"))


# ------------------------------------------------------------------ M43
def channel_attribution(fs: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Channel x month; shares via windows over the aggregated rows."""
    d = _dates(dim_date, "year_number", "quarter_name", "month_number", "month_name")
    keys = ["channel", "year_number", "quarter_name", "month_number", "month_name"]
    g = (fs.join(d, "date_sk").groupBy(*keys)
         .agg(F.count("order_id").alias("orders"), F.count_distinct("customer_id").alias("unique_customers"),
              F.count(F.when(F.col("is_first_order"), F.col("customer_id"))).alias("new_customers_acquired"),
              F.sum("total_amount").alias("_rev"), F.sum("net_revenue").alias("_net"),
              F.count("total_amount").alias("_n"), F.sum("discount_amount").alias("_disc"),
              F.sum(F.when(F.col("order_status") == "RETURNED", F.col("total_amount")).otherwise(0)).alias("_ret")))
    p = Window.partitionBy("year_number", "month_number")
    tot, new_tot = F.sum("_rev").over(p), F.sum("new_customers_acquired").over(p)
    return g.select(
        *keys, "orders", "unique_customers", "new_customers_acquired", _d("_rev").alias("gross_revenue"),
        _d("_net").alias("net_revenue"), _avg("_rev", "_n").alias("aov"), _d("_disc").alias("total_discounts"),
        F.when(tot != 0, _d("_rev") / tot.cast("double") * 100).alias("channel_revenue_share_pct"),
        F.when(new_tot != 0, _d("new_customers_acquired") / new_tot.cast("double") * 100)
         .alias("new_customer_share_pct"),
        F.when(F.col("_rev") != 0, _d("_ret") / _d("_rev") * 100).alias("return_rate_pct"))


# ------------------------------------------------------------------ M44
def promotion_roi(dim_promotions: DataFrame, fpu: DataFrame) -> DataFrame:
    """Usage and ROI per promotion, ranked by ROI (NULLs last)."""
    u = (fpu.groupBy(F.col("promotion_id").alias("_u_pid"))
         .agg(F.count("order_id").alias("_times_used"),
              F.count_distinct("customer_id").alias("unique_customers_using"),
              F.count(F.when(F.col("is_first_order"), F.col("customer_id"))).alias("new_customers_acquired"),
              F.sum("subtotal_amount").alias("_basket"), F.count("subtotal_amount").alias("_bn"),
              F.sum("actual_discount_given").alias("_disc"), F.sum("total_amount").alias("_tot"),
              _ravg("effective_discount_pct").alias("avg_effective_discount_pct")))
    j = dim_promotions.join(u, dim_promotions.promotion_id == F.col("_u_pid"), "left")
    roi = F.when(F.col("_disc") != 0, (_d("_tot") - _d("_disc")) / _d("_disc") * 100)
    out = j.select(
        "promotion_id", "promotion_name", "promotion_type", "promo_code", "start_date", "end_date", "discount_value",
        "usage_limit", F.coalesce("_times_used", F.lit(0)).cast("bigint").alias("times_used"),
        F.coalesce("unique_customers_using", F.lit(0)).cast("bigint").alias("unique_customers_using"),
        F.coalesce("new_customers_acquired", F.lit(0)).cast("bigint").alias("new_customers_acquired"),
        _d("_basket").alias("total_basket_value"), _d("_disc").alias("total_discount_cost"),
        _d("_tot").alias("net_revenue_after_discount"), "avg_effective_discount_pct",
        (_d("_basket") / F.col("_bn")).alias("avg_basket_size"),
        F.when(F.col("_disc") != 0, _d("_tot") / _d("_disc")).alias("revenue_per_discount_dollar"),
        roi.alias("promotion_roi_pct"))
    return global_rank(out, [("promotion_roi_pct", "desc")], "roi_rank", unique_key="promotion_id")


# ------------------------------------------------------------------ M45
def churn_indicators(orders: DataFrame, ws: DataFrame, dim_customers: DataFrame, as_of) -> DataFrame:
    """M45 (D10: two steps).  The mean gap between consecutive orders
    telescopes to (last - first) / (orders - 1), so it is computed with
    map-side partial aggregation instead of a per-customer window (a customer
    with a third of all orders stays cheap)."""
    today = lit_date(as_of)
    cm = (orders.filter(F.col("order_status") != "CANCELLED").groupBy("customer_id")
          .agg(F.count("order_id").alias("total_orders"), F.sum("total_amount").alias("_rev"),
               F.max("order_date").alias("last_order_date"), F.min("order_date").alias("_first"),
               F.count(F.lit(1)).alias("_n"),
               F.count_distinct(F.trunc("order_date", "month")).alias("active_months")))
    sm = (ws.filter(F.col("session_start") >= F.date_sub(today, 90).cast("timestamp_ntz"))
          .groupBy(F.col("customer_id").alias("_s_cust"))
          .agg(F.count_distinct("session_id").alias("_sess"), F.max(F.to_date("session_start")).alias("last_visit_date")))
    cur = dim_customers.filter(F.col("is_current")).select(F.col("customer_id").alias("_c_id"), "customer_sk",
                                                             "full_name", "customer_tier")
    j = cm.join(sm, cm.customer_id == F.col("_s_cust"), "left").join(cur, cm.customer_id == F.col("_c_id"), "left")
    rec = F.datediff(today, F.col("last_order_date"))
    sess = F.coalesce(F.col("_sess"), F.lit(0))
    score = (F.when(rec > 365, 50).when(rec > 180, 35).when(rec > 90, 20).otherwise(0)
             + F.when(sess == 0, 25).when(sess <= 2, 15).otherwise(0)
             + F.when(F.col("total_orders") == 1, 15).when(F.col("total_orders") <= 3, 10).otherwise(0))
    return j.select(
        "customer_sk", "customer_id", "full_name", "customer_tier", "total_orders", _d("_rev").alias("lifetime_revenue"),
        "last_order_date", rec.cast("bigint").alias("recency_days"),
        F.when(F.col("_n") > 1, F.datediff("last_order_date", "_first").cast("double") / (F.col("_n") - 1))
         .alias("avg_days_between_orders"),
        "active_months", sess.cast("bigint").alias("sessions_last_90d"), "last_visit_date",
        F.coalesce("last_visit_date", "last_order_date").alias("last_activity_date"),
        strict_least(F.lit(100), score).cast("bigint").alias("churn_score"),
        F.when(rec > 365, "CHURNED").when((rec > 180) | (sess == 0), "HIGH_RISK").when(rec > 90, "AT_RISK")
         .otherwise("ACTIVE").alias("churn_segment"))


# ------------------------------------------------------------------ M46
def product_affinity(foi: DataFrame, dim_products: DataFrame, dim_customers: DataFrame, as_of) -> DataFrame:
    """Customer x top category (aggregate of aggregate); the per-customer
    total and rank run over at most one row per category, so lines are read and joined once."""
    today = lit_date(as_of)
    p = dim_products.select(F.col("product_id").alias("_p_id"), F.col("top_category_name").alias("category"))
    ccs = (foi.where(F.col("customer_id").isNotNull()).join(p, foi.product_id == F.col("_p_id")).groupBy("customer_id", "category")
           .agg(F.sum("line_total").alias("_spend"), F.count_distinct("order_id").alias("category_orders"),
                F.sum("quantity").alias("units_bought"), F.max("order_date").alias("last_purchase_in_category")))
    ccs = ccs.withColumn("_total", F.sum("_spend").over(Window.partitionBy("customer_id")))
    cur = dim_customers.filter(F.col("is_current")).select(F.col("customer_id").alias("_c_id"), "full_name",
                                                             "customer_tier")
    j = ccs.join(cur, F.col("customer_id") == F.col("_c_id"), "left")
    share = F.when(F.col("_total") != 0, _d("_spend") / _d("_total") * 100)
    days = F.datediff(today, F.col("last_purchase_in_category"))
    bonus = F.when(days <= 30, 10).when(days <= 90, 5).otherwise(0)
    return j.select(
        "customer_id", "full_name", "customer_tier", "category", _d("_spend").alias("category_spend"),
        "category_orders", "units_bought", "last_purchase_in_category", _d("_total").alias("total_spend"),
        share.alias("category_spend_share_pct"),
        F.rank().over(Window.partitionBy("customer_id").orderBy(F.col("_spend").desc_nulls_last()))
        .cast("bigint").alias("category_rank_for_customer"),
        strict_least(F.lit(100.0), share + bonus).alias("affinity_score"))


# ------------------------------------------------------------------ M47
def nps(fr: DataFrame, dim_products: DataFrame) -> DataFrame:
    """M47 by ROLLUP(month, top category, category) (D13) so the overall row
    the executive dashboard reads exists; ``grouping_level`` tells the level."""
    p = dim_products.select(F.col("product_id").alias("_p_id"), "category_name", "top_category_name")
    r = fr.join(p, fr.product_id == F.col("_p_id")).withColumn("review_month", F.trunc("review_date", "month"))
    prom = F.col("rating") >= 4
    det = F.col("rating") <= 2
    ver = F.col("is_verified_purchase")
    g = (r.rollup("review_month", "top_category_name", "category_name")
         .agg(F.count(F.lit(1)).alias("total_responses"),
              F.sum(F.when(prom, 1).otherwise(0)).alias("promoters"),
              F.sum(F.when(~prom & ~det, 1).otherwise(0)).alias("passives"),
              F.sum(F.when(det, 1).otherwise(0)).alias("detractors"),
              F.sum(F.when(ver, 1).otherwise(0)).alias("verified_responses"),
              F.sum(F.when(prom & ver, 1).otherwise(0)).alias("_vp"),
              F.sum(F.when(det & ver, 1).otherwise(0)).alias("_vd"),
              F.sum("rating").alias("_rs"), F.count("rating").alias("_rn"),
              F.grouping_id().alias("grouping_level")))
    return g.select(
        "review_month", "top_category_name", "category_name", F.col("grouping_level").cast("bigint"),
        F.col("total_responses").cast("bigint"), F.col("promoters").cast("bigint"), F.col("passives").cast("bigint"),
        F.col("detractors").cast("bigint"), F.col("verified_responses").cast("bigint"),
        F.when(F.col("total_responses") != 0, (_d("promoters") - _d("detractors")) / _d("total_responses") * 100)
         .alias("nps_score"),
        (_d("_rs") / F.col("_rn")).alias("avg_rating"),
        F.when(F.col("verified_responses") != 0, (_d("_vp") - _d("_vd")) / _d("verified_responses") * 100)
         .alias("verified_nps_score"))


# ------------------------------------------------------------------ M48
def fulfillment(fsh: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Exact percentiles (``percentile`` = PERCENTILE_CONT).  A shipment is one
    row of the fact, so shipments are counted, not counted distinct."""
    d = _dates(dim_date, "date_sk", "year_number", "quarter_name", "month_number", "month_name") \
        .withColumnRenamed("date_sk", "ship_date_sk")
    keys = ["carrier", "shipping_method", "destination_country", "year_number", "quarter_name", "month_number",
            "month_name"]
    g = (fsh.join(d, "ship_date_sk").groupBy(*keys)
         .agg(F.count("shipment_id").alias("total_shipments"),
              F.count(F.when(F.col("actual_delivery").isNotNull(), F.col("shipment_id"))).alias("delivered"),
              F.count(F.when(F.col("is_late"), F.col("shipment_id"))).alias("late_deliveries"),
              F.sum("days_to_deliver").alias("_dd"), F.count("days_to_deliver").alias("_ddn"),
              F.round(F.percentile("days_to_deliver", 0.5), 6).alias("median_days_to_deliver"),
              F.round(F.percentile("days_to_deliver", 0.9), 6).alias("p90_days_to_deliver"),
              F.sum("days_late").alias("_dl"), F.count("days_late").alias("_dln"),
              F.sum("shipping_cost").alias("_cost"), F.count("shipping_cost").alias("_cn"),
              F.sum("weight_kg").alias("_w"),
              F.sum(F.when(~F.col("is_late") | F.col("is_late").isNull(), 1).otherwise(0)).alias("_ontime"),
              F.count(F.lit(1)).alias("_all")))
    return g.select(
        *keys, "total_shipments", "delivered", "late_deliveries",
        F.when(F.col("delivered") != 0, _d("late_deliveries") / _d("delivered") * 100).alias("late_delivery_rate_pct"),
        (_d("_dd") / F.col("_ddn")).alias("avg_days_to_deliver"), "median_days_to_deliver", "p90_days_to_deliver",
        (_d("_dl") / F.col("_dln")).alias("avg_days_late"), _d("_cost").alias("total_shipping_cost"),
        (_d("_cost") / F.col("_cn")).alias("avg_shipping_cost"),
        F.when(F.col("_w") != 0, _d("_cost") / _d("_w")).alias("cost_per_kg"),
        (_d("_ontime") / F.col("_all") * 100).alias("on_time_delivery_pct"))


# ------------------------------------------------------------------ M49
def loyalty_performance(flt: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month x type; D16: redeemed counts REDEEM only (not EXPIRE)."""
    d = _dates(dim_date, "year_number", "month_number", "month_name", "month_start_date")
    keys = ["year_number", "month_number", "month_name", "month_start_date", "transaction_type"]
    pc = F.col("points_change")
    g = (flt.join(d, "date_sk").groupBy(*keys)
         .agg(F.count_distinct("transaction_id").alias("transactions"),
              F.count_distinct("customer_id").alias("active_members"),
              F.sum(pc).alias("total_points_change"),
              F.sum(F.when(pc > 0, pc).otherwise(0)).alias("points_earned"),
              F.sum(F.when(F.col("transaction_type") == "REDEEM", F.abs(pc)).otherwise(0)).alias("points_redeemed"),
              F.sum(F.when(F.col("transaction_type") == "EXPIRE", F.abs(pc)).otherwise(0)).alias("points_expired"),
              F.sum("points_balance_after").alias("_bal"), F.count("points_balance_after").alias("_baln")))
    red, exp = F.col("points_redeemed"), F.col("points_expired")
    return g.select(
        *keys, "transactions", "active_members", "total_points_change", "points_earned", "points_redeemed",
        "points_expired", (_d("_bal") / F.col("_baln")).alias("avg_member_balance"),
        (_d("points_earned") * 0.01).alias("estimated_points_liability_earned"),
        (_d("points_redeemed") * 0.01).alias("estimated_points_redeemed_value"),
        F.when((red + exp) != 0, _d("points_redeemed") / (red + exp).cast("double") * 100).alias("redemption_rate_pct"))


# ------------------------------------------------------------------ M35
def return_rates(fr: DataFrame, foi: DataFrame, dim_products: DataFrame, dim_date: DataFrame) -> DataFrame:
    """M35 (D24, D9): numerators are returns broken down by reason, with each
    return's refund allocated to its order's lines by line-total share;
    denominators come from *all* orders/lines of the same month x category x
    brand slice.  Allocations are whole cents, rounded half up with integer
    arithmetic (``(2*refund*line + total) div (2*total)``), so every sum is
    exact.

    A slice is two numbers, its kind (category and brand) and its month; names join the results.  Lines are
    shuffled by order once, with returns beside them: an order's total is a window, and every line meets the returns of its order
    there, or none.  What leaves is sums by slice and reason, for returns and orders alike: ``_head`` marks one line of each slice
    of an order, where an order or a return counts, ``_nth`` numbers an order's returns, as a line counts once."""
    kind_names, month_names = ["category_name", "top_category_name", "brand"], ["year_number", "quarter_name", "month_name"]
    slice_keys = month_names + kind_names
    # a slice without one of its names is no row of the result, its lines are part of their orders' totals
    kinds = assign_keys(dim_products.select(*kind_names).dropna().distinct(), [F.col(c) for c in kind_names], "_kind")
    p = dim_products.select(F.col("product_id").alias("_p_id"), *kind_names).join(kinds, kind_names, "left").select("_p_id", "_kind")
    month = F.col("year_number") * 12 + F.col("month_number")
    d = _dates(dim_date.withColumn("_month", month), "_month")
    lines = (foi.select("order_id", "product_id", "line_total", "date_sk")
             .join(p, F.col("product_id") == F.col("_p_id"), "inner").join(d, "date_sk")
             .select("order_id", "_kind", "_month", "line_total").repartition("order_id"))
    head = F.row_number().over(Window.partitionBy("order_id", "_kind", "_month").orderBy("line_total")) == 1
    of_order = (lines.withColumn("_line", (F.col("line_total") * 10000).cast("bigint")).withColumn("_head", head)
                .withColumn("_order_total", F.sum("_line").over(Window.partitionBy("order_id"))).where("_kind is not null"))
    r = fr.where("order_id is not null").select(
        F.col("order_id").alias("_r_oid"), "return_id", "return_reason",
        (F.col("refund_amount") * 100).cast("bigint").alias("_refund_cents"), "refund_method", "days_to_return")
    r = r.withColumn("_nth", F.row_number().over(Window.partitionBy("_r_oid").orderBy("return_id")))
    alloc = (of_order.join(r, F.col("order_id") == F.col("_r_oid"), "left")
             .withColumn("_a", F.when(F.col("_order_total") != 0, F.expr(
                 "(2 * _refund_cents * _line + _order_total) div (2 * _order_total)")))
             .withColumn("_days", F.when(F.col("_head"), F.col("days_to_return"))))
    once = F.coalesce(F.col("_nth"), F.lit(1)) == 1
    sums = (alloc.groupBy("_kind", "_month", F.col("_nth").isNotNull().alias("_returned"), "return_reason")
            .agg(F.count(F.when(F.col("_head"), F.col("return_id"))).alias("total_returns"), F.sum("_a").alias("_refund"),
                 F.count(F.when(F.col("_head") & once, F.col("order_id"))).alias("_orders"),
                 F.sum(F.when(once, F.col("line_total"))).alias("_rev"),
                 F.sum("_days").alias("_ds"), F.count("_days").alias("_dn"),
                 F.sum(F.when(F.col("refund_method") == "ORIGINAL_PAYMENT", F.col("_a")).otherwise(0)).alias("_card"),
                 F.sum(F.when(F.col("refund_method") == "STORE_CREDIT", F.col("_a")).otherwise(0)).alias("_credit")))
    of_slice = Window.partitionBy("_kind", "_month")
    sums = (sums.withColumn("total_orders_in_period", F.sum("_orders").over(of_slice))
            .withColumn("_slice_rev", F.sum("_rev").over(of_slice)).where("_returned"))
    named = dim_date.select(month.alias("_month"), *month_names).distinct()
    j = (sums.join(kinds, "_kind")
         .join(bounded_broadcast(named, BOUND_DATE_DIM), "_month"))
    cents = lambda c: (F.col(c).cast("decimal(38,0)") / 100).cast("decimal(20,2)")
    return j.select(
        *slice_keys, "return_reason", "total_returns", "total_orders_in_period",
        cents("_refund").alias("total_refund_amount"),
        F.when(F.col("total_orders_in_period") != 0, _d("total_returns") / _d("total_orders_in_period") * 100)
         .alias("order_return_rate_pct"),
        F.when(F.col("_slice_rev") != 0, _d("_refund") / (_d("_slice_rev") * 100) * 100).alias("revenue_return_rate_pct"),
        (_d("_ds") / F.col("_dn")).alias("avg_days_to_return"),
        cents("_card").alias("refunded_to_card"), cents("_credit").alias("refunded_as_credit"))


# ------------------------------------------------------------------ M50
def _kpis(df: DataFrame, cols: dict) -> DataFrame:
    """One-row aggregate -> long (kpi, value) rows (no join needed later)."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kpi"), v.cast("double").alias("value"))
                                         for k, v in cols.items()])).alias("_k")).select("_k.*")


def executive_dashboard(fs: DataFrame, orders: DataFrame, returns: DataFrame, fi: DataFrame,
                        loyalty: DataFrame, nps_mart: DataFrame, as_of) -> DataFrame:
    """One row of headline KPIs for the as-of month.

    The three month joins of the reference become one conditional-aggregate
    pass over the sales fact; the other KPIs are one-row aggregates.  All are
    stacked into (kpi, value) rows and pivoted by one global aggregate, so no
    cross join is needed.  D13: the 30-day return rate is returned orders /
    all orders of the last 30 days; the overall NPS is the month-level
    ROLLUP row of the NPS mart.  Total lifetime revenue sums the same order
    set the lifetime-value mart sums (non-cancelled, non-returned)."""
    today = lit_date(as_of)
    cur = F.trunc(today, "month")
    prev, ly = F.add_months(cur, -1), F.add_months(cur, -12)
    m = F.trunc("order_date", "month")
    t = F.col("total_amount")
    sales = fs.agg(
        F.sum(F.when(m == cur, t)).alias("mtd_revenue"),
        F.count(F.when(m == cur, F.col("order_id"))).alias("mtd_orders"),
        F.count_distinct(F.when(m == cur, F.col("customer_id"))).alias("mtd_customers"),
        F.count(F.when(m == cur, t)).alias("_mn"),
        F.sum(F.when(m == prev, t)).alias("prev_month_revenue"),
        F.sum(F.when(m == ly, t)).alias("same_month_ly_revenue"),
        F.sum(F.when(F.col("order_date") >= F.trunc(today, "year"), t)).alias("ytd_revenue"),
        F.count(F.when(F.col("order_date") >= F.trunc(today, "year"), F.col("order_id"))).alias("ytd_orders"),
        F.count_distinct(F.when(F.col("order_date") >= F.date_sub(today, 90), F.col("customer_id")))
         .alias("active_customers_90d"),
        F.sum(F.when(~F.col("order_status").isin("CANCELLED", "RETURNED"), t)).alias("total_customer_lifetime_revenue"))
    k1 = _kpis(sales, {c: F.col(c) for c in ["mtd_revenue", "mtd_orders", "mtd_customers", "prev_month_revenue",
                                              "same_month_ly_revenue", "ytd_revenue", "ytd_orders",
                                              "active_customers_90d", "total_customer_lifetime_revenue"]}
               | {"mtd_aov": F.when(F.col("_mn") > 0, _d("mtd_revenue") / F.col("_mn"))})
    latest = fi.agg(F.max("snapshot_date").alias("_mx"))
    inv = fi.join(F.broadcast(latest), fi.snapshot_date == F.col("_mx"), "inner").agg(
        F.sum("inventory_value").alias("v"))
    k2 = _kpis(inv, {"current_inventory_value": F.col("v")})
    returned = returns.select(F.col("order_id").alias("_ro")).distinct()
    o30 = (orders.filter(F.col("order_date") >= F.date_sub(today, 30)).select("order_id")
           .join(returned, F.col("order_id") == F.col("_ro"), "left"))
    rr = o30.agg(F.count_distinct("order_id").alias("n"), F.count_distinct(F.when(F.col("_ro").isNotNull(),
                                                                                  F.col("order_id"))).alias("r"))
    k3 = _kpis(rr, {"return_rate_30d_pct": F.when(F.col("n") > 0, _d("r") / _d("n") * 100)})
    nps_prev = nps_mart.filter((F.col("grouping_level") == 3) & (F.col("review_month") == prev)).agg(
        F.max("nps_score").alias("v"))
    k4 = _kpis(nps_prev, {"overall_nps_prev_month": F.col("v")})
    k5 = _kpis(loyalty.agg(F.count_distinct("customer_id").alias("v")), {"total_loyalty_members": F.col("v")})
    long = k1.unionByName(k2).unionByName(k3).unionByName(k4).unionByName(k5)

    def kv(name):
        return F.max(F.when(F.col("kpi") == name, F.col("value")))

    counts = ["mtd_orders", "mtd_customers", "ytd_orders", "active_customers_90d", "total_loyalty_members"]
    names = ["mtd_revenue", "mtd_orders", "mtd_customers", "mtd_aov", "prev_month_revenue", "same_month_ly_revenue",
             "ytd_revenue", "ytd_orders", "active_customers_90d", "total_customer_lifetime_revenue",
             "current_inventory_value", "return_rate_30d_pct", "overall_nps_prev_month", "total_loyalty_members"]
    wide = long.agg(*[(kv(n).cast("bigint") if n in counts else kv(n)).alias(n) for n in names])
    c, p_, l_ = F.col("mtd_revenue"), F.col("prev_month_revenue"), F.col("same_month_ly_revenue")
    return wide.select(
        today.alias("report_date"), cur.alias("cur_month"), "mtd_revenue", "mtd_orders", "mtd_customers", "mtd_aov",
        "prev_month_revenue", F.when(p_ != 0, (c - p_) / p_ * 100).alias("revenue_mom_pct"),
        "same_month_ly_revenue", F.when(l_ != 0, (c - l_) / l_ * 100).alias("revenue_yoy_pct"),
        "ytd_revenue", "ytd_orders", "active_customers_90d", "total_customer_lifetime_revenue",
        "current_inventory_value", "return_rate_30d_pct", "overall_nps_prev_month", "total_loyalty_members")
