"""Gold dimensions G01-G10.  Band boundaries below are fixed values of the
warehouse model (they must equal the published definitions)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.compat import lit_date, pct, year_diff
from strata.operators.joins import bounded_broadcast

DATE_START = dt.date(2015, 1, 1)      # published spine
DATE_END = dt.date(2035, 12, 31)
# Fixed holiday marks: (month, day, name)
HOLIDAYS = [(1, 1, "New Year's Day"), (7, 4, "Independence Day"), (12, 25, "Christmas Day")]


def dim_date(spark: SparkSession, start: dt.date = DATE_START, end: dt.date = DATE_END,
             holidays=HOLIDAYS) -> DataFrame:
    """G01 + G01h: one row per day.  The spine is generated in parallel with
    ``spark.range`` (no driver-side list), holidays by a broadcast join to the
    3-row holiday table."""
    n = (end - start).days + 1
    d = F.date_add(lit_date(start), F.col("id").cast("int"))
    base = spark.range(0, n, numPartitions=max(1, min(8, n // 1000))).select(d.alias("full_date"))
    return _date_attributes(spark, base, holidays)


def dim_date_covering(sources: list[tuple[DataFrame, str]], end: dt.date = DATE_END,
                      holidays=HOLIDAYS) -> DataFrame:
    """G01 over the data: the spine starts on January 1 of the year of the
    earliest date found in ``sources`` ((frame, date column) pairs, each
    reduced to its minimum) and ends at the published end.  The spine is
    exploded from one aggregated row, so its size is bounded by the calendar,
    not by the data."""
    mins = None
    for df, c in sources:
        m = df.select(F.col(c).alias("_d")).agg(F.min("_d").alias("_d"))
        mins = m if mins is None else mins.unionByName(m)
    first = mins.agg(F.trunc(F.min("_d"), "year").alias("_s"))
    base = first.select(F.explode(F.sequence(F.col("_s"), lit_date(end), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _date_attributes(sources[0][0].sparkSession, base, holidays)


def _date_attributes(spark: SparkSession, base: DataFrame, holidays) -> DataFrame:
    fd = F.col("full_date")
    dow = F.weekday(fd) + 1
    q_start = F.trunc(fd, "quarter")
    y_start = F.trunc(fd, "year")
    m = F.month(fd)
    out = base.select(
        ((F.year(fd) * 10000 + m * 100 + F.dayofmonth(fd))).cast("bigint").alias("date_sk"),
        fd,
        dow.cast("bigint").alias("day_of_week"),
        F.dayname(fd).alias("day_name"),
        F.dayofmonth(fd).cast("bigint").alias("day_of_month"),
        F.dayofyear(fd).cast("bigint").alias("day_of_year"),
        F.weekofyear(fd).cast("bigint").alias("week_of_year"),
        F.weekofyear(fd).cast("bigint").alias("iso_week_number"),
        m.cast("bigint").alias("month_number"),
        F.monthname(fd).alias("month_name"),
        F.left(F.monthname(fd), F.lit(3)).alias("month_name_short"),
        F.quarter(fd).cast("bigint").alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(fd).cast("string")).alias("quarter_name"),
        F.year(fd).cast("bigint").alias("year_number"),
        F.when(m >= 2, F.year(fd)).otherwise(F.year(fd) - 1).cast("bigint").alias("fiscal_year"),
        F.when(m.between(2, 4), 1).when(m.between(5, 7), 2).when(m.between(8, 10), 3).otherwise(4)
         .cast("bigint").alias("fiscal_quarter"),
        (((m - 2 + 12) % 12) + 1).cast("bigint").alias("fiscal_month"),
        dow.isin(6, 7).alias("is_weekend"),
        (~dow.isin(6, 7)).alias("is_weekday"),
        F.trunc(fd, "week").alias("week_start_date"),
        F.date_add(F.trunc(fd, "week"), 6).alias("week_end_date"),
        F.trunc(fd, "month").alias("month_start_date"),
        F.last_day(fd).alias("month_end_date"),
        q_start.alias("quarter_start_date"),
        F.date_sub(F.add_months(q_start, 3), 1).alias("quarter_end_date"),
        y_start.alias("year_start_date"),
        F.date_sub(F.add_months(y_start, 12), 1).alias("year_end_date"),
        F.dayofmonth(F.last_day(fd)).cast("bigint").alias("days_in_month"),
        (fd == F.last_day(fd)).alias("is_last_day_of_month"),
    )
    hol = spark.createDataFrame(holidays, "h_month int, h_day int, holiday_name string")
    out = out.join(bounded_broadcast(hol, len(holidays)),
                   (F.col("month_number") == F.col("h_month")) & (F.col("day_of_month") == F.col("h_day")), "left")
    return out.withColumn("is_holiday", F.col("holiday_name").isNotNull()).drop("h_month", "h_day")


def age_band(age) -> F.Column:
    """Bands as published, plus UNKNOWN for a missing birth date."""
    return (F.when(age.isNull(), "UNKNOWN").when(age < 25, "18-24").when(age < 35, "25-34")
             .when(age < 45, "35-44").when(age < 55, "45-54").otherwise("55+"))


def dim_customers(customers: DataFrame, as_of) -> DataFrame:
    """Every version of every customer with age/tenure bands."""
    today = lit_date(as_of)
    age = year_diff("date_of_birth", today)
    days = F.datediff(today, F.col("registration_date"))
    return customers.select(
        "customer_sk", "customer_id", "first_name", "last_name", "full_name", "email", "phone",
        "date_of_birth", "gender", "customer_tier", "registration_date", "is_active",
        "effective_from", "effective_to", "is_current",
        age.alias("age_years"),
        age_band(age).alias("age_band"),
        days.cast("bigint").alias("days_as_customer"),
        F.when(days <= 30, "NEW").when(days <= 180, "DEVELOPING").when(days <= 365, "ESTABLISHED")
         .otherwise("VETERAN").alias("tenure_band"),
        F.year("registration_date").cast("bigint").alias("registration_year"),
    )


def dim_products(catalog: DataFrame) -> DataFrame:
    """Catalog + price and margin bands."""
    price, margin = F.col("unit_price"), F.col("margin_pct")
    return catalog.select(
        "product_sk", "product_id", "sku", "product_name", "brand", "category_id", "category_name",
        "parent_category_name", "top_category_name", "category_path", "supplier_id", "supplier_name",
        "unit_cost", "unit_price", "margin_pct", "is_active", "is_digital", "weight_kg",
        F.when(price < 10, "UNDER_$10").when(price < 25, "$10-$25").when(price < 50, "$25-$50")
         .when(price < 100, "$50-$100").when(price < 250, "$100-$250").when(price < 500, "$250-$500")
         .otherwise("OVER_$500").alias("price_band"),
        F.when(margin >= 60, "HIGH").when(margin >= 30, "MEDIUM").otherwise("LOW").alias("margin_band"),
    )


def dim_stores(stores: DataFrame, as_of) -> DataFrame:
    """G04."""
    sq = F.col("square_footage")
    return stores.select(
        "store_sk", "store_id", "store_name", "store_type", "address_line1", "city", "state_province",
        "postal_code", "country_code", "latitude", "longitude", "timezone", "opening_date", "closing_date",
        "is_active", "store_manager_id", "square_footage",
        year_diff("opening_date", lit_date(as_of)).alias("years_open"),
        F.when(sq >= 10000, "LARGE").when(sq >= 3000, "MEDIUM").otherwise("SMALL").alias("size_category"),
    )


def dim_employees(employees: DataFrame, as_of) -> DataFrame:
    """G05."""
    return employees.select(
        "employee_sk", "employee_id", "first_name", "last_name", "full_name", "job_title", "department",
        "store_id", "manager_id", "hire_date", "termination_date", "employment_status", "employment_type",
        "effective_from", "effective_to", "is_current",
        year_diff("hire_date", F.coalesce(F.col("termination_date"), lit_date(as_of))).alias("tenure_years"),
    )


def dim_suppliers(sup: DataFrame) -> DataFrame:
    """G06 (a NULL rating falls to PROBATION, as the CASE does)."""
    r = F.col("supplier_rating")
    return sup.select(
        "supplier_sk", "supplier_id", "supplier_name", "contact_name", "email", "phone", "country", "region",
        "payment_terms_days", "lead_time_days", "is_active", "supplier_rating",
        F.when(r >= 4.5, "PREFERRED").when(r >= 3.5, "APPROVED").when(r >= 2.5, "CONDITIONAL")
         .otherwise("PROBATION").alias("supplier_status_label"),
    )


def dim_promotions(p: DataFrame) -> DataFrame:
    """G07."""
    return p.select(
        "promotion_sk", "promotion_id", "promotion_name", "promotion_type", "discount_value",
        "min_order_amount", "max_discount_amount", "start_date", "end_date", "applies_to", "promo_code",
        "is_stackable", "is_active", "usage_limit", "times_used",
        F.datediff("end_date", "start_date").cast("bigint").alias("duration_days"),
        pct("times_used", "usage_limit").alias("usage_rate_pct"),
    )


def dim_categories(c: DataFrame) -> DataFrame:
    """Self left join for the parent name."""
    parent = c.select(F.col("category_id").alias("_p_id"), F.col("category_name").alias("parent_category_name"))
    j = c.join(parent, c.parent_category_id == parent._p_id, "left")
    return j.select("category_sk", "category_id", "category_name", "parent_category_id", "parent_category_name",
                    "category_level", "category_path", "is_active")


def dim_addresses(a: DataFrame) -> DataFrame:
    """Current versions only."""
    return a.filter(F.col("is_current")).select(
        "address_sk", "address_id", "customer_id", "address_type", "address_line1", "address_line2", "city",
        "state_province", "postal_code", "country_code", "is_default", "is_validated", "latitude", "longitude",
        "is_current")


def dim_campaigns(c: DataFrame) -> DataFrame:
    """Guarded ratios."""
    spend = F.col("spend_amount").cast("double")
    return c.select(
        "campaign_sk", "campaign_id", "campaign_name", "campaign_type", "channel", "start_date", "end_date",
        "budget_amount", "spend_amount", "target_audience", "impressions", "clicks", "conversions",
        "revenue_attributed", "is_active",
        F.datediff("end_date", "start_date").cast("bigint").alias("campaign_duration_days"),
        pct("clicks", "impressions").alias("ctr_pct"),
        pct("conversions", "clicks").alias("conversion_rate_pct"),
        F.when(F.col("conversions") > 0, spend / F.col("conversions").cast("double")).alias("cost_per_conversion"),
        F.when(spend > 0, (F.col("revenue_attributed").cast("double") - spend) / spend * 100).alias("roas_pct"),
    )
