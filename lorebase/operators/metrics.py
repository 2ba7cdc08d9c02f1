"""The business questions: revenue, customers, conversion, churn, trends, anomalies, forecasts.

`orders` needs (order_id, customer_id, order_date, order_amount, order_status), `customers`
(customer_id, customer_name, customer_segment, region). "Now" is always `as_of`, by default
the last order day of the data. Orders are added up per customer before they meet the
customers, so a customer with very many orders weighs no more than any other in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lorebase.functions.rules import churn_label, fiscal_quarter, fiscal_year, quarter_end, quarter_start
from lorebase.operators.skew import running_number


def completed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "completed")


def day_or_last(orders: DataFrame, as_of: str | None = None):
    """`as_of` as a date, or the last order day, looked up first so that the bounds made from it are constants."""
    last = as_of or orders.agg(F.max("order_date")).first()[0]
    return F.lit(last).cast("date")


def _days(orders: DataFrame, first, end) -> DataFrame:
    """Orders from the day `first` on and before the day `end`; on the stored time as well, where there is one."""
    within = (F.col("order_date") >= first) & (F.col("order_date") < end)
    if "ordered_at" in orders.columns:
        kind = orders.schema["ordered_at"].dataType
        within &= (F.col("ordered_at") >= first.cast(kind)) & (F.col("ordered_at") < end.cast(kind))
    return orders.filter(within)


def _money(amount):
    return F.round(amount, 2)


def _share(part, whole):
    return F.round(F.try_divide(part * F.lit(100.0), whole), 4)


def _spend(orders: DataFrame, *by) -> DataFrame:
    """Completed amounts and order counts per customer and `by`."""
    return (
        completed(orders)
        .groupBy("customer_id", *by)
        .agg(F.sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )


def _month(day):
    return F.trunc(day, "month")


# --- revenue ----------------------------------------------------------------------------


def total_revenue(orders: DataFrame) -> DataFrame:
    return completed(orders).agg(_money(F.sum("order_amount")).alias("revenue"))


def top_customers(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    spend = _spend(orders)
    return (
        customers.join(spend, "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "customer_segment",
            _money(F.col("amount")).alias("total_revenue"),
            F.col("n").alias("order_count"),
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(k)
    )


def top_customers_ytd(customers: DataFrame, orders: DataFrame, k: int = 10, as_of: str | None = None) -> DataFrame:
    day = day_or_last(orders, as_of)
    this_year = _days(orders, F.trunc(day, "year"), F.date_add(day, 1))
    return top_customers(customers, this_year, k)


def revenue_region_month(customers: DataFrame, orders: DataFrame, months: int = 12, as_of: str | None = None) -> DataFrame:
    """Revenue by month and region over the last `months` months, the current one included."""
    day = day_or_last(orders, as_of)
    window = _days(orders, F.add_months(_month(day), 1 - months), F.date_add(day, 1))
    spend = _spend(window, _month(F.col("order_date")).alias("month"))
    return _by_region(customers, spend, "month")


def _by_region(customers: DataFrame, spend: DataFrame, *by: str) -> DataFrame:
    return (
        spend.join(customers.select("customer_id", "region"), "customer_id")
        .groupBy(*by, "region")
        .agg(_money(F.sum("amount")).alias("revenue"), F.sum("n").alias("order_count"))
    )


def revenue_quarter_region(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Revenue of the last full quarter by region."""
    day = day_or_last(orders, as_of)
    start = F.add_months(quarter_start(day), -3)
    window = _days(orders, start, quarter_start(day))
    return _by_region(customers, _spend(window, quarter_start(F.col("order_date")).alias("quarter_start")), "quarter_start")


def _categorised(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Completed orders with a category; orders without lines get 'none'."""
    return (
        completed(orders)
        .join(lines.select("order_id", "product_category"), "order_id", "left")
        .withColumn("product_category", F.coalesce("product_category", F.lit("none")))
    )


def revenue_drilldown(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue by region, by region and category, and in total; `level` counts the columns rolled up."""
    spend = (
        _categorised(orders, lines)
        .groupBy("customer_id", "product_category")
        .agg(F.sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )
    cells = (
        spend.join(customers.select("customer_id", "region"), "customer_id")
        .groupBy("region", "product_category")
        .agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))
    )
    return cells.rollup("region", "product_category").agg(
        _money(F.sum("amount")).alias("revenue"),
        F.sum("n").alias("order_count"),
        F.when(F.grouping_id() == 3, 2).when(F.grouping_id() == 1, 1).otherwise(0).alias("level"),
    )


def revenue_category_month(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return (
        _categorised(orders, lines)
        .groupBy(_month(F.col("order_date")).alias("month"), "product_category")
        .agg(_money(F.sum("order_amount")).alias("revenue"), F.count(F.lit(1)).alias("order_count"))
    )


def revenue_by_product(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Net line revenue of completed orders per product.

    `lineitem` needs (order_id, part_id, price, discount, quantity). The lines are added up
    per product before they meet `part`. Adaptive execution splits an order with very many
    lines: the semi join may split its left side, and nothing above relies on its layout.
    """
    lines = lineitem.join(completed(orders).select("order_id"), "order_id", "left_semi")
    per_part = lines.groupBy("part_id").agg(
        F.sum(F.col("price") * (1 - F.col("discount"))).alias("net"), F.sum("quantity").alias("units")
    )
    return per_part.join(part.select("part_id", "product_name", "product_category"), "part_id").select(
        "part_id", "product_name", "product_category", F.round("net", 4).alias("revenue"), F.round("units", 2).alias("units")
    )


def _quarterly_by_region(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return _by_region(customers, _spend(orders, quarter_start(F.col("order_date")).alias("quarter_start")), "quarter_start")


def revenue_yoy_quarter(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Each quarter and region against the same quarter a year before.

    Matched by date, not by position, so a missing quarter shifts nothing.
    """
    now = _quarterly_by_region(customers, orders).select("region", "quarter_start", "revenue")
    before = now.select(
        "region", F.add_months("quarter_start", 12).alias("quarter_start"), F.col("revenue").alias("revenue_year_before")
    )
    return now.join(before, ["region", "quarter_start"], "left").select(
        "region",
        fiscal_year(F.col("quarter_start")).alias("fiscal_year"),
        fiscal_quarter(F.col("quarter_start")).alias("fiscal_quarter"),
        "revenue",
        "revenue_year_before",
        _share(F.col("revenue") - F.col("revenue_year_before"), F.col("revenue_year_before")).alias("growth_pct"),
    )


def region_growth(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """The region that grew most from the last full quarter but one to the last full quarter."""
    day = day_or_last(orders, as_of)
    last = F.add_months(quarter_start(day), -3)
    two = _days(orders, F.add_months(quarter_start(day), -6), quarter_start(day))
    by_quarter = _quarterly_by_region(customers, two)
    in_order = W.partitionBy("region").orderBy("quarter_start")
    return (
        by_quarter.withColumn("previous_revenue", F.lag("revenue").over(in_order))
        .filter(F.col("quarter_start") == last)
        .select(
            "region",
            "previous_revenue",
            "revenue",
            _share(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue")).alias("growth_pct"),
        )
        .orderBy(F.desc_nulls_last("growth_pct"), "region")
        .limit(1)
    )


def _spine(table: DataFrame, column: str, step: str) -> DataFrame:
    """All steps from the first to the last value of a date column, one row each."""
    return table.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr(step))).alias(column)
    )


def revenue_trend(orders: DataFrame) -> DataFrame:
    """Monthly revenue with the month before and the mean of three months; empty months count as 0.

    The windows run over months, a handful of rows.
    """
    monthly = completed(orders).groupBy(_month(F.col("order_date")).alias("month")).agg(
        F.sum("order_amount").alias("amount")
    )
    filled = _spine(monthly, "month", "interval 1 month").join(monthly, "month", "left").select(
        "month", _money(F.coalesce("amount", F.lit(0.0))).alias("revenue")
    )
    order = W.orderBy("month")
    return filled.select(
        "month",
        "revenue",
        F.lag("revenue").over(order).alias("previous_revenue"),
        F.round(F.avg("revenue").over(order.rowsBetween(-2, 0)), 6).alias("moving_mean"),
    )


def daily_sales_anomalies(orders: DataFrame, days: int = 28, limit: float = 3.0) -> DataFrame:
    """Days whose revenue lies more than `limit` deviations from the `days` days before them.

    Days without sales count as 0; the first days, without a full history, are not judged.
    The windows run over days.
    """
    daily = completed(orders).groupBy("order_date").agg(F.sum("order_amount").alias("amount"))
    filled = _spine(daily, "order_date", "interval 1 day").join(daily, "order_date", "left").select(
        F.col("order_date").alias("day"), _money(F.coalesce("amount", F.lit(0.0))).alias("revenue")
    )
    return _unusual_days(filled, days, limit)


def daily_sales_anomalies_last_month(orders: DataFrame, days: int = 28, limit: float = 3.0, as_of: str | None = None) -> DataFrame:
    """The days of the last full month that `daily_sales_anomalies` would tell.

    Only that month and the `days` days before it are read. Days without sales, at the end of the month too, count as 0
    from the first day that has any.
    """
    day = day_or_last(orders, as_of)
    start = F.add_months(_month(day), -1)
    read_from = F.date_sub(start, days)
    daily = _days(completed(orders), read_from, _month(day)).groupBy("order_date").agg(F.sum("order_amount").alias("amount"))
    first = completed(orders).agg(F.min("order_date").alias("first"))
    spine = first.select(F.explode(F.sequence(F.greatest("first", read_from), F.date_sub(_month(day), 1))).alias("order_date"))
    filled = spine.join(daily, "order_date", "left").select(
        F.col("order_date").alias("day"), _money(F.coalesce("amount", F.lit(0.0))).alias("revenue")
    )
    return _unusual_days(filled, days, limit).filter(F.col("day") >= start)


def _unusual_days(filled: DataFrame, days: int, limit: float) -> DataFrame:
    """Days (day, revenue), without gaps, that lie more than `limit` deviations from the `days` before them."""
    before = W.orderBy("day").rowsBetween(-days, -1)
    scored = filled.select(
        "day",
        "revenue",
        F.avg("revenue").over(before).alias("mean"),
        F.stddev_samp("revenue").over(before).alias("deviation"),
        F.count("revenue").over(before).alias("n"),
    ).withColumn("z_score", F.try_divide(F.col("revenue") - F.col("mean"), F.col("deviation")))
    return scored.filter((F.col("n") == days) & (F.abs("z_score") > limit)).select(
        "day", "revenue", F.round("mean", 6).alias("usual_revenue"), F.round("z_score", 4).alias("z_score")
    )


def revenue_forecast(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Next quarter's revenue per region on the straight line through all full quarters."""
    day = day_or_last(orders, as_of)
    full = orders.filter(F.col("order_date") < quarter_start(day))
    quarters = _quarterly_by_region(customers, full).withColumn(
        "at", (F.year("quarter_start") * 4 + F.quarter("quarter_start")).cast("double")
    )
    next_at = (F.year(day) * 4 + F.quarter(day)).cast("double")
    line = quarters.groupBy("region").agg(
        F.regr_slope("revenue", "at").alias("slope"),
        F.avg("revenue").alias("mean_revenue"),
        F.avg("at").alias("mean_at"),
        F.count(F.lit(1)).alias("quarters"),
    )
    return line.select(
        "region",
        "quarters",
        quarter_start(day).alias("forecast_quarter"),
        _money(F.col("slope")).alias("change_per_quarter"),
        _money(F.col("mean_revenue") + F.col("slope") * (next_at - F.col("mean_at"))).alias("forecast_revenue"),
    )


def orders_last_month(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Orders of any status in the last full month."""
    day = day_or_last(orders, as_of)
    start = F.add_months(_month(day), -1)
    return _days(orders, start, _month(day)).agg(
        F.max(start).alias("month"), F.count(F.lit(1)).alias("order_count")
    )


def fiscal_calendar(orders: DataFrame) -> DataFrame:
    """Orders and revenue per fiscal year and quarter, with the quarter's first and last day."""
    per_quarter = orders.groupBy(quarter_start(F.col("order_date")).alias("first_day")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.when(F.col("order_status") == "completed", F.col("order_amount"))).alias("amount"),
    )
    return per_quarter.select(
        fiscal_year(F.col("first_day")).alias("fiscal_year"),
        fiscal_quarter(F.col("first_day")).alias("fiscal_quarter"),
        "first_day",
        quarter_end(F.col("first_day")).alias("last_day"),
        "order_count",
        _money(F.coalesce("amount", F.lit(0.0))).alias("revenue"),
    )


# --- customers --------------------------------------------------------------------------


def conversion_rate(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Share of customers with a completed order, over all customers."""
    buyers = completed(orders).select("customer_id").distinct().withColumn("bought", F.lit(1))
    return (
        customers.select("customer_id")
        .distinct()
        .join(buyers, "customer_id", "left")
        .agg(
            F.count("bought").alias("converted"),
            F.count(F.lit(1)).alias("customers"),
            _share(F.count("bought"), F.count(F.lit(1))).alias("conversion_rate"),
        )
    )


def conversion_rate_literal(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """The documented statement as written: its WHERE drops customers without orders, so it always says 100."""
    buyers = completed(orders).select("customer_id").distinct()
    return customers.join(buyers, "customer_id").agg(
        _share(F.count_distinct("customer_id"), F.count_distinct("customer_id")).alias("conversion_rate")
    )


def last_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their last order day and number of orders."""
    activity = orders.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"), F.count(F.lit(1)).alias("order_count")
    )
    return customers.join(activity, "customer_id", "left")


def churn_status(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    days = F.datediff(day_or_last(orders, as_of), F.col("last_order"))
    return last_orders(customers, orders).select(
        "customer_id",
        "customer_segment",
        "region",
        "last_order",
        days.alias("days_since_order"),
        churn_label(days).alias("churn_status"),
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
    )


def _churn_counts():
    churned = F.count(F.when(F.col("churn_status") == "churned", 1))
    return churned, F.count(F.lit(1))


def churn_rate(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    churned, total = _churn_counts()
    return churn_status(customers, orders, as_of).agg(
        churned.alias("churned"), total.alias("customers"), _share(churned, total).alias("churn_rate")
    )


def churn_factors(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Churn rate per value of segment, region and number of orders, and its lift over the overall rate.

    Customers are counted per combination of values first; the rest works on those few rows.
    """
    band = (
        F.when(F.col("order_count") <= 5, "0-5").when(F.col("order_count") <= 10, "6-10").otherwise("11+")
    )
    churned, total = _churn_counts()
    cells = (
        churn_status(customers, orders, as_of)
        .groupBy("customer_segment", "region", band.alias("order_band"))
        .agg(churned.alias("churned"), total.alias("customers"))
    )
    pairs = cells.select(
        "churned",
        "customers",
        F.explode(
            F.create_map(
                F.lit("customer_segment"), "customer_segment", F.lit("region"), "region", F.lit("order_band"), "order_band"
            )
        ).alias("attribute", "attribute_value"),
    )
    by_value = pairs.groupBy("attribute", "attribute_value").agg(
        F.sum("churned").alias("churned"), F.sum("customers").alias("customers")
    )
    overall = W.partitionBy("attribute")
    rate = F.try_divide(F.col("churned") * 100.0, F.col("customers"))
    base = F.try_divide(F.sum("churned").over(overall) * 100.0, F.sum("customers").over(overall))
    return by_value.select(
        "attribute",
        "attribute_value",
        "churned",
        "customers",
        F.round(rate, 4).alias("churn_rate"),
        F.round(F.try_divide(rate, base), 4).alias("lift"),
    )


def churn_by_segment_quarter(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Churn at each quarter's end by segment, among the customers who had ordered by then.

    Only a customer's last order of each quarter can matter. It answers for the quarter
    ends from its own up to the one before the customer's next quarter with an order, so
    each customer is laid out over those ends and nothing is compared pairwise.
    """
    last_end = F.date_sub(quarter_start(day_or_last(orders, as_of)), 1)
    per_quarter = orders.groupBy("customer_id", quarter_start(F.col("order_date")).alias("q")).agg(
        F.max("order_date").alias("last_order")
    )
    later = W.partitionBy("customer_id").orderBy("q")  # one row per quarter of a customer
    spans = per_quarter.select(
        "customer_id", "q", "last_order", F.lead("q").over(later).alias("next_q"), quarter_start(last_end).alias("final_q")
    ).withColumn("to_q", F.least(F.add_months(F.coalesce("next_q", F.add_months("final_q", 3)), -3), F.col("final_q")))
    seen = spans.filter("q <= to_q").select(
        "customer_id",
        "last_order",
        F.explode(F.sequence("q", "to_q", F.expr("interval 3 months"))).alias("quarter"),
    )
    status = seen.select(
        "customer_id",
        quarter_end(F.col("quarter")).alias("quarter_end"),
        (F.datediff(quarter_end(F.col("quarter")), "last_order") > 90).alias("gone"),
    )
    churned, total = F.count(F.when(F.col("gone"), 1)), F.count(F.lit(1))
    return (
        status.join(customers.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("quarter_end", "customer_segment")
        .agg(churned.alias("churned"), total.alias("customers"), _share(churned, total).alias("churn_rate"))
    )


def customer_ltv(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return customers.join(_spend(orders), "customer_id", "left").select(
        "customer_id", _money(F.coalesce("amount", F.lit(0.0))).alias("lifetime_value")
    )


def _tercile(df: DataFrame, by: str, name: str) -> DataFrame:
    """1, 2 or 3 by the rank of `by`: the split of ntile(3), without gathering all rows in one task."""
    numbered = running_number(df, [], [by, "customer_id"], "_n", total="_total")
    small, longer = F.floor(F.col("_total") / 3), F.pmod("_total", F.lit(3))
    in_longer = F.col("_n") <= longer * (small + 1)
    tile = F.when(in_longer, F.ceil(F.col("_n") / (small + 1))).otherwise(
        longer + F.ceil((F.col("_n") - longer * (small + 1)) / F.greatest(small, F.lit(1)))
    )
    return numbered.withColumn(name, tile.cast("int")).drop("_n", "_total")


def customer_segments(orders: DataFrame) -> DataFrame:
    """Customers by how often and how much they buy, each in three equal parts."""
    habits = completed(orders).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.round(F.avg("order_amount"), 6).alias("avg_order_value")
    )
    tiled = _tercile(_tercile(habits, "order_count", "frequency_tile"), "avg_order_value", "value_tile")
    words = lambda c, low, mid, high: F.when(c == 1, low).when(c == 2, mid).otherwise(high)
    return tiled.select(
        "customer_id",
        "order_count",
        "avg_order_value",
        "frequency_tile",
        "value_tile",
        F.concat_ws(
            ", ",
            words(F.col("frequency_tile"), "rare", "regular", "frequent"),
            words(F.col("value_tile"), "low value", "medium value", "high value"),
        ).alias("segment"),
    )


def acquisition_trend(
    orders: DataFrame, months: int = 6, spend: DataFrame | None = None, as_of: str | None = None
) -> DataFrame:
    """New customers (first order) per month over the last full `months`, with cost per head.

    `spend` (month, spend) is optional; without it the cost is unknown.
    """
    day = day_or_last(orders, as_of)
    first = orders.groupBy("customer_id").agg(_month(F.min("order_date")).alias("month"))
    counted = first.groupBy("month").agg(F.count(F.lit(1)).alias("new_customers"))
    span = orders.agg(F.max(F.add_months(_month(day), -months)).alias("lo"), F.max(F.add_months(_month(day), -1)).alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    trend = spine.join(counted, "month", "left").select("month", F.coalesce("new_customers", F.lit(0)).alias("new_customers"))
    if spend is None:
        return trend.withColumn("cost_per_customer", F.lit(None).cast("double"))
    return trend.join(spend, "month", "left").select(
        "month", "new_customers", F.round(F.try_divide("spend", "new_customers"), 2).alias("cost_per_customer")
    )


def duplicate_rows(table: DataFrame, key, id_column: str) -> DataFrame:
    """Groups of rows with an equal key: the key's hash, the group's size and its first id."""
    return (
        table.groupBy(F.sha2(key, 256).alias("key_hash"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(id_column).alias("first_id"))
        .filter("copies > 1")
    )


def table_profile(table: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, distinct_values, min_value, max_value), one row per column.

    Rows, nulls and extremes come from one aggregate without a shuffle of values; extremes are taken in the
    column's own type and then written as text. Distinct values are counted from hashes of the values, once
    per column and task before the shuffle.
    """
    whole = table.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.count(c)).alias("nulls"),
                    F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
                )
                for c in table.columns
            ]
        ).alias("columns")
    ).select(F.explode("columns").alias("c")).select("c.*")
    hashed = [F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("h1"), F.xxhash64(F.lit(1), c).alias("h2")) for c in table.columns]
    values = table.select(F.explode(F.array(*hashed)).alias("v")).select("v.*").filter("h1 is not null").distinct()
    distinct = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    return whole.join(distinct, "column_name", "left").select(
        "column_name", "rows", "nulls", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "min_value", "max_value"
    )


def report_sections(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One report out of several queries: (section, key, value)."""
    part = lambda df, name, key, value: df.select(
        F.lit(name).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value")
    )
    spend = _spend(orders).join(customers.select("customer_id", "region", "customer_segment"), "customer_id")
    cells = spend.groupBy("region", "customer_segment").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))
    by = lambda c: cells.groupBy(c).agg(_money(F.sum("amount")).alias("v"))
    by_category = (
        _categorised(orders, lines).groupBy("product_category").agg(_money(F.sum("order_amount")).alias("v"))
    )
    return (
        part(total_revenue(orders), "total revenue", F.lit("all"), F.col("revenue"))
        .unionByName(part(cells.agg(F.sum("n").alias("v")), "completed orders", F.lit("all"), F.col("v")))
        .unionByName(part(by("region"), "revenue by region", F.col("region"), F.col("v")))
        .unionByName(part(by("customer_segment"), "revenue by segment", F.col("customer_segment"), F.col("v")))
        .unionByName(part(by_category, "revenue by product line", F.col("product_category"), F.col("v")))
    )


def row_filter(table: DataFrame, entitlements: DataFrame, user: str, column: str = "region") -> DataFrame:
    """Rows whose `column` value the user may see; `entitlements` holds (user_name, <column>)."""
    allowed = entitlements.filter(F.col("user_name") == user).select(column).distinct()
    return table.join(allowed, column, "left_semi")
