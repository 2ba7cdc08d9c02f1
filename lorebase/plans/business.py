"""Business questions over the customer and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.operators import metrics as m
from lorebase.plans.registry import query
from lorebase.sources import bindings as b
from lorebase.sources.tables import business_customers, customer_facts, order_facts, order_lines, read_table

# The documented tables in SQL.
ORD = """ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_totalprice AS order_amount,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' END AS order_status
  FROM orders),
done AS (SELECT * FROM ord WHERE order_status = 'completed'),
today AS (SELECT max(order_date) AS d FROM ord)"""
CUST = """cust AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
LINES = """lines AS (
  SELECT l_orderkey AS order_id, p_type AS product_category FROM (
    SELECT l_orderkey, l_partkey, row_number() OVER (
      PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS n
    FROM lineitem) LEFT JOIN part ON l_partkey = p_partkey WHERE n = 1),
cat AS (SELECT done.*, coalesce(product_category, 'none') AS product_category FROM done LEFT JOIN lines USING (order_id))"""
BY_QUARTER = """qr AS (
  SELECT region, CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_start,
         round(sum(order_amount), 2) AS revenue
  FROM done JOIN cust USING (customer_id) GROUP BY ALL)"""
WITH = f"WITH {ORD}, {CUST}"
WITH_LINES = f"{WITH}, {LINES}"


def _facts(spark, folder):
    return customer_facts(spark, folder), order_facts(spark, folder, timed=True)


# --- revenue ----------------------------------------------------------------------------


@query("total_revenue", f"WITH {ORD} SELECT round(sum(order_amount), 2) AS revenue FROM done")
def _(spark, folder):
    return m.total_revenue(order_facts(spark, folder))


TOP = """SELECT customer_id, customer_name, customer_segment, round(sum(order_amount), 2) AS total_revenue,
  count(*) AS order_count FROM done JOIN cust USING (customer_id) {where}
  GROUP BY ALL ORDER BY total_revenue DESC, customer_id LIMIT 10"""


@query("top_customers", f"{WITH} {TOP.format(where='')}")
def _(spark, folder):
    return m.top_customers(*_facts(spark, folder))


@query("top_customers_ytd", f"{WITH} {TOP.format(where='WHERE year(order_date) = (SELECT year(d) FROM today)')}")
def _(spark, folder):
    return m.top_customers_ytd(*_facts(spark, folder))


@query(
    "revenue_region_month",
    f"""{WITH} SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, region,
      round(sum(order_amount), 2) AS revenue, count(*) AS order_count
    FROM done JOIN cust USING (customer_id)
    WHERE order_date >= (SELECT date_trunc('month', d) - INTERVAL 11 MONTH FROM today) GROUP BY ALL""",
)
def _(spark, folder):
    return m.revenue_region_month(*_facts(spark, folder))


@query(
    "revenue_quarter_region",
    f"""{WITH} SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_start, region,
      round(sum(order_amount), 2) AS revenue, count(*) AS order_count
    FROM done JOIN cust USING (customer_id)
    WHERE date_trunc('quarter', order_date) = (SELECT date_trunc('quarter', d) - INTERVAL 3 MONTH FROM today)
    GROUP BY ALL""",
)
def _(spark, folder):
    return m.revenue_quarter_region(*_facts(spark, folder))


@query(
    "revenue_drilldown",
    f"""{WITH_LINES} SELECT region, product_category, round(sum(order_amount), 2) AS revenue, count(*) AS order_count,
      CASE grouping(region, product_category) WHEN 3 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS level
    FROM cat JOIN cust USING (customer_id) GROUP BY ROLLUP (region, product_category)""",
)
def _(spark, folder):
    return m.revenue_drilldown(*_facts(spark, folder), order_lines(spark, folder))


@query(
    "revenue_category_month",
    f"""{WITH_LINES} SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_category,
      round(sum(order_amount), 2) AS revenue, count(*) AS order_count FROM cat GROUP BY ALL""",
)
def _(spark, folder):
    return m.revenue_category_month(order_facts(spark, folder), order_lines(spark, folder))


@query(
    "revenue_by_product",
    f"""WITH {ORD} SELECT p_partkey AS part_id, p_name AS product_name, p_type AS product_category,
      round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, round(sum(l_quantity), 2) AS units
    FROM lineitem JOIN done ON l_orderkey = order_id JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def _(spark, folder):
    return m.revenue_by_product(order_facts(spark, folder), b.product_lines(spark, folder), b.products(spark, folder))


@query(
    "revenue_yoy_quarter",
    f"""{WITH}, {BY_QUARTER}
    SELECT a.region, CAST(year(a.quarter_start) AS INT) AS fiscal_year,
      CAST(quarter(a.quarter_start) AS INT) AS fiscal_quarter, a.revenue,
      p.revenue AS revenue_year_before,
      round((a.revenue - p.revenue) * 100.0 / nullif(p.revenue, 0), 4) AS growth_pct
    FROM qr a LEFT JOIN qr p ON a.region = p.region AND a.quarter_start = p.quarter_start + INTERVAL 1 YEAR""",
)
def _(spark, folder):
    return m.revenue_yoy_quarter(*_facts(spark, folder))


@query(
    "region_growth",
    f"""{WITH}, {BY_QUARTER}
    SELECT a.region, p.revenue AS previous_revenue, a.revenue,
      round((a.revenue - p.revenue) * 100.0 / nullif(p.revenue, 0), 4) AS growth_pct
    FROM qr a LEFT JOIN qr p ON a.region = p.region AND a.quarter_start = p.quarter_start + INTERVAL 3 MONTH
    WHERE a.quarter_start = (SELECT date_trunc('quarter', d) - INTERVAL 3 MONTH FROM today)
    ORDER BY growth_pct DESC NULLS LAST, a.region LIMIT 1""",
)
def _(spark, folder):
    return m.region_growth(*_facts(spark, folder))


@query(
    "revenue_trend",
    f"""WITH {ORD}, monthly AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(order_amount) AS amount
      FROM done GROUP BY 1),
    spine AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM monthly),
    filled AS (SELECT month, round(coalesce(amount, 0), 2) AS revenue FROM spine LEFT JOIN monthly USING (month))
    SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous_revenue,
      round(avg(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_mean FROM filled""",
)
def _(spark, folder):
    return m.revenue_trend(order_facts(spark, folder))


@query(
    "daily_sales_anomalies",
    f"""WITH {ORD}, daily AS (SELECT order_date AS day, sum(order_amount) AS amount FROM done GROUP BY 1),
    spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily),
    filled AS (SELECT day, round(coalesce(amount, 0), 2) AS revenue FROM spine LEFT JOIN daily USING (day)),
    scored AS (SELECT day, revenue, avg(revenue) OVER w AS mean, stddev_samp(revenue) OVER w AS deviation, count(*) OVER w AS n
      FROM filled WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
    SELECT day, revenue, round(mean, 6) AS usual_revenue, round((revenue - mean) / nullif(deviation, 0), 4) AS z_score
    FROM scored WHERE n = 28 AND abs((revenue - mean) / nullif(deviation, 0)) > 3""",
)
def _(spark, folder):
    return m.daily_sales_anomalies(order_facts(spark, folder))


@query(
    "daily_sales_anomalies_last_month",
    f"""WITH {ORD}, daily AS (SELECT order_date AS day, sum(order_amount) AS amount FROM done GROUP BY 1),
    ends AS (SELECT CAST(date_trunc('month', d) AS DATE) AS month_end, CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS month_start FROM today),
    spine AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM daily), month_end - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
    filled AS (SELECT day, round(coalesce(amount, 0), 2) AS revenue FROM spine LEFT JOIN daily USING (day)),
    scored AS (SELECT day, revenue, avg(revenue) OVER w AS mean, stddev_samp(revenue) OVER w AS deviation, count(*) OVER w AS n
      FROM filled WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
    SELECT day, revenue, round(mean, 6) AS usual_revenue, round((revenue - mean) / nullif(deviation, 0), 4) AS z_score
    FROM scored, ends WHERE day >= month_start AND n = 28 AND abs((revenue - mean) / nullif(deviation, 0)) > 1""",
)
def _(spark, folder):
    """Days of the last full month more than one deviation off the four weeks before them."""
    return m.daily_sales_anomalies_last_month(order_facts(spark, folder, timed=True), limit=1.0)


@query(
    "revenue_forecast",
    f"""{WITH}, {BY_QUARTER}, points AS (
      SELECT region, revenue, CAST(year(quarter_start) * 4 + quarter(quarter_start) AS DOUBLE) AS t FROM qr
      WHERE quarter_start < (SELECT date_trunc('quarter', d) FROM today)),
    line AS (SELECT region, count(*) AS quarters, regr_slope(revenue, t) AS slope, avg(revenue) AS my, avg(t) AS mt
      FROM points GROUP BY region)
    SELECT region, quarters, CAST(date_trunc('quarter', d) AS DATE) AS forecast_quarter,
      round(slope, 2) AS change_per_quarter,
      round(my + slope * (year(d) * 4 + quarter(d) - mt), 2) AS forecast_revenue FROM line, today""",
)
def _(spark, folder):
    return m.revenue_forecast(*_facts(spark, folder))


@query(
    "orders_last_month",
    f"""WITH {ORD} SELECT CAST(max(date_trunc('month', d) - INTERVAL 1 MONTH) AS DATE) AS month, count(*) AS order_count
    FROM ord, today WHERE date_trunc('month', order_date) = date_trunc('month', d) - INTERVAL 1 MONTH""",
)
def _(spark, folder):
    return m.orders_last_month(order_facts(spark, folder, timed=True))


@query(
    "fiscal_calendar",
    f"""WITH {ORD} SELECT CAST(year(order_date) AS INT) AS fiscal_year, CAST(quarter(order_date) AS INT) AS fiscal_quarter,
      CAST(date_trunc('quarter', order_date) AS DATE) AS first_day,
      CAST(date_trunc('quarter', order_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day,
      count(*) AS order_count,
      round(coalesce(sum(order_amount) FILTER (order_status = 'completed'), 0), 2) AS revenue
    FROM ord GROUP BY ALL""",
)
def _(spark, folder):
    return m.fiscal_calendar(order_facts(spark, folder))


# --- customers --------------------------------------------------------------------------


@query(
    "conversion_rate",
    f"""{WITH} SELECT count(DISTINCT o.customer_id) AS converted, count(DISTINCT c.customer_id) AS customers,
      round(count(DISTINCT o.customer_id) * 100.0 / count(DISTINCT c.customer_id), 4) AS conversion_rate
    FROM cust c LEFT JOIN ord o ON c.customer_id = o.customer_id AND o.order_status = 'completed'""",
)
def _(spark, folder):
    return m.conversion_rate(*_facts(spark, folder))


@query(
    "conversion_rate_literal",
    f"""{WITH} SELECT round(count(DISTINCT o.customer_id) * 100.0 / count(DISTINCT c.customer_id), 4) AS conversion_rate
    FROM cust c LEFT JOIN ord o ON c.customer_id = o.customer_id WHERE o.order_status = 'completed'""",
)
def _(spark, folder):
    return m.conversion_rate_literal(*_facts(spark, folder))


STATUS = """status AS (SELECT customer_id, customer_segment, region, last_order,
    CAST((SELECT d FROM today) - last_order AS INT) AS days_since_order,
    CASE WHEN last_order IS NULL OR (SELECT d FROM today) - last_order > 90 THEN 'churned'
         WHEN (SELECT d FROM today) - last_order >= 60 THEN 'at risk' ELSE 'active' END AS churn_status,
    coalesce(order_count, 0) AS order_count
  FROM cust LEFT JOIN (SELECT customer_id, max(order_date) AS last_order, count(*) AS order_count FROM ord GROUP BY 1)
  USING (customer_id))"""


@query("churn_status", f"{WITH}, {STATUS} SELECT * FROM status")
def _(spark, folder):
    return m.churn_status(*_facts(spark, folder))


@query(
    "churn_rate",
    f"""{WITH}, {STATUS} SELECT count(*) FILTER (churn_status = 'churned') AS churned, count(*) AS customers,
      round(count(*) FILTER (churn_status = 'churned') * 100.0 / count(*), 4) AS churn_rate FROM status""",
)
def _(spark, folder):
    return m.churn_rate(*_facts(spark, folder))


@query(
    "churn_factors",
    f"""{WITH}, {STATUS}, pairs AS (
      SELECT 'customer_segment' AS attribute, customer_segment AS attribute_value, churn_status FROM status
      UNION ALL SELECT 'region', region, churn_status FROM status
      UNION ALL SELECT 'order_band', CASE WHEN order_count <= 5 THEN '0-5' WHEN order_count <= 10 THEN '6-10' ELSE '11+' END,
        churn_status FROM status),
    counted AS (SELECT attribute, attribute_value, count(*) FILTER (churn_status = 'churned') AS churned, count(*) AS customers
      FROM pairs GROUP BY ALL)
    SELECT *, round(churned * 100.0 / customers, 4) AS churn_rate,
      round((churned * 100.0 / customers) / nullif((SELECT count(*) FILTER (churn_status = 'churned') * 100.0 / count(*) FROM status), 0), 4) AS lift
    FROM counted""",
)
def _(spark, folder):
    return m.churn_factors(*_facts(spark, folder))


@query(
    "churn_by_segment_quarter",
    f"""{WITH}, ends AS (
      SELECT CAST(unnest(generate_series((SELECT date_trunc('quarter', min(order_date)) FROM ord),
        (SELECT date_trunc('quarter', d) - INTERVAL 3 MONTH FROM today), INTERVAL 3 MONTH)) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
        AS quarter_end),
    seen AS (SELECT quarter_end, customer_id, max(order_date) AS last_order
      FROM ends JOIN ord ON order_date <= quarter_end GROUP BY ALL)
    SELECT quarter_end, customer_segment, count(*) FILTER (quarter_end - last_order > 90) AS churned, count(*) AS customers,
      round(count(*) FILTER (quarter_end - last_order > 90) * 100.0 / count(*), 4) AS churn_rate
    FROM seen JOIN cust USING (customer_id) GROUP BY ALL""",
)
def _(spark, folder):
    return m.churn_by_segment_quarter(*_facts(spark, folder))


@query(
    "customer_ltv",
    f"""{WITH} SELECT c.customer_id, round(coalesce(sum(order_amount), 0), 2) AS lifetime_value
    FROM cust c LEFT JOIN done USING (customer_id) GROUP BY ALL""",
)
def _(spark, folder):
    return m.customer_ltv(*_facts(spark, folder))


@query(
    "customer_segments",
    f"""WITH {ORD}, habits AS (SELECT customer_id, count(*) AS order_count, round(avg(order_amount), 6) AS avg_order_value
      FROM done GROUP BY 1),
    tiled AS (SELECT *, CAST(ntile(3) OVER (ORDER BY order_count, customer_id) AS INT) AS frequency_tile,
      CAST(ntile(3) OVER (ORDER BY avg_order_value, customer_id) AS INT) AS value_tile FROM habits)
    SELECT *, CASE frequency_tile WHEN 1 THEN 'rare' WHEN 2 THEN 'regular' ELSE 'frequent' END || ', ' ||
      CASE value_tile WHEN 1 THEN 'low value' WHEN 2 THEN 'medium value' ELSE 'high value' END AS segment FROM tiled""",
)
def _(spark, folder):
    return m.customer_segments(order_facts(spark, folder))


@query(
    "acquisition_trend",
    f"""WITH {ORD}, first AS (SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS month FROM ord GROUP BY 1),
    spine AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', d) - INTERVAL 6 MONTH FROM today),
      (SELECT date_trunc('month', d) - INTERVAL 1 MONTH FROM today), INTERVAL 1 MONTH)) AS DATE) AS month)
    SELECT month, count(customer_id) AS new_customers, CAST(NULL AS DOUBLE) AS cost_per_customer
    FROM spine LEFT JOIN first USING (month) GROUP BY month""",
)
def _(spark, folder):
    return m.acquisition_trend(order_facts(spark, folder))


@query(
    "duplicate_customers",
    """SELECT sha256(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g'))) AS key_hash, count(*) AS copies, min(doc_id) AS first_id
    FROM documents GROUP BY 1 HAVING count(*) > 1""",
)
def _(spark, folder):
    docs = b.documents(spark, folder)
    return m.duplicate_rows(docs, F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), "doc_id")


PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values,
      CAST(min({v}) AS VARCHAR) AS min_value, CAST(max({v}) AS VARCHAR) AS max_value FROM ord"""
    for c, v in {
        "order_id": "order_id",
        "customer_id": "customer_id",
        "order_date": "order_date",
        "order_amount": "order_amount",
        "order_status": "order_status",
    }.items()
)


@query("table_profile", f"WITH {ORD} {PROFILE}")
def _(spark, folder):
    return m.table_profile(order_facts(spark, folder))


@query(
    "report_sections",
    f"""{WITH_LINES} SELECT 'total revenue' AS section, 'all' AS key, round(sum(order_amount), 2) AS value FROM done
    UNION ALL SELECT 'completed orders', 'all', CAST(count(*) AS DOUBLE) FROM done
    UNION ALL SELECT 'revenue by region', region, round(sum(order_amount), 2) FROM done JOIN cust USING (customer_id) GROUP BY region
    UNION ALL SELECT 'revenue by segment', customer_segment, round(sum(order_amount), 2)
      FROM done JOIN cust USING (customer_id) GROUP BY customer_segment
    UNION ALL SELECT 'revenue by product line', product_category, round(sum(order_amount), 2) FROM cat GROUP BY product_category""",
)
def _(spark, folder):
    return m.report_sections(*_facts(spark, folder), order_lines(spark, folder))


@query(
    "row_filter",
    f"""{WITH} SELECT customer_id, customer_name, customer_segment, region FROM cust
    WHERE region IN (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = 'NATION_7')""",
)
def _(spark, folder):
    rows = m.row_filter(customer_facts(spark, folder), b.entitlements(spark, folder), "NATION_7")
    return rows.select("customer_id", "customer_name", "customer_segment", "region")


@query(
    "business_customers",
    f"""{WITH} SELECT customer_id, customer_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
      min(order_date) AS registration_date, customer_segment, region,
      coalesce((SELECT d FROM today) - max(order_date) <= 90, false) AS is_active,
      round(coalesce(sum(order_amount) FILTER (order_status = 'completed'), 0), 2) AS lifetime_value
    FROM cust LEFT JOIN ord USING (customer_id) GROUP BY customer_id, customer_name, customer_segment, region""",
)
def _(spark, folder):
    return business_customers(spark, folder).withColumn("lifetime_value", F.round("lifetime_value", 2))
