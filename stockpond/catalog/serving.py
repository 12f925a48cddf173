"""Governance, metric layer, serving and usage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.catalog.core import RUN_LOG_SQL
from stockpond.catalog.registry import FACTS_SQL, PRODUCTS_SQL, SILVER_SQL, SUMMARY_SQL, plain, query
from stockpond.functions.scalars import clean_text, register_category_revenue, register_clean_text
from stockpond.operators import govern, marts, usage
from stockpond.plans import metrics
from stockpond.plans.jobs import build_silver_table
from stockpond.session import materialize, scratch_path
from stockpond.sources import retail
from stockpond.sources.tables import read_table

ENGINEER, ANALYST, ADMIN = "DATA_ENGINEER", "DATA_ANALYST", "ACCOUNTADMIN"

CUSTOMERS_SQL = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def customer_policies():
    return govern.Policies(
        rows=lambda: F.col("region") == "ASIA", row_exempt={ENGINEER}, masks={"email": ({ENGINEER}, govern.MASK_TEXT)}
    )


@query(
    "masked_row_filtered",
    f"""WITH {CUSTOMERS_SQL}
    SELECT 'DATA_ENGINEER' AS role, * FROM customers
    UNION ALL SELECT r.role, customer_id, name, '***MASKED***', region
    FROM customers, (VALUES ('DATA_ANALYST'), ('ACCOUNTADMIN')) r(role) WHERE region = 'ASIA'""",
)
def masked_row_filtered(spark, sf_dir):
    customers = retail.customers(spark, sf_dir)
    seen = [
        govern.governed(customers, customer_policies(), role).select(F.lit(role).alias("role"), *customers.columns)
        for role in (ENGINEER, ANALYST, ADMIN)
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query(
    "governed_counts",
    f"""WITH {CUSTOMERS_SQL}
    SELECT 'DATA_ENGINEER' AS role, COUNT(*) AS visible_rows FROM customers
    UNION ALL SELECT 'DATA_ANALYST', COUNT(*) FROM customers WHERE region = 'ASIA'""",
)
def governed_counts(spark, sf_dir):
    customers = retail.customers(spark, sf_dir)
    counts = [
        govern.governed(customers, customer_policies(), role)
        .agg(F.count("*").alias("visible_rows"))
        .select(F.lit(role).alias("role"), "visible_rows")
        for role in (ENGINEER, ANALYST)
    ]
    return counts[0].unionByName(counts[1])


@query(
    "masked_by_tag",
    f"""WITH {CUSTOMERS_SQL} SELECT customer_id, '***MASKED***' AS name, '***MASKED***' AS email, region FROM customers""",
)
def masked_by_tag(spark, sf_dir):
    tagged = govern.tag_columns(retail.customers(spark, sf_dir), {"name": "PII", "email": "PII"})
    return govern.mask_tagged(tagged, "PII", {ENGINEER}, ANALYST)


@query(
    "masked_null",
    f"""WITH {PRODUCTS_SQL}
    SELECT 'ACCOUNTADMIN' AS role, product_id, CAST(price AS DOUBLE) AS price FROM products
    UNION ALL SELECT 'DATA_ENGINEER', product_id, NULL FROM products""",
)
def masked_null(spark, sf_dir):
    goods = retail.products(spark, sf_dir).select("product_id", "price")
    seen = [
        govern.mask(goods, "price", {ADMIN}, role, None).select(F.lit(role).alias("role"), "product_id", "price")
        for role in (ADMIN, ENGINEER)
    ]
    return plain(seen[0].unionByName(seen[1]))


# --- metric layer -----------------------------------------------------------------------


def gold_tables(spark, sf_dir):
    """The Gold tables, written where the model's ``base_table`` names look for them."""
    root = scratch_path(spark, "metric-root")
    retail.order_facts(spark, sf_dir).write.parquet(f"{root}/gold/order_facts")
    facts = spark.read.parquet(f"{root}/gold/order_facts")
    marts.category_summary(facts, exact=True).write.parquet(f"{root}/gold/category_summary")
    marts.orders_over_time(facts).write.parquet(f"{root}/gold/orders_over_time")
    marts.customer_sketches(facts).write.parquet(f"{root}/gold/customer_sketches")
    return metrics.read_tables(spark, metrics.load_spec(), root)


@query(
    "metric_revenue_by_category",
    f"WITH {SUMMARY_SQL} SELECT category, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue FROM summary GROUP BY category",
)
def metric_revenue_by_category(spark, sf_dir):
    return plain(metrics.verified_query(gold_tables(spark, sf_dir), metrics.load_spec(), "revenue_by_category"))


@query(
    "metric_orders_by_category",
    f"WITH {SUMMARY_SQL} SELECT category, CAST(SUM(order_count) AS BIGINT) AS order_count FROM summary GROUP BY category",
)
def metric_orders_by_category(spark, sf_dir):
    return metrics.verified_query(gold_tables(spark, sf_dir), metrics.load_spec(), "orders_by_category")


@query(
    "metric_total_revenue",
    f"WITH {SUMMARY_SQL} SELECT CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue FROM summary",
)
def metric_total_revenue(spark, sf_dir):
    return plain(metrics.verified_query(gold_tables(spark, sf_dir), metrics.load_spec(), "total_revenue"))


@query(
    "metric_filtered_facts",
    f"""WITH {FACTS_SQL}
    SELECT category, CAST(SUM(order_value) AS DOUBLE) AS order_value, SUM(quantity)::BIGINT AS quantity
    FROM facts WHERE order_status <> 'CANCELLED' AND order_ts >= TIMESTAMP '1998-01-01' GROUP BY category""",
)
def metric_filtered_facts(spark, sf_dir):
    """Synonyms, two filters, two measures."""
    return plain(
        metrics.metric_query(
            {"order_facts": retail.order_facts(spark, sf_dir)},
            metrics.load_spec(),
            ["worth of the order", "pieces"],
            ["kind of product"],
            filters=[("state of the order", "<>", "CANCELLED"), ("moment of purchase", ">=", F.lit("1998-01-01").cast("timestamp_ntz"))],
            table="order_facts",
        )
    )


@query(
    "metric_daily",
    f"""WITH {FACTS_SQL}
    SELECT CAST(order_ts AS DATE) AS order_date, COUNT(*) AS daily_order_count,
           CAST(SUM(CASE WHEN order_status <> 'CANCELLED' THEN order_value ELSE 0 END) AS DOUBLE) AS daily_revenue
    FROM facts GROUP BY 1""",
)
def metric_daily(spark, sf_dir):
    daily = {"orders_over_time": marts.orders_over_time(retail.order_facts(spark, sf_dir))}
    return plain(
        metrics.metric_query(
            daily, metrics.load_spec(), ["purchases a day", "takings a day"], ["calendar day"], order_by=[("order_date", "asc")]
        )
    )


@query(
    "metric_distinct_customers",
    f"""WITH {FACTS_SQL}, kept AS (SELECT *, year(order_ts)::INT AS order_year FROM facts WHERE order_status <> 'CANCELLED')
    SELECT category, CAST(NULL AS INT) AS order_year, COUNT(DISTINCT customer_id) AS customers, TRUE AS within_bound
    FROM kept GROUP BY category
    UNION ALL SELECT NULL, order_year, COUNT(DISTINCT customer_id), TRUE FROM kept GROUP BY order_year
    UNION ALL SELECT NULL, NULL, COUNT(DISTINCT customer_id), TRUE FROM kept""",
)
def metric_distinct_customers(spark, sf_dir):
    """Distinct customers by category, by year and of the whole shop from one stored table of sketches, beside exact counts."""
    facts, spec = materialize(retail.order_facts(spark, sf_dir), "facts"), metrics.load_spec()
    sketches = {"customer_sketches": materialize(marts.customer_sketches(facts), "customer-sketches")}
    kept = facts.where(marts.not_cancelled()).withColumn("order_year", F.year("order_ts"))
    parts = []
    for group in (["category"], ["order_year"], []):
        known = metrics.metric_query(sketches, spec, ["different buyers"], group)
        exact = kept.groupBy(*group).agg(F.count_distinct("customer_id").alias("customers"))
        if group:
            both = exact.join(known, exact[group[0]].eqNullSafe(known[group[0]])).select(exact[group[0]], "customers", "distinct_customers")
        else:
            both = exact.withColumn("distinct_customers", known.scalar())
        parts.append(both)
    within = F.abs(F.col("distinct_customers") - F.col("customers")) <= F.ceil(F.col("customers") * marts.SKETCH_ERROR)
    every = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return every.select("category", "order_year", "customers", within.alias("within_bound"))


@query(
    "category_explorer",
    f"""WITH {FACTS_SQL}
    SELECT 'All' AS choice, COUNT(*) AS orders,
           CAST(SUM(order_value) FILTER (order_status <> 'CANCELLED') AS DOUBLE) AS revenue,
           COUNT(DISTINCT customer_id) FILTER (order_status <> 'CANCELLED') AS customers FROM facts
    UNION ALL
    SELECT 'ECONOMY', COUNT(*), CAST(SUM(order_value) FILTER (order_status <> 'CANCELLED') AS DOUBLE),
           COUNT(DISTINCT customer_id) FILTER (order_status <> 'CANCELLED') FROM facts WHERE category = 'ECONOMY'""",
)
def category_explorer(spark, sf_dir):
    facts = materialize(retail.order_facts(spark, sf_dir), "order-facts")
    every = marts.category_explorer(facts).select(F.lit("All").alias("choice"), "*")
    one = marts.category_explorer(facts, "ECONOMY").select(F.lit("ECONOMY").alias("choice"), "*")
    return plain(every.unionByName(one))


# --- usage ------------------------------------------------------------------------------

METERING_SQL = """
metering AS (
  SELECT event_type AS warehouse_name, ts AS start_time, ts + INTERVAL 1 HOUR AS end_time,
         CAST(value AS DECIMAL(18,2)) AS credits_used FROM events)"""
SINCE = "2024-01-10 00:00:00"


@query(
    "usage_by_source",
    f"""WITH {METERING_SQL}
    SELECT warehouse_name, CAST(SUM(credits_used) AS DOUBLE) AS credits_used, MIN(start_time) AS first_interval,
           MAX(end_time) AS last_interval FROM metering WHERE start_time >= TIMESTAMP '{SINCE}' GROUP BY warehouse_name""",
)
def usage_by_source(spark, sf_dir):
    since = F.lit(SINCE).cast("timestamp_ntz")
    rolled = usage.usage_rollup(retail.metering(spark, sf_dir), ["warehouse_name"], since)
    return plain(rolled.orderBy(F.desc("credits_used")))


@query(
    "usage_by_day",
    f"""WITH {METERING_SQL}
    SELECT CAST(start_time AS DATE) AS usage_day, warehouse_name, CAST(SUM(credits_used) AS DOUBLE) AS credits_used
    FROM metering GROUP BY 1, 2""",
)
def usage_by_day(spark, sf_dir):
    by_day = usage.usage_by_day(retail.metering(spark, sf_dir))
    return plain(by_day.orderBy("usage_day", F.desc("credits_used")))


@query(
    "usage_share",
    f"""WITH {METERING_SQL}, per AS (SELECT warehouse_name, SUM(credits_used) AS credits_used FROM metering GROUP BY 1)
    SELECT warehouse_name, CAST(credits_used AS DOUBLE) AS credits_used,
           ROUND(CAST(credits_used AS DOUBLE) / CAST((SELECT SUM(credits_used) FROM per) AS DOUBLE), 9) AS share FROM per""",
)
def usage_share(spark, sf_dir):
    shares = plain(usage.usage_share(retail.metering(spark, sf_dir)))
    return shares.withColumn("share", F.round("share", 9))


@query(
    "budget_crossings",
    f"""WITH {METERING_SQL}, running AS (
      SELECT date_trunc('month', start_time)::DATE AS month, start_time,
             SUM(credits_used) OVER (PARTITION BY date_trunc('month', start_time) ORDER BY start_time
                                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM metering)
    SELECT month, t.action, MIN(start_time) AS crossed_at
    FROM running, (VALUES ('NOTIFY', 3750.00), ('SUSPEND', 5000.00)) t(action, needed) WHERE used >= t.needed GROUP BY 1, 2""",
)
def budget_crossings(spark, sf_dir):
    return usage.budget_crossings(retail.metering(spark, sf_dir), 5000.0, {"NOTIFY": 0.75, "SUSPEND": 1.0})


@query(
    "slow_run_report",
    f"""WITH {RUN_LOG_SQL}
    SELECT query_id, LEFT(query_text, 180) AS query_text_preview, user_name, warehouse_name,
           CAST(total_elapsed_time AS DOUBLE) AS total_elapsed_time, bytes_scanned, start_time
    FROM runs WHERE query_type NOT IN ('VIEW', 'CLICK') AND (query_text ILIKE '%purchase%' OR query_tag ILIKE 'day03%')
    ORDER BY runs.total_elapsed_time DESC NULLS LAST, query_id LIMIT 20""",
)
def slow_run_report(spark, sf_dir):
    return plain(usage.slow_runs(retail.run_log(spark, sf_dir), ["%purchase%"], "day03%", ["VIEW", "CLICK"], 20))


@query(
    "tag_comparison",
    f"""WITH {RUN_LOG_SQL}
    SELECT query_type, COUNT(*) FILTER (query_tag = 'day01') AS day01_runs,
           CAST(SUM(total_elapsed_time) FILTER (query_tag = 'day01') AS DOUBLE) AS day01_elapsed,
           COUNT(*) FILTER (query_tag = 'day02') AS day02_runs,
           CAST(SUM(total_elapsed_time) FILTER (query_tag = 'day02') AS DOUBLE) AS day02_elapsed
    FROM runs WHERE query_tag IN ('day01', 'day02') GROUP BY query_type""",
)
def tag_comparison(spark, sf_dir):
    return plain(usage.compare_tags(retail.run_log(spark, sf_dir), ["day01", "day02"]))


# --- functions and procedures -----------------------------------------------------------


@query(
    "clean_text",
    "SELECT p_partkey, upper(p_name) AS native, upper(p_name) AS by_function FROM part",
)
def clean(spark, sf_dir):
    register_clean_text(spark)
    padded = F.concat(F.lit("\t \u00a0\x1c "), "p_name", F.lit(" \u2003\x85\n"))
    names = read_table(spark, sf_dir, "part").select("p_partkey", padded.alias("p_name"))
    return names.select(
        "p_partkey", clean_text(F.col("p_name")).alias("native"), F.call_function("clean_text", "p_name").alias("by_function")
    )


@query(
    "sql_function_revenue",
    f"""WITH {SUMMARY_SQL}
    SELECT lower(category) AS asked, CAST(total_revenue AS DOUBLE) AS revenue FROM summary
    UNION ALL SELECT DISTINCT 'no ' || lower(p_type), CAST(NULL AS DOUBLE) FROM part""",
)
def sql_function_revenue(spark, sf_dir):
    facts = retail.order_facts(spark, sf_dir)
    register_category_revenue(spark, materialize(marts.category_summary(facts), "category-summary"))
    known = read_table(spark, sf_dir, "part").select(F.lower("p_type").alias("asked")).distinct()
    known.unionByName(known.select(F.concat(F.lit("no "), "asked").alias("asked"))).createOrReplaceTempView("asked_categories")
    return plain(spark.sql("SELECT asked, category_revenue(asked) AS revenue FROM asked_categories"))


@query("procedure_silver_orders", f"WITH {SILVER_SQL} SELECT * FROM silver")
def procedure_silver_orders(spark, sf_dir):
    path = scratch_path(spark, "silver-orders")
    build_silver_table(retail.bronze_orders(spark, sf_dir), path, retail.VERSION_ORDER[1:])
    return spark.read.parquet(path)
