"""Batch queries: scans, filters, joins, aggregates, windows, order and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stockpond.catalog.registry import (
    BRONZE_SQL,
    FACTS_SQL,
    PRODUCTS_SQL,
    SILVER_SQL,
    SUMMARY_SQL,
    plain,
    query,
)
from stockpond.functions.scalars import approx_distinct, day_of, preview
from stockpond.operators import marts
from stockpond.operators.changes import delete_where, new_rows, update_where
from stockpond.operators.keyed_scan import keyed_scan, running_sum, sequence_number
from stockpond.operators.ordering import fixed_sample, global_row_number, hash_bucket, top_k, write_sorted
from stockpond.operators.profile import column_summary
from stockpond.plans.features import null_counts
from stockpond.session import materialize, scratch_path
from stockpond.sources import retail
from stockpond.sources.tables import layer_row_counts, literal_rows, read_table

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]


@query(
    "category_revenue",
    f"""WITH {SUMMARY_SQL}
    SELECT category, CAST(total_revenue AS DOUBLE) AS total_revenue, order_count, TRUE AS customers_bounded FROM summary""",
)
def category_revenue(spark, sf_dir):
    """The Gold summary as it is kept: one pass, customers from a sketch (exact_vs_approx_customers checks its error)."""
    summary = marts.category_summary(retail.order_facts(spark, sf_dir))
    bounded = (F.col("unique_customers") > 0) & (F.col("unique_customers") <= F.col("order_count") * 1.05)
    return plain(summary.select("category", "total_revenue", "order_count", bounded.alias("customers_bounded")))


@query("silver_orders_dedup", f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_orders_dedup(spark, sf_dir):
    return retail.silver_orders(spark, sf_dir)


@query(
    "order_facts",
    f"WITH {FACTS_SQL} SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(order_value AS DOUBLE) AS order_value) FROM facts",
)
def order_facts(spark, sf_dir):
    return plain(retail.order_facts(spark, sf_dir))


@query(
    "customer_running_total",
    f"""WITH {FACTS_SQL}
    SELECT order_id, customer_id, order_ts, CAST(order_value AS DOUBLE) AS order_value,
           ROW_NUMBER() OVER w AS customer_order_number,
           CAST(SUM(order_value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS customer_running_total
    FROM facts WINDOW w AS (PARTITION BY customer_id ORDER BY order_ts, order_id)""",
)
def customer_running_total(spark, sf_dir):
    facts = retail.order_facts(spark, sf_dir).select("order_id", "customer_id", "order_ts", "order_value")
    return plain(
        keyed_scan(
            facts,
            ["customer_id"],
            ["order_ts", "order_id"],
            [sequence_number("customer_order_number"), running_sum("customer_running_total", "order_value")],
            # One row for each order at most, so hot customers show here without working out the facts.
            counted=retail.order_headers(spark, sf_dir),
        )
    )


@query(
    "customer_sequence",
    """SELECT o_orderkey, o_custkey, o_orderdate,
              ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number
       FROM orders""",
)
def customer_sequence(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return keyed_scan(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], [sequence_number("order_number")])


@query(
    "orders_over_time",
    f"""WITH {FACTS_SQL}
    SELECT CAST(order_ts AS DATE) AS order_date, COUNT(*) AS order_count,
           CAST(SUM(CASE WHEN order_status <> 'CANCELLED' THEN order_value ELSE 0 END) AS DOUBLE) AS total_revenue
    FROM facts GROUP BY 1""",
)
def orders_over_time(spark, sf_dir):
    return plain(marts.orders_over_time(retail.order_facts(spark, sf_dir)))


@query(
    "layer_row_counts",
    f"""WITH {SUMMARY_SQL}
    SELECT 'BRONZE ORDERS' AS layer, COUNT(*) AS row_count FROM bronze
    UNION ALL SELECT 'SILVER ORDERS', COUNT(*) FROM silver
    UNION ALL SELECT 'GOLD CATEGORY SUMMARY', COUNT(*) FROM summary""",
)
def layers(spark, sf_dir):
    silver = materialize(retail.silver_orders(spark, sf_dir), "silver-orders")
    return layer_row_counts(
        {
            "BRONZE ORDERS": retail.bronze_orders(spark, sf_dir),
            "SILVER ORDERS": silver,
            "GOLD CATEGORY SUMMARY": marts.category_summary(marts.enrich_orders(silver, retail.products(spark, sf_dir))),
        }
    )


@query(
    "union_all_layers",
    """SELECT o_orderkey AS id, 'orders' AS origin, o_orderdate AS at FROM orders
       UNION ALL SELECT l_orderkey, 'lineitem', l_shipdate FROM lineitem
       UNION ALL SELECT event_id, 'events', ts FROM events""",
)
def union_all_layers(spark, sf_dir):
    def part(table, key, at):
        return read_table(spark, sf_dir, table).select(
            F.col(key).alias("id"), F.lit(table).alias("origin"), F.col(at).alias("at")
        )

    orders = part("orders", "o_orderkey", "o_orderdate")
    lines = part("lineitem", "l_orderkey", "l_shipdate")
    return orders.unionByName(lines).unionByName(part("events", "event_id", "ts"))


@query(
    "table_row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS layer, COUNT(*) AS row_count FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    ),
)
def table_row_counts(spark, sf_dir):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return layer_row_counts({n: read_table(spark, sf_dir, n) for n in names})


@query("filtered_count", "SELECT COUNT(*) AS filled_order_count FROM orders WHERE o_orderstatus = 'F'")
def filtered_count(spark, sf_dir):
    filled = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return filled.agg(F.count("*").alias("filled_order_count"))


@query(
    "predicate_counts",
    """SELECT COUNT(*) FILTER (o_orderstatus <> 'P') AS not_cancelled,
              COUNT(*) FILTER (o_totalprice >= 100000 AND o_totalprice < 200000) AS in_range,
              COUNT(*) FILTER (NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')) AS negated,
              COUNT(*) FILTER (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AS either,
              COUNT(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS listed,
              COUNT(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS unlisted,
              COUNT(*) FILTER (o_orderpriority ILIKE '%specified%') AS matched,
              COUNT(*) FILTER (contains(lower(o_orderpriority), 'medium')) AS contained,
              COUNT(*) FILTER (o_orderdate IS NULL) AS undated,
              COUNT(*) FILTER (upper(o_orderpriority) = upper('5-low')) AS same_word
       FROM orders""",
)
def predicate_counts(spark, sf_dir):
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    high = ["1-URGENT", "2-HIGH"]
    return read_table(spark, sf_dir, "orders").agg(
        F.count_if(status != "P").alias("not_cancelled"),
        F.count_if((price >= 100000) & (price < 200000)).alias("in_range"),
        F.count_if(~((status == "F") & (priority == "5-LOW"))).alias("negated"),
        F.count_if((status == "F") | (priority == "1-URGENT")).alias("either"),
        F.count_if(priority.isin(high)).alias("listed"),
        F.count_if(~priority.isin(high)).alias("unlisted"),
        F.count_if(priority.ilike("%specified%")).alias("matched"),
        F.count_if(F.lower(priority).contains("medium")).alias("contained"),
        F.count_if(F.col("o_orderdate").isNull()).alias("undated"),
        F.count_if(F.upper(priority) == F.upper(F.lit("5-low"))).alias("same_word"),
    )


@query(
    "scalar_projection",
    """SELECT o_orderkey, UPPER(TRIM('  ' || lower(o_orderpriority) || ' ')) AS priority, LEFT(o_orderpriority, 3) AS priority_preview,
              o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS label,
              COALESCE(CASE WHEN o_orderstatus = 'F' THEN 1 END, 0) AS fulfilled,
              CAST(o_orderdate AS DATE) AS order_day, date_trunc('day', o_orderdate) AS day_start,
              o_orderdate + INTERVAL 5 DAY AS due_at,
              CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age_days,
              ROUND(LN(1 + o_totalprice), 6) AS log_price,
              CAST(3 * CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS triple_price,
              TRY_CAST(LEFT(o_orderpriority, 1) AS BIGINT) AS priority_rank
       FROM orders""",
)
def scalar_projection(spark, sf_dir):
    priority = F.col("o_orderpriority")
    projected = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.upper(F.trim(F.concat(F.lit("  "), F.lower(priority), F.lit(" ")))).alias("priority"),
        preview(priority, 3).alias("priority_preview"),
        F.concat_ws("-", "o_orderstatus", F.col("o_custkey").cast("string")).alias("label"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", 1), F.lit(0)).alias("fulfilled"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        day_of(F.col("o_orderdate")).alias("day_start"),
        F.timestamp_add("DAY", F.lit(5), "o_orderdate").alias("due_at"),
        F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date")).alias("age_days"),
        F.round(F.log1p("o_totalprice"), 6).alias("log_price"),
        (F.lit(3) * F.col("o_totalprice").cast("decimal(10,2)")).alias("triple_price"),
        F.left(priority, F.lit(1)).try_cast("bigint").alias("priority_rank"),
    )
    return plain(projected)


@query(
    "three_way_join_topk",
    """SELECT l_orderkey, o_orderdate, c_name, l_extendedprice, l_discount, l_linenumber, l_partkey, l_suppkey
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       ORDER BY c_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity LIMIT 1000""",
)
def three_way_join_topk(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        customer, orders.o_custkey == customer.c_custkey
    )
    return top_k(joined, ["c_name", *LINE_KEYS], 1000).select(
        "l_orderkey", "o_orderdate", "c_name", "l_extendedprice", "l_discount", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "wide_sort_topk",
    """SELECT * FROM lineitem ORDER BY l_returnflag, l_linestatus, l_extendedprice, l_orderkey, l_linenumber,
              l_partkey, l_suppkey, l_shipdate, l_quantity, l_discount, l_tax LIMIT 1000""",
)
def wide_sort_topk(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    order = ["l_returnflag", "l_linestatus", "l_extendedprice", "l_orderkey", "l_linenumber"]
    return top_k(lines, [*order, "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax"], 1000)


@query(
    "wide_sort_sink",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS row_count, MIN(l_extendedprice) AS lowest,
              MAX(l_extendedprice) AS highest, 0::BIGINT AS breaks FROM lineitem GROUP BY ALL""",
)
def wide_sort_sink(spark, sf_dir):
    """Also counts the places where a file begins before the one written ahead of it ends, in the same scan of the sorted table."""
    lines = read_table(spark, sf_dir, "lineitem")
    order = ["l_returnflag", "l_linestatus", "l_extendedprice", "l_orderkey"]
    stored = write_sorted(lines, order, scratch_path(spark, "wide-sort"))
    row = F.struct(*order)
    per_file = stored.groupBy(F.col("_metadata.file_name").alias("file"), "l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"), F.min(row).alias("low"), F.max(row).alias("high")
    )
    parts = materialize(per_file, "sorted-files")
    # From here on a few rows for each file; file names count up in the order of the sort.
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    files = parts.groupBy(number.alias("file")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    listed = F.sort_array(F.collect_list(F.struct("file", "low", "high")))
    ahead = F.zip_with(listed, F.slice(listed, 2, F.greatest(F.size(listed), F.lit(1))), lambda one, next_: one["high"] > next_["low"])
    breaks = files.agg(F.size(F.filter(ahead, lambda broken: broken)).cast("bigint").alias("breaks")).scalar()
    return parts.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("rows").alias("row_count"), F.min("least").alias("lowest"), F.max("most").alias("highest")
    ).withColumn("breaks", breaks)


@query(
    "anti_join_new_orders",
    "SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def anti_join_new_orders(spark, sf_dir):
    known = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return new_rows(read_table(spark, sf_dir, "orders"), known, ["o_orderkey"])


RUN_LOG_SQL = """
runs AS (
  SELECT event_id AS query_id, 'CALL ' || upper(event_type) || ' WITH ' || props AS query_text,
         upper(event_type) AS query_type, 'day0' || CAST(user_id % 10 AS VARCHAR) AS query_tag,
         'user_' || CAST(user_id AS VARCHAR) AS user_name, 'WH_' || CAST(user_id % 3 AS VARCHAR) AS warehouse_name,
         CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) END AS total_elapsed_time,
         CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS BIGINT) AS bytes_scanned, ts AS start_time
  FROM events)"""


@query(
    "null_counts",
    f"""WITH {RUN_LOG_SQL}
    SELECT COUNT(*) FILTER (query_id IS NULL) AS query_id, COUNT(*) FILTER (query_type IS NULL) AS query_type,
           COUNT(*) FILTER (total_elapsed_time IS NULL) AS total_elapsed_time,
           COUNT(*) FILTER (start_time IS NULL) AS start_time FROM runs""",
)
def nulls(spark, sf_dir):
    runs = retail.run_log(spark, sf_dir)
    return null_counts(runs.select("query_id", "query_type", "total_elapsed_time", "start_time"))


@query(
    "column_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS stddev,
                   CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM orders"""
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ),
)
def summary_of_columns(spark, sf_dir):
    report = column_summary(read_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return report.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query(
    "exact_vs_approx_customers",
    "SELECT COUNT(DISTINCT o_custkey) AS customers, TRUE AS approx_within_5_percent FROM orders",
)
def exact_vs_approx_customers(spark, sf_dir):
    """Both counts over the distinct customers: the sketch gives the same for repeated values."""
    customers = read_table(spark, sf_dir, "orders").select("o_custkey").distinct()
    exact, approx = F.count("o_custkey"), approx_distinct("o_custkey")
    return customers.agg(
        exact.alias("customers"), (F.abs(approx - exact) <= exact * 0.05).alias("approx_within_5_percent")
    )


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()


@query(
    "fixed_sample",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 3000",
)
def sample(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return fixed_sample(orders, ["o_orderkey"], 3000)


@query(
    "hash_split",
    """SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS in_train
       FROM orders""",
)
def hash_split_rows(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_orderkey", (hash_bucket("o_orderkey") < 80).alias("in_train"))


@query(
    "revenue_by_product",
    f"""WITH {FACTS_SQL}
    SELECT product_name, CAST(SUM(order_value) AS DOUBLE) AS order_value FROM facts
    WHERE order_status <> 'CANCELLED' GROUP BY product_name""",
)
def revenue_by_product(spark, sf_dir):
    return plain(marts.revenue_by_product(retail.order_facts(spark, sf_dir)))


@query(
    "avg_order_value",
    f"""WITH {FACTS_SQL}
    SELECT category, ROUND(CAST(SUM(order_value) AS DOUBLE) / COUNT(*), 4) AS avg_order_value FROM facts
    WHERE order_status <> 'CANCELLED' GROUP BY category""",
)
def avg_order_value(spark, sf_dir):
    averages = plain(marts.average_order_value(retail.order_facts(spark, sf_dir)))
    return averages.withColumn("avg_order_value", F.round("avg_order_value", 4))


@query(
    "category_lookup",
    f"""WITH {SUMMARY_SQL}, keys AS (SELECT DISTINCT lower(p_type) AS category FROM part
                                     UNION ALL SELECT DISTINCT 'no ' || lower(p_type) FROM part)
    SELECT keys.category, CAST(s.total_revenue AS DOUBLE) AS total_revenue
    FROM keys LEFT JOIN summary s ON upper(keys.category) = upper(s.category)""",
)
def category_lookup(spark, sf_dir):
    types = read_table(spark, sf_dir, "part").select(F.lower("p_type").alias("category")).distinct()
    unknown = types.select(F.concat(F.lit("no "), "category").alias("category"))
    gold = marts.category_summary(retail.order_facts(spark, sf_dir))
    return plain(marts.category_lookup(types.unionByName(unknown), gold))


@query(
    "global_row_number",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
              ROW_NUMBER() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS row_number
       FROM lineitem""",
)
def row_numbers(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    return global_row_number(lines, order).select("l_orderkey", "l_linenumber", "l_extendedprice", "row_number")


@query(
    "category_kpis",
    f"""WITH {SUMMARY_SQL}, days AS (
      SELECT CAST(order_ts AS DATE) AS order_date,
             SUM(CASE WHEN order_status <> 'CANCELLED' THEN order_value ELSE 0 END) AS total_revenue
      FROM facts GROUP BY 1)
    SELECT c.category AS top_category, c.unique_customers AS top_category_customers,
           d.order_date AS best_day, CAST(d.total_revenue AS DOUBLE) AS best_day_revenue
    FROM (SELECT * FROM summary ORDER BY unique_customers DESC, category DESC LIMIT 1) c,
         (SELECT * FROM days ORDER BY total_revenue DESC, order_date DESC LIMIT 1) d""",
)
def category_kpis(spark, sf_dir):
    return plain(marts.category_kpis(materialize(retail.order_facts(spark, sf_dir), "order-facts")))


@query(
    "product_summary",
    f"""WITH {PRODUCTS_SQL}
    SELECT category, COUNT(*) AS product_count, CAST(SUM(price) AS DOUBLE) AS total_value FROM products GROUP BY category""",
)
def product_summary(spark, sf_dir):
    return plain(marts.product_summary(retail.products(spark, sf_dir)))


@query(
    "update_snapshot",
    """SELECT p_partkey, p_type, p_size,
              CASE WHEN p_size > 25 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice FROM part""",
)
def update_snapshot(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return update_where(part, F.col("p_size") > 25, {"p_retailprice": F.col("p_retailprice") * 2})


@query("delete_snapshot", "SELECT p_partkey, p_name, p_size FROM part WHERE NOT (p_size > 25)")
def delete_snapshot(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return delete_where(part, F.col("p_size") > 25)


@query(
    "table_sinks",
    """SELECT o_orderstatus, COUNT(*) AS row_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders GROUP BY o_orderstatus""",
)
def table_sinks(spark, sf_dir):
    """Create as select, replace the rows, append the rest, and read through a view."""
    path = scratch_path(spark, "orders-table")
    orders = read_table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    filled = F.col("o_orderstatus") == "F"
    orders.write.mode("overwrite").parquet(path)
    orders.where(filled).write.mode("overwrite").parquet(path)
    orders.where(~filled).write.mode("append").parquet(path)
    spark.read.schema(orders.schema).parquet(path).createOrReplaceTempView("stored_orders")
    return plain(
        spark.sql(
            "SELECT o_orderstatus, COUNT(*) AS row_count, SUM(o_totalprice) AS total FROM stored_orders GROUP BY o_orderstatus"
        )
    )


@query(
    "named_table",
    """SELECT o_orderstatus, COUNT(*) AS row_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders GROUP BY o_orderstatus""",
)
def named_table(spark, sf_dir):
    """A table by name whose rows are replaced while the table stays, and to which rows are added."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = read_table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    filled = F.col("o_orderstatus") == "F"
    orders.write.option("path", scratch_path(spark, "named-table")).saveAsTable(name)
    orders.where(filled).write.insertInto(name, overwrite=True)
    orders.where(~filled).write.insertInto(name)
    return plain(spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("row_count"), F.sum("o_totalprice").alias("total")))


URGENCY = [("1-URGENT", 1, "today"), ("2-HIGH", 2, "today"), ("3-MEDIUM", 3, "this week"), ("4-NOT SPECIFIED", None, None)]


@query(
    "literal_rows",
    """SELECT when_, COUNT(*) AS orders, CAST(SUM(step) AS BIGINT) AS steps
       FROM orders LEFT JOIN (VALUES ('1-URGENT', 1, 'today'), ('2-HIGH', 2, 'today'), ('3-MEDIUM', 3, 'this week'), ('4-NOT SPECIFIED', NULL, NULL)) u(priority, step, when_)
            ON o_orderpriority = priority GROUP BY when_""",
)
def literal_rows_query(spark, sf_dir):
    urgency = literal_rows(spark, URGENCY, "priority string, step int, when_ string")
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"))
    return orders.join(urgency, "priority", "left").groupBy("when_").agg(F.count("*").alias("orders"), F.sum("step").alias("steps"))


@query(
    "bronze_versions",
    f"""WITH {BRONZE_SQL}
    SELECT order_status, COUNT(*) AS versions, COUNT(DISTINCT order_id) AS orders, MIN(order_ts) AS first_ts,
           MAX(order_ts) AS last_ts, SUM(quantity)::BIGINT AS quantity FROM bronze GROUP BY order_status""",
)
def bronze_versions(spark, sf_dir):
    return retail.bronze_orders(spark, sf_dir).groupBy("order_status").agg(
        F.count("*").alias("versions"),
        F.count_distinct("order_id").alias("orders"),
        F.min("order_ts").alias("first_ts"),
        F.max("order_ts").alias("last_ts"),
        F.sum("quantity").alias("quantity"),
    )
