"""JSON documents, change feeds, merges, history and the dependent Bronze-Silver-Gold run."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.catalog.registry import BRONZE_SQL, LATEST_SQL, PRODUCTS_SQL, plain, query
from stockpond.operators import changes, history, kept_history, kept_summary, semi
from stockpond.operators.changes import ACTION, IS_UPDATE
from stockpond.plans.jobs import compact_silver, merge_silver, read_silver, refresh_summary_if_changed, run_medallion
from stockpond.session import materialize, materialize_by_key, scratch_path
from stockpond.sources import retail
from stockpond.sources.tables import read_table

# --- JSON -------------------------------------------------------------------------------


def order_documents(spark, sf_dir):
    """One nested document per order; some have no order list, some an empty one."""
    o = read_table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    first = F.struct(F.col("o_orderkey").alias("id"), price.alias("amount"))
    second = F.struct((F.col("o_orderkey") + 1_000_000_000).alias("id"), F.lit(12.34).cast("decimal(18,2)").alias("amount"))
    listed = F.when(F.col("o_orderpriority") != "1-URGENT", F.when(F.col("o_orderpriority") == "2-HIGH", F.array().cast("array<struct<id:bigint,amount:decimal(18,2)>>")).otherwise(F.array(first, second)))
    customer = F.struct(
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("region"),
    )
    text = F.to_json(F.struct(customer.alias("customer"), listed.alias("orders")))
    return semi.parse_documents(o.select(F.col("o_orderkey").alias("event_id"), text.alias("text")), "text")


ITEMS_SQL = """
items AS (
  SELECT o_orderkey AS event_id, 'Customer ' || CAST(o_custkey AS VARCHAR) AS customer_name, o_orderpriority AS region,
         o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT o_orderkey, 'Customer ' || CAST(o_custkey AS VARCHAR), o_orderpriority, o_orderkey + 1000000000, 12.34
  FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))"""


def order_items(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    items = semi.flatten_array(
        docs, "doc", "$.orders", {"order_id": ("$.id", "bigint"), "amount": ("$.amount", "decimal(18,2)")}
    )
    return items.select(
        "event_id",
        semi.path("doc", "$.customer.name", "string").alias("customer_name"),
        semi.path("doc", "$['customer']['region']", "string").alias("region"),
        "order_id",
        "amount",
    )


@query(
    "json_path_events",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def json_path_events(spark, sf_dir):
    events = semi.parse_documents(read_table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return events.select(
        "event_id", semi.path("doc", "$.k", "bigint").alias("k"), semi.path("doc", "$.a.b", "string").alias("missing")
    )


@query("json_array_explode", f"WITH {ITEMS_SQL} SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM items")
def json_array_explode(spark, sf_dir):
    return plain(order_items(spark, sf_dir))


@query(
    "json_group_sum",
    f"""WITH {ITEMS_SQL}
    SELECT customer_name, CAST(SUM(amount) AS DOUBLE) AS total_order_amount FROM items GROUP BY customer_name""",
)
def json_group_sum(spark, sf_dir):
    return plain(order_items(spark, sf_dir).groupBy("customer_name").agg(F.sum("amount").alias("total_order_amount")))


@query(
    "json_typeof",
    """SELECT 'OBJECT' AS data_type, COUNT(*) AS documents FROM events
       UNION ALL SELECT 'INTEGER', COUNT(*) FROM events""",
)
def json_typeof(spark, sf_dir):
    docs = semi.parse_documents(read_table(spark, sf_dir, "events").select("props"), "props")
    members = docs.select(semi.path("doc", "$.k", "variant").alias("doc"))
    return semi.document_types(docs, "doc").unionByName(semi.document_types(members, "doc"))


# --- versions of the orders table -------------------------------------------------------

KEY = ["order_id"]
VERSION_DAYS = ["2026-01-01", "2026-01-02", "2026-01-03"]

# v1: cancelled low-priority orders are deleted, fulfilled urgent ones get 100 dearer, open
# high-priority ones move to a new key. v2: open medium ones become urgent and 50 dearer.
DELETED = "status = 'P' AND priority = '5-LOW'"
DEARER = "status = 'F' AND priority = '1-URGENT'"
MOVED = "status = 'O' AND priority = '2-HIGH'"
RAISED = "status = 'O' AND priority = '3-MEDIUM'"
NEW_KEYS = 1_000_000_000_000

VERSIONS_SQL = f"""
v0 AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
v1 AS (
  SELECT CASE WHEN {MOVED} THEN order_id + {NEW_KEYS} ELSE order_id END AS order_id, customer_id, status, priority,
         CASE WHEN {DEARER} THEN price + 100 ELSE price END AS price
  FROM v0 WHERE NOT ({DELETED})),
v2 AS (
  SELECT order_id, customer_id, status, CASE WHEN {RAISED} THEN '1-URGENT' ELSE priority END AS priority,
         CASE WHEN {RAISED} THEN price + 50 ELSE price END AS price FROM v1)"""

PLAIN_SQL = "order_id, customer_id, status, priority, CAST(price AS DOUBLE) AS price"


def version_0(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )


def version_1(v0):
    kept = changes.delete_where(v0, F.expr(DELETED))
    dearer = changes.update_where(kept, F.expr(DEARER), {"price": F.col("price") + 100})
    return changes.update_where(dearer, F.expr(MOVED), {"order_id": F.col("order_id") + NEW_KEYS})


def version_2(v1):
    return changes.update_where(
        v1, F.expr(RAISED), {"price": F.col("price") + 50, "priority": F.lit("1-URGENT")}
    )


def all_versions(spark, sf_dir):
    v0 = version_0(spark, sf_dir)
    v1 = version_1(v0)
    return v0, v1, version_2(v1)


def change_log(spark, sf_dir):
    """The append-only log of the three versions, one commit per day."""
    v0, v1, v2 = all_versions(spark, sf_dir)
    feeds = [history.snapshot_as_changes(v0), changes.change_feed(v0, v1, KEY), changes.change_feed(v1, v2, KEY)]
    entries = [
        history.log_entry(feed, i, F.lit(f"{day} 12:00:00")) for i, (feed, day) in enumerate(zip(feeds, VERSION_DAYS))
    ]
    return materialize(entries[0].unionByName(entries[1]).unionByName(entries[2]), "change-log")


def stored_summary(spark, sf_dir):
    return materialize(changes.summarize(version_0(spark, sf_dir), ["priority"], "price"), "stored-summary")


def stored_feeds(spark, sf_dir):
    """The changes of two versions, as a table that refreshes read."""
    v0, v1, v2 = all_versions(spark, sf_dir)
    feeds = [changes.change_feed(old, new, KEY).withColumn(history.VERSION, F.lit(i)) for i, (old, new) in enumerate(((v0, v1), (v1, v2)), 1)]
    return materialize(feeds[0].unionByName(feeds[1]), "stored-feeds")


def refreshed_summary(spark, stored, log):
    """The summary after each new part of the log; a part that is consumed does not count again."""
    offsets = scratch_path(spark, "offsets")
    for upto in (1, 2, 2):
        feed = changes.pending_changes(log.where(F.col(history.VERSION) <= upto), offsets, "summary", history.VERSION)
        stored = materialize(changes.refresh_summary(stored, feed, ["priority"], "price"), "summary")
        changes.mark_consumed(feed, offsets, "summary", history.VERSION)
    return stored


FEED_SQL = f"""
feed AS (
  SELECT *, 'DELETE' AS _action, {DEARER} AS _is_update FROM v0 WHERE ({DELETED}) OR ({DEARER}) OR ({MOVED})
  UNION ALL
  SELECT *, 'INSERT', {DEARER} FROM v1 WHERE ({DEARER}) OR ({MOVED}))"""


@query(
    "change_feed",
    f"WITH {VERSIONS_SQL},{FEED_SQL} SELECT {PLAIN_SQL}, _action, _is_update FROM feed",
)
def change_feed(spark, sf_dir):
    v0, v1, _ = all_versions(spark, sf_dir)
    return plain(changes.change_feed(v0, v1, KEY))


@query(
    "change_feed_by_range",
    f"WITH {VERSIONS_SQL},{FEED_SQL} SELECT {PLAIN_SQL}, _action, _is_update FROM feed",
)
def change_feed_by_range(spark, sf_dir):
    """The same feed; ranges of a thousand order numbers whose digests agree are not shuffled."""
    v0, v1, _ = all_versions(spark, sf_dir)
    return plain(changes.change_feed_by_range(v0, v1, KEY, F.expr("order_id div 1000")))


@query(
    "unchanged_feed",
    f"""WITH {VERSIONS_SQL} SELECT (SELECT COUNT(*) FROM (SELECT * FROM v0 EXCEPT SELECT * FROM v0)) AS changed_rows,
       (SELECT COUNT(*) FROM v0 LEFT JOIN v1 USING (order_id) WHERE v1.order_id IS NULL) AS deleted_rows""",
)
def unchanged_feed(spark, sf_dir):
    """A table against itself gives an empty feed; against its next version, the deleted rows."""
    v0 = version_0(spark, sf_dir)
    deleted = changes.change_feed(v0, version_1(v0), KEY).where((F.col(ACTION) == "DELETE") & ~F.col(IS_UPDATE))
    counted = changes.change_feed(v0, v0, KEY).agg(F.count("*").alias("changed_rows"))
    return counted.withColumn("deleted_rows", deleted.agg(F.count("*").alias("n")).scalar())


@query("merge_apply", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v1")
def merge_apply(spark, sf_dir):
    """The feed replayed over the version it leads to, so a second time changes nothing."""
    v0, v1, _ = all_versions(spark, sf_dir)
    feed = materialize(changes.change_feed(v0, v1, KEY), "feed")
    once = changes.apply_changes(v0, feed, KEY)
    return plain(changes.apply_changes(once, feed, KEY))


@query(
    "upsert_merge",
    f"""WITH {VERSIONS_SQL}, source AS (SELECT * FROM v1 WHERE ({DEARER}) OR ({MOVED}))
    SELECT {PLAIN_SQL} FROM source
    UNION ALL SELECT {PLAIN_SQL} FROM v0 WHERE order_id NOT IN (SELECT order_id FROM source)""",
)
def upsert_merge(spark, sf_dir):
    v0, v1, _ = all_versions(spark, sf_dir)
    source = changes.effective_changes(changes.change_feed(v0, v1, KEY)).where(F.col(ACTION) == "INSERT")
    source = materialize(source, "upsert-source")
    return plain(changes.upsert(v0, source.drop(ACTION, IS_UPDATE), KEY))


@query(
    "incremental_summary",
    f"""WITH {VERSIONS_SQL}
    SELECT priority, COUNT(*) AS row_count, COUNT(price) AS value_count, CAST(SUM(price) AS DOUBLE) AS total
    FROM v2 GROUP BY priority""",
)
def incremental_summary(spark, sf_dir):
    """The stored summary taken through two stored feeds, priority changes included.

    Summary and feeds are tables: a refresh reads these and no version of the orders.
    """
    return plain(refreshed_summary(spark, stored_summary(spark, sf_dir), stored_feeds(spark, sf_dir)))


def kept_buckets(spark, sf_dir):
    """Where the summary of the first version is kept in buckets, and the changes of two versions, a folder for each."""
    root = scratch_path(spark, "kept-summary")
    kept_summary.create(version_0(spark, sf_dir), root, ["priority"], "price", 0)
    return root, materialize(stored_feeds(spark, sf_dir), "feeds-by-version", [history.VERSION])


def refreshed_buckets(spark, root, log):
    for upto in (1, 2, 2):
        kept_summary.refresh(log, root, history.VERSION, upto)
    return kept_summary.read(spark, root)


@query(
    "kept_summary",
    f"""WITH {VERSIONS_SQL}
    SELECT priority, COUNT(*) AS row_count, COUNT(price) AS value_count, CAST(SUM(price) AS DOUBLE) AS total
    FROM v2 GROUP BY priority""",
)
def kept_summary_query(spark, sf_dir):
    """The summary in buckets: each refresh reads the new part of the log and rewrites the buckets it touches."""
    return plain(refreshed_buckets(spark, *kept_buckets(spark, sf_dir)))


@query(
    "skip_unchanged_refresh",
    f"""WITH {VERSIONS_SQL}
    SELECT priority, COUNT(*) AS row_count, COUNT(price) AS value_count, CAST(SUM(price) AS DOUBLE) AS total,
           FALSE AS refreshed FROM v0 GROUP BY priority""",
)
def skip_unchanged_refresh(spark, sf_dir):
    v0 = version_0(spark, sf_dir)
    stored = changes.summarize(v0, ["priority"], "price")
    result, refreshed = refresh_summary_if_changed(stored, changes.change_feed(v0, v0, KEY), ["priority"], "price")
    return plain(result).withColumn("refreshed", F.lit(refreshed))


@query(
    "full_refresh_summary",
    f"""WITH {VERSIONS_SQL}
    SELECT priority, COUNT(*) AS row_count, COUNT(price) AS value_count, CAST(SUM(price) AS DOUBLE) AS total
    FROM v2 GROUP BY priority""",
)
def full_refresh_summary(spark, sf_dir):
    return plain(changes.summarize(all_versions(spark, sf_dir)[2], ["priority"], "price"))


@query("passthrough_refresh", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v2")
def passthrough_refresh(spark, sf_dir):
    v0, v1, v2 = all_versions(spark, sf_dir)
    return plain(changes.passthrough_refresh(changes.passthrough_refresh(v0, v0, v1, KEY), v1, v2, KEY))


def kept_log(spark, sf_dir, every):
    """The three versions as commits, with a snapshot after every ``every``-th."""
    v0, v1, v2 = all_versions(spark, sf_dir)
    root = scratch_path(spark, "kept-log")
    feeds = [history.snapshot_as_changes(v0), changes.change_feed(v0, v1, KEY), changes.change_feed(v1, v2, KEY)]
    for feed, day in zip(feeds, VERSION_DAYS):
        kept_history.commit(feed, root, KEY, F.lit(f"{day} 12:00:00"), every)
    return root


@query("snapshot_and_tail", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v2")
def snapshot_and_tail(spark, sf_dir):
    """The last state from the snapshot of the second commit and the one change file after it."""
    return plain(kept_history.state_of(spark, kept_log(spark, sf_dir, 2), KEY, 2))


@query("snapshot_as_of", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v1")
def snapshot_as_of(spark, sf_dir):
    """A point in time whose state is a snapshot: no change file is read."""
    return plain(kept_history.state_at(spark, kept_log(spark, sf_dir, 2), KEY, F.lit("2026-01-02 18:00:00")))


@query("state_as_of", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v1")
def state_as_of(spark, sf_dir):
    at = F.lit("2026-01-03 11:59:59").cast("timestamp_ntz")
    return plain(history.state_as_of(change_log(spark, sf_dir), KEY, at))


@query("state_before_version", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v0")
def state_before_version(spark, sf_dir):
    return plain(history.state_before(change_log(spark, sf_dir), KEY, 1))


@query("restore_dropped", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v2")
def restore_dropped(spark, sf_dir):
    log = change_log(spark, sf_dir)
    dropped = log.unionByName(history.drop_entry(log, KEY, 3, F.lit("2026-01-04 12:00:00")))
    restored = dropped.unionByName(history.restore_entry(log, KEY, 3, 4, F.lit("2026-01-05 12:00:00")))
    return plain(history.state_before(restored, KEY, 5))


@query(
    "state_after_drop",
    f"""WITH {VERSIONS_SQL} SELECT 'before' AS state, COUNT(*) AS live_rows FROM v2
    UNION ALL SELECT 'after', (SELECT COUNT(*) FROM (SELECT order_id FROM v2 EXCEPT SELECT order_id FROM v2))""",
)
def state_after_drop(spark, sf_dir):
    """All rows up to the drop, none after it."""
    log = change_log(spark, sf_dir)
    dropped = materialize(log.unionByName(history.drop_entry(log, KEY, 3, F.lit("2026-01-04 12:00:00"))), "dropped-log")
    states = [history.state_before(dropped, KEY, v).agg(F.lit(s).alias("state"), F.count("*").alias("live_rows")) for s, v in (("before", 3), ("after", 4))]
    return states[0].unionByName(states[1])


SOUTHERN = "status = 'O' AND priority = '4-NOT SPECIFIED'"
HIDDEN = "status = 'F' AND priority = '5-LOW'"


@query(
    "overlay_clone",
    f"""WITH {VERSIONS_SQL}
    SELECT 'clone' AS side, order_id, customer_id, status, CASE WHEN {SOUTHERN} THEN 'SOUTH' ELSE priority END AS priority,
           CAST(price AS DOUBLE) AS price FROM v1 WHERE NOT ({HIDDEN})
    UNION ALL SELECT 'base', {PLAIN_SQL} FROM v1""",
)
def overlay_clone(spark, sf_dir):
    base = version_1(version_0(spark, sf_dir))
    southern = F.expr(SOUTHERN)
    touched = base.where(southern | F.expr(HIDDEN)).withColumn(ACTION, F.when(southern, "INSERT").otherwise("DELETE"))
    own = changes.update_where(touched, southern, {"priority": F.lit("SOUTH")})
    clone = history.overlay(base, own, KEY)
    return plain(
        clone.select(F.lit("clone").alias("side"), "*").unionByName(base.select(F.lit("base").alias("side"), "*"))
    )


FILES_PER_MONTH = 1


@query(
    "layout_report",
    f"""WITH placed AS (
      SELECT o_custkey, o_orderdate, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
             o_orderkey % {FILES_PER_MONTH} AS slot FROM orders),
    files AS (
      SELECT order_month, slot, MIN(o_custkey) AS low, MAX(o_custkey) AS high, MIN(o_orderdate) AS opened, MAX(o_orderdate) AS closed
      FROM placed GROUP BY 1, 2),
    customers AS (
      SELECT COUNT(*) - 1 AS met, COUNT(*) FILTER (WHERE b.low <= a.low) AS depth
      FROM files a JOIN files b ON b.low <= a.high AND b.high >= a.low GROUP BY a.order_month, a.slot),
    dates AS (
      SELECT COUNT(*) - 1 AS met, COUNT(*) FILTER (WHERE b.opened <= a.opened) AS depth
      FROM files a JOIN files b ON b.opened <= a.closed AND b.closed >= a.opened GROUP BY a.order_month, a.slot)
    SELECT 'scattered' AS layout, COUNT(*) AS file_count, ROUND(AVG(met), 6) AS average_overlaps, ROUND(AVG(depth), 6) AS average_depth FROM customers
    UNION ALL SELECT 'clustered', COUNT(*), ROUND(AVG(met), 6), ROUND(AVG(depth), 6) FROM dates""",
)
def layout_report(spark, sf_dir):
    """Files by order month: their customer ranges overlap, their date ranges do not."""
    path = scratch_path(spark, "orders-by-month")
    source = read_table(spark, sf_dir, "orders")
    orders = source.withColumns(
        {"order_month": F.trunc(F.to_date("o_orderdate"), "MONTH"), "slot": F.col("o_orderkey") % FILES_PER_MONTH}
    )
    orders.repartition("order_month", "slot").write.partitionBy("order_month", "slot").parquet(path)
    stored = spark.read.schema(orders.schema).parquet(path)
    reports = {
        "scattered": history.layout_report(history.file_ranges(stored, "o_custkey")),
        "clustered": history.layout_report(history.file_ranges(stored, "o_orderdate")),
    }
    labelled = [
        r.select(
            F.lit(n).alias("layout"),
            "file_count",
            F.round("average_overlaps", 6).alias("average_overlaps"),
            F.round("average_depth", 6).alias("average_depth"),
        )
        for n, r in reports.items()
    ]
    return labelled[0].unionByName(labelled[1])


@query("json_strict", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_strict(spark, sf_dir):
    """Parsed strictly: one malformed text would fail the query."""
    events = semi.parse_documents(read_table(spark, sf_dir, "events").select("event_id", "props"), "props", strict=True)
    return events.select("event_id", semi.path("doc", "$.k", "bigint").alias("k"))


@query(
    "medallion_gold",
    f"""WITH {BRONZE_SQL},{PRODUCTS_SQL},
    early AS (SELECT * FROM bronze WHERE order_ts < TIMESTAMP '1998-01-01'),
    ingested AS (SELECT * FROM early UNION ALL SELECT * FROM bronze WHERE order_id NOT IN (SELECT order_id FROM early)),
    current AS (SELECT * FROM ingested QUALIFY {LATEST_SQL} = 1)
    SELECT category, CAST(SUM(CAST(quantity * price AS DECIMAL(21,2))) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count,
           COUNT(DISTINCT customer_id) AS unique_customers
    FROM current JOIN products USING (product_id) WHERE UPPER(TRIM(order_status)) <> 'CANCELLED' GROUP BY category""",
)
def medallion_gold(spark, sf_dir):
    """Two runs and a repeated one: versions of orders that are already known stay outside."""
    root = scratch_path(spark, "medallion")
    # Every run looks up the known orders among all landing rows; in buckets these are not shuffled again.
    landing = materialize_by_key(retail.bronze_orders(spark, sf_dir), "landing", "order_id")
    goods = retail.products(spark, sf_dir)
    ties = retail.VERSION_ORDER[1:]
    early = landing.where(F.col("order_ts") < F.lit("1998-01-01").cast("timestamp_ntz"))
    run_medallion(early, goods, root, 1, ties, exact=True)
    run_medallion(landing, goods, root, 2, ties, exact=True)
    return plain(run_medallion(landing, goods, root, 2, ties, exact=True))


@query(
    "compacted_silver",
    f"""WITH {BRONZE_SQL}
    SELECT order_id, customer_id, product_id, COALESCE(quantity, 0) AS quantity, UPPER(TRIM(order_status)) AS order_status, order_ts
    FROM bronze QUALIFY {LATEST_SQL} = 1""",
)
def compacted_silver(spark, sf_dir):
    """Four Silver runs, each with a quarter of the orders and the first run's once more, two of them compacted."""
    folder = scratch_path(spark, "silver")
    landing = materialize(retail.bronze_orders(spark, sf_dir), "landing")
    for run in range(1, 5):
        merge_silver(landing.where((F.col("order_id") % 4 == run % 4) | (F.col("order_id") % 4 == 1)), folder, run, retail.VERSION_ORDER[1:])
        if run in (2, 3):
            compact_silver(spark, folder, run - 1)
    return read_silver(spark, folder)
