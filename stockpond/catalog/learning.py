"""Features, series, models and drift."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stockpond.catalog.registry import plain, query
from stockpond.operators.asof import asof_join, latest_features, leakage_report
from stockpond.operators.ordering import hash_bucket, hash_split
from stockpond.plans import drift, features, forecast, models
from stockpond.plans.forest_sql import batch_scores_by_sql
from stockpond.session import materialize, scratch_path
from stockpond.sources import retail
from stockpond.sources.tables import read_table

LABEL = "is_fulfilled"

EVENTS_SQL = """
order_events AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS ts, o_orderpriority AS order_priority,
         CAST(o_totalprice AS DECIMAL(18,2)) AS order_value, 0 AS ship_priority,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fulfilled
  FROM orders)"""

FEATURES_SQL = f"""{EVENTS_SQL},
prior AS (
  SELECT *, CAST(COALESCE(SUM(order_value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS prior_spend,
         CAST(date_diff('day', CAST(MIN(ts) OVER (PARTITION BY customer_id) AS DATE), CAST(ts AS DATE)) AS INTEGER) AS days_since_first_order,
         COALESCE(LAG(order_priority) OVER w, 'NONE') AS prior_priority
  FROM order_events WINDOW w AS (PARTITION BY customer_id ORDER BY ts, order_id)),
vocabulary AS (SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) AS ordinal
               FROM (SELECT DISTINCT prior_priority AS value FROM prior)),
feature_table AS (
  SELECT customer_id, ts, LN(1 + prior_spend) AS log_prior_spend, days_since_first_order, ordinal AS priority_ordinal
  FROM prior JOIN vocabulary ON prior_priority = value
  QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id, ts ORDER BY order_id) = 1)"""


def stored_features(spark, sf_dir):
    return materialize(features.feature_table(retail.customer_order_events(spark, sf_dir)), "feature-table")


def training_rows(spark, sf_dir):
    events = retail.customer_order_events(spark, sf_dir)
    return materialize(features.training_set(events, stored_features(spark, sf_dir)), "training-set")


@query(
    "customer_features",
    f"""WITH {FEATURES_SQL}
    SELECT customer_id, order_id, ts, prior_spend, ROUND(LN(1 + prior_spend), 6) AS log_prior_spend, days_since_first_order, prior_priority
    FROM prior""",
)
def customer_features(spark, sf_dir):
    prior = features.prior_order_features(retail.customer_order_events(spark, sf_dir))
    return plain(
        prior.select(
            "customer_id",
            "order_id",
            "ts",
            "prior_spend",
            F.round("log_prior_spend", 6).alias("log_prior_spend"),
            "days_since_first_order",
            "prior_priority",
        )
    )


@query(
    "customer_labels",
    f"""WITH {EVENTS_SQL} SELECT customer_id, order_id, ts, is_fulfilled FROM order_events""",
)
def customer_labels(spark, sf_dir):
    return features.labels(retail.customer_order_events(spark, sf_dir))


@query(
    "pit_training_set",
    f"""WITH {FEATURES_SQL}
    SELECT e.customer_id, e.ts, e.order_id, e.is_fulfilled, ROUND(f.log_prior_spend, 6) AS log_prior_spend,
           f.days_since_first_order, f.priority_ordinal
    FROM order_events e ASOF LEFT JOIN feature_table f ON e.customer_id = f.customer_id AND e.ts >= f.ts""",
)
def pit_training_set(spark, sf_dir):
    rows = features.training_set(retail.customer_order_events(spark, sf_dir), stored_features(spark, sf_dir))
    return rows.withColumn("log_prior_spend", F.round("log_prior_spend", 6))


@query(
    "asof_last_view",
    """WITH spine AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'),
            seen AS (SELECT user_id, ts, value, props FROM events WHERE event_type = 'view')
       SELECT s.user_id, s.ts, s.event_id, v.value, v.props
       FROM spine s ASOF LEFT JOIN seen v ON s.user_id = v.user_id AND s.ts >= v.ts""",
)
def asof_last_view(spark, sf_dir):
    """Every purchase with the user's latest view before it."""
    events = read_table(spark, sf_dir, "events")
    spine = events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    seen = events.where("event_type = 'view'").select("user_id", "ts", "value", "props")
    return asof_join(spine, seen, "user_id", "ts", ["value", "props"])


@query(
    "leakage_report",
    f"""WITH {EVENTS_SQL}, joined AS (
      SELECT e.ts, m.feature_ts FROM order_events e
      JOIN (SELECT customer_id, MAX(ts) AS feature_ts FROM order_events GROUP BY 1) m USING (customer_id))
    SELECT COUNT(*) AS rows, COUNT(*) FILTER (feature_ts > ts) AS leaked_rows,
           ROUND(COUNT(*) FILTER (feature_ts > ts) / COUNT(*), 9) AS leaked_share FROM joined""",
)
def leakage(spark, sf_dir):
    events = retail.customer_order_events(spark, sf_dir)
    report = leakage_report(features.labels(events), events, "customer_id", "ts")
    return report.withColumn("leaked_share", F.round("leaked_share", 9))


@query(
    "latest_features",
    f"""WITH {FEATURES_SQL}
    SELECT customer_id, ts AS feature_ts, ROUND(log_prior_spend, 6) AS log_prior_spend, days_since_first_order FROM feature_table
    QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ts DESC) = 1""",
)
def newest_features(spark, sf_dir):
    newest = latest_features(stored_features(spark, sf_dir), "customer_id", "ts", ["log_prior_spend", "days_since_first_order"])
    return newest.withColumn("log_prior_spend", F.round("log_prior_spend", 6))


@query(
    "ordinal_encode",
    """WITH vocabulary AS (SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) AS ordinal
                           FROM (SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'))
       SELECT o_orderkey, COALESCE(ordinal, -1) AS priority_ordinal FROM orders LEFT JOIN vocabulary ON o_orderpriority = value""",
)
def ordinal_encode(spark, sf_dir):
    """The encoder is fitted without one of the values, which then counts as unknown."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    fitted_on = orders.where("o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
    vocabulary = features.fit_ordinal(fitted_on, "o_orderpriority")
    encoded = features.transform_ordinal(orders, vocabulary, "o_orderpriority", "priority_ordinal")
    return encoded.select("o_orderkey", "priority_ordinal")


@query(
    "one_hot",
    """WITH vocabulary AS (SELECT value, ROW_NUMBER() OVER (ORDER BY value) - 1 AS i
                           FROM (SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority <> '5-LOW'))
       SELECT o_orderkey, CASE COALESCE(i, -1) WHEN 0 THEN '1,0,0,0' WHEN 1 THEN '0,1,0,0' WHEN 2 THEN '0,0,1,0'
              WHEN 3 THEN '0,0,0,1' ELSE '0,0,0,0' END AS encoded
       FROM orders LEFT JOIN vocabulary ON o_orderpriority = value""",
)
def one_hot(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    encoder = features.fit_one_hot(orders.where("o_orderpriority <> '5-LOW'"), "o_orderpriority", "_vector")
    flags = F.transform(vector_to_array("_vector"), lambda x: x.cast("int").cast("string"))
    return encoder.transform(orders).select("o_orderkey", F.concat_ws(",", flags).alias("encoded"))


@query(
    "standard_scale",
    """WITH s AS (SELECT AVG(o_totalprice) AS m, STDDEV_POP(o_totalprice) AS d FROM orders)
       SELECT o_orderkey, ROUND((o_totalprice - m) / d, 6) AS price_scaled, 0.0::DOUBLE AS ship_scaled FROM orders, s""",
)
def standard_scale(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit(0).alias("ship_priority"))
    scaled = features.standard_scale(orders, {"o_totalprice": "price_scaled", "ship_priority": "ship_scaled"})
    return scaled.withColumn("price_scaled", F.round("price_scaled", 6))


@query(
    "feature_view_refresh",
    f"""WITH {FEATURES_SQL}
    SELECT customer_id, ts, ROUND(log_prior_spend, 6) AS log_prior_spend, days_since_first_order, priority_ordinal FROM feature_table""",
)
def feature_view_refresh(spark, sf_dir):
    """A view refreshed with later days and with rows of days it already has equals a full build."""
    root = scratch_path(spark, "feature-store")
    events = retail.customer_order_events(spark, sf_dir)
    # Prior priorities are the priorities there are, and NONE.
    known = events.select(F.col("order_priority").alias("prior_priority")).unionByName(spark.createDataFrame([(features.NO_PRIORITY,)], "prior_priority string"))
    vocabulary = features.fit_ordinal(known, "prior_priority")

    def compute(rows):
        encoded = features.transform_ordinal(
            features.prior_order_features(rows), vocabulary, "prior_priority", "priority_ordinal"
        )
        return features.first_per_time(encoded)

    # The first build lacks all later days and every seventh order of the days it has.
    early = events.where((F.col("ts") < F.lit("2001-01-01").cast("timestamp_ntz")) & (F.col("order_id") % 7 != 3))
    features.refresh_feature_view(early, compute, root, "customer_features", 1)
    features.refresh_feature_view(events.where("order_id % 5 <> 2").unionByName(early.where("order_id % 5 = 2")), compute, root, "customer_features", 1)
    features.refresh_feature_view(events, compute, root, "customer_features", 1)
    features.refresh_feature_view(events, compute, root, "customer_features", 1)
    view = features.read_feature_view(spark, root, "customer_features", 1)
    return view.select(
        "customer_id", "ts", F.round("log_prior_spend", 6).alias("log_prior_spend"), "days_since_first_order", "priority_ordinal"
    )


@query(
    "table_profile",
    f"""WITH {EVENTS_SQL} """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column, COUNT(*) FILTER ({c} IS NULL) AS nulls, MIN({c}) = MAX({c}) AS constant,
                   COUNT(*) AS rows, COUNT(DISTINCT customer_id) AS keys FROM order_events"""
        for c in ("customer_id", "order_id", "ts", "order_priority", "order_value", "ship_priority", "is_fulfilled")
    ),
)
def table_profile(spark, sf_dir):
    return features.table_profile(retail.customer_order_events(spark, sf_dir), "customer_id")


# --- series -----------------------------------------------------------------------------

SERIES_SQL = """
daily AS (SELECT CAST(o_orderdate AS DATE) AS ts, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(MIN(ts), MAX(ts), INTERVAL 1 DAY)) AS DATE) AS ts FROM daily),
series AS (SELECT ts, COALESCE(y, 0) AS y, CAST(date_diff('day', DATE '1970-01-01', ts) AS DOUBLE) AS t FROM days LEFT JOIN daily USING (ts)),
trend AS (SELECT regr_slope(y, t) AS b, regr_intercept(y, t) AS a, MAX(ts) AS last_day FROM series),
residuals AS (SELECT ts, y, dayofweek(ts) AS wd, y - (a + b * t) AS r FROM series, trend),
effects AS (SELECT wd, AVG(r) AS e FROM residuals GROUP BY wd),
rest AS (SELECT ts, y, r - e AS z FROM residuals JOIN effects USING (wd)),
spread AS (SELECT STDDEV_SAMP(z) AS s FROM rest)"""


def revenue_series(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return forecast.daily_series(orders, "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)"))


@query("daily_revenue", f"WITH {SERIES_SQL} SELECT CAST(ts AS TIMESTAMP) AS ts, y AS revenue FROM daily")
def daily_revenue(spark, sf_dir):
    """The series as a stored view."""
    series = revenue_series(spark, sf_dir).select(F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("y").alias("revenue"))
    series.createOrReplaceTempView("daily_revenue")
    return spark.table("daily_revenue")


@query(
    "series_extent",
    f"""WITH {SERIES_SQL} SELECT MIN(ts) AS first_day, MAX(ts) AS last_day, COUNT(*) AS n_days, ROUND(SUM(y), 2) AS total_revenue FROM daily""",
)
def series_extent(spark, sf_dir):
    return revenue_series(spark, sf_dir).agg(
        F.min("ts").alias("first_day"),
        F.max("ts").alias("last_day"),
        F.count("*").alias("n_days"),
        F.round(F.sum("y"), 2).alias("total_revenue"),
    )


@query("complete_calendar", f"WITH {SERIES_SQL} SELECT ts, y FROM series")
def complete_calendar(spark, sf_dir):
    return forecast.complete_calendar(revenue_series(spark, sf_dir))


@query(
    "forecast_14d",
    f"""WITH {SERIES_SQL}, ahead AS (
      SELECT CAST(last_day + CAST(i AS INTEGER) AS DATE) AS ts, a, b FROM trend, (SELECT unnest(range(1, 15)) AS i)),
    levels AS (SELECT ts, a + b * date_diff('day', DATE '1970-01-01', ts) + e AS f
               FROM ahead JOIN effects ON effects.wd = dayofweek(ahead.ts))
    SELECT ts, ROUND(f, 2) AS forecast, ROUND(f - 1.96 * s, 2) AS lower_bound, ROUND(f + 1.96 * s, 2) AS upper_bound FROM levels, spread""",
)
def forecast_14d(spark, sf_dir):
    ahead = forecast.forecast(revenue_series(spark, sf_dir), 14)
    return ahead.select("ts", *[F.round(c, 2).alias(c) for c in ("forecast", "lower_bound", "upper_bound")])


@query(
    "forecast_by_priority",
    f"""WITH daily AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS ts,
                              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY 1, 2),
    span AS (SELECT priority, MIN(ts) AS f, MAX(ts) AS l FROM daily GROUP BY 1),
    days AS (SELECT priority, CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS ts FROM span),
    series AS (SELECT priority, ts, COALESCE(y, 0) AS y, CAST(date_diff('day', DATE '1970-01-01', ts) AS DOUBLE) AS t
               FROM days LEFT JOIN daily USING (priority, ts)),
    trend AS (SELECT priority, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, MAX(ts) AS last_day FROM series GROUP BY 1),
    residuals AS (SELECT priority, dayofweek(ts) AS wd, y - (a + b * t) AS r FROM series JOIN trend USING (priority)),
    effects AS (SELECT priority, wd, AVG(r) AS e FROM residuals GROUP BY 1, 2),
    ahead AS (SELECT priority, CAST(last_day + CAST(i AS INTEGER) AS DATE) AS ts, a, b FROM trend, (SELECT unnest(range(1, 8)) AS i))
    SELECT ahead.priority, ts, ROUND(a + b * date_diff('day', DATE '1970-01-01', ts) + e, 2) AS forecast
    FROM ahead JOIN effects ON effects.priority = ahead.priority AND effects.wd = dayofweek(ahead.ts)""",
)
def forecast_by_priority(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "priority")
    series = forecast.daily_series(orders, "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)"), ["priority"])
    ahead = forecast.forecast(series, 7, ["priority"])
    return ahead.select("priority", "ts", F.round("forecast", 2).alias("forecast"))


@query(
    "series_anomalies",
    f"""WITH {SERIES_SQL}
    SELECT ts, ROUND(y, 2) AS y, ROUND(y - z, 2) AS expected, ROUND(z / s, 6) AS deviations FROM rest, spread WHERE ABS(z) > 3 * s""",
)
def series_anomalies(spark, sf_dir):
    found = forecast.anomalies(revenue_series(spark, sf_dir))
    return found.select(
        "ts", F.round("y", 2).alias("y"), F.round("expected", 2).alias("expected"), F.round("deviations", 6).alias("deviations")
    )


# --- drift ------------------------------------------------------------------------------

SPLIT_DAY = "1999-01-01"


def reference_and_live(df):
    is_live = F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return df.where(~is_live), df.where(is_live)


def psi_sql(column):
    edges = ", ".join(f"quantile_disc({column}, {i / 10})" for i in range(1, 10))
    return f"""(
      WITH edges AS (SELECT list_distinct([{edges}]) AS e FROM observed WHERE NOT live),
      binned AS (SELECT live, len(list_filter(e, lambda x: x < {column})) AS bin FROM observed, edges),
      shares AS (SELECT bin, GREATEST(COUNT(*) FILTER (NOT live) / (SELECT COUNT(*) FROM observed WHERE NOT live), 1e-6) AS p,
                        GREATEST(COUNT(*) FILTER (live) / (SELECT COUNT(*) FROM observed WHERE live), 1e-6) AS q FROM binned GROUP BY bin)
      SELECT '{column}' AS feature, ROUND(SUM((q - p) * LN(q / p)), 6) AS psi, SUM((q - p) * LN(q / p)) > 0.2 AS alert FROM shares)"""


DRIFT_FEATURES = ["order_value", "days_since_first_order", "priority_rank"]
OBSERVED_SQL = f"""{FEATURES_SQL},
observed AS (SELECT ts >= TIMESTAMP '{SPLIT_DAY}' AS live, CAST(order_value AS DOUBLE) AS order_value, days_since_first_order,
                    CAST(LEFT(order_priority, 1) AS INTEGER) AS priority_rank FROM prior)"""


def observed_features(spark, sf_dir):
    prior = features.prior_order_features(retail.customer_order_events(spark, sf_dir))
    rank = F.left("order_priority", F.lit(1)).cast("int")
    return materialize(
        prior.select("ts", F.col("order_value").cast("double").alias("order_value"), "days_since_first_order", rank.alias("priority_rank")),
        "observed-features",
    )


@query("feature_psi", f"WITH {OBSERVED_SQL} " + " UNION ALL ".join(f"SELECT * FROM {psi_sql(c)}" for c in DRIFT_FEATURES))
def feature_psi(spark, sf_dir):
    reference, live = reference_and_live(observed_features(spark, sf_dir))
    return drift.population_stability(reference, live, DRIFT_FEATURES).withColumn("psi", F.round("psi", 6))


@query(
    "feature_ks",
    f"""WITH {OBSERVED_SQL} """
    + " UNION ALL ".join(
        f"""SELECT * FROM (
          WITH v AS (SELECT {c} AS x, COUNT(*) FILTER (NOT live) AS r, COUNT(*) FILTER (live) AS l FROM observed GROUP BY 1),
          c AS (SELECT SUM(r) OVER (ORDER BY x) / (SELECT SUM(r) FROM v) AS fr, SUM(l) OVER (ORDER BY x) / (SELECT SUM(l) FROM v) AS fl FROM v)
          SELECT '{c}' AS feature, ROUND(MAX(ABS(fr - fl)), 9) AS ks FROM c)"""
        for c in DRIFT_FEATURES
    ),
)
def feature_ks(spark, sf_dir):
    reference, live = reference_and_live(observed_features(spark, sf_dir))
    return drift.kolmogorov_smirnov(reference, live, DRIFT_FEATURES).withColumn("ks", F.round("ks", 9))


SCORED_SQL = f"""{EVENTS_SQL},
scored AS (SELECT *, ts >= TIMESTAMP '{SPLIT_DAY}' AS live,
                  (CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000) / 1000 AS score FROM order_events)"""


def hash_scored(spark, sf_dir):
    """A repeatable stand-in for model scores, so that the reports have one right answer."""
    events = retail.customer_order_events(spark, sf_dir)
    return events.withColumn("score", hash_bucket("order_id", buckets=1000) / 1000.0)


@query(
    "prediction_drift",
    f"""WITH {SCORED_SQL}, binned AS (
      SELECT live, score, len(list_filter([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[], lambda e: e < score)) AS bin FROM scored),
    n AS (SELECT COUNT(*) FILTER (live) AS l, COUNT(*) FILTER (NOT live) AS r,
                 AVG(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) FILTER (live) - AVG(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) FILTER (NOT live) AS change FROM scored)
    SELECT CAST(bin AS INTEGER) AS bin, ROUND(COUNT(*) FILTER (NOT live) / ANY_VALUE(r), 9) AS reference_share, ROUND(COUNT(*) FILTER (live) / ANY_VALUE(l), 9) AS live_share,
           ROUND(COUNT(*) FILTER (live) / ANY_VALUE(l) - COUNT(*) FILTER (NOT live) / ANY_VALUE(r), 9) AS difference,
           ROUND(ANY_VALUE(change), 9) AS positive_rate_change FROM binned, n GROUP BY bin""",
)
def prediction_drift(spark, sf_dir):
    reference, live = reference_and_live(hash_scored(spark, sf_dir))
    report = drift.prediction_drift(reference, live, "score")
    return report.withColumns(
        {c: F.round(c, 9) for c in ("reference_share", "live_share", "difference", "positive_rate_change")}
    )


@query(
    "trailing_f1",
    f"""WITH {SCORED_SQL}, daily AS (
      SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (is_fulfilled = 1 AND score >= 0.5) AS tp,
             COUNT(*) FILTER (is_fulfilled = 0 AND score >= 0.5) AS fp, COUNT(*) FILTER (is_fulfilled = 1 AND score < 0.5) AS fn
      FROM scored GROUP BY 1),
    t AS (SELECT day, SUM(tp) OVER w AS tp, SUM(fp) OVER w AS fp, SUM(fn) OVER w AS fn FROM daily
          WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))
    SELECT day, ROUND(2 * tp / NULLIF(2 * tp + fp + fn, 0), 9) AS f1, 2 * tp / NULLIF(2 * tp + fp + fn, 0) < 0.45 - 0.05 AS alert FROM t""",
)
def trailing_f1(spark, sf_dir):
    scored = hash_scored(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    report = drift.trailing_f1(scored, "ts", LABEL, "prediction", 0.45)
    return report.withColumn("f1", F.round("f1", 9))


# --- models -----------------------------------------------------------------------------
# What a forest predicts has no SQL; what surrounds it has: rows, parameters, versions, the quality
# measures and the promotion rule on repeatable scores. Of the forest itself a claim is checked.

MARGIN = 0.05

TEST_SQL = f"""{EVENTS_SQL},
test AS (
  SELECT *, (CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000) / 1000 AS score,
         CASE WHEN CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|' || CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 >= 400 THEN 1 ELSE 0 END AS other
  FROM order_events WHERE CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80)"""


def split_rows(spark, sf_dir):
    return hash_split(training_rows(spark, sf_dir), ["order_id"], 80)


def claim(scored, name):
    """Number of rows, and whether the accuracy is at least the share of the commoner class, less a margin."""
    positive = F.avg((F.col(LABEL) == 1).cast("double"))
    accuracy = F.avg((F.col(LABEL) == F.col("predicted")).cast("double"))
    return scored.agg(F.count("*").alias("rows"), (accuracy >= F.greatest(positive, 1 - positive) - MARGIN).alias(name))


@query("rf_accuracy", f"WITH {TEST_SQL} SELECT COUNT(*) AS rows, TRUE AS holds_majority FROM test")
def rf_accuracy(spark, sf_dir):
    train, test = split_rows(spark, sf_dir)
    model = models.forest(features.FEATURES, LABEL).fit(train)
    return claim(model.transform(test), "holds_majority")


@query("rf_same_row_accuracy", f"WITH {TEST_SQL} SELECT COUNT(*) AS rows, TRUE AS holds_majority FROM test")
def rf_same_row_accuracy(spark, sf_dir):
    """The contrast: a forest on columns of the labelled order itself, scaled and one-hot encoded."""
    events = retail.customer_order_events(spark, sf_dir).withColumn("order_value", F.col("order_value").cast("double"))
    scaled = features.standard_scale(events, {"order_value": "value_scaled", "ship_priority": "ship_scaled"})
    rows = materialize(scaled, "scaled-orders")
    train, test = hash_split(rows, ["order_id"], 80)
    encoder = features.fit_one_hot(train, "order_priority", "priority_flags")
    model = models.forest(["value_scaled", "ship_scaled", "priority_flags"], LABEL).fit(encoder.transform(train))
    return claim(model.transform(encoder.transform(test)), "holds_majority")


@query(
    "grid_search",
    """SELECT unnest([10, 20, 40])::INTEGER AS "numTrees", depth AS "maxDepth", leaf AS "minInstancesPerNode", TRUE AS scored
       FROM (SELECT unnest([4, 6, 8])::INTEGER AS depth, leaf FROM (SELECT unnest([1, 4])::INTEGER AS leaf))""",
)
def grid_search(spark, sf_dir):
    """All combinations, each with an F1 that can be one, best first."""
    train, _ = split_rows(spark, sf_dir)
    scores = models.grid_search(train, features.FEATURES, LABEL, ["order_id"])[1]
    return scores.select(*models.GRID, F.col("f1").between(0.0, 1.0).alias("scored"))


@query(
    "model_quality",
    f"""WITH {TEST_SQL}, ranked AS (
      SELECT *, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2 AS place FROM test),
    n AS (SELECT COUNT(*) AS rows, COUNT(*) FILTER (is_fulfilled = 1) AS n1, COUNT(*) FILTER (is_fulfilled = 0) AS n0,
                 COUNT(*) FILTER (is_fulfilled = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (is_fulfilled = 0 AND score >= 0.5) AS fp,
                 COUNT(*) FILTER (is_fulfilled = 1 AND score < 0.5) AS fn, SUM(place) FILTER (is_fulfilled = 1) AS places FROM ranked)
    SELECT rows, ROUND((rows - fp - fn) / rows, 9) AS accuracy, ROUND(2 * tp / (2 * tp + fp + fn), 9) AS f1,
           ROUND((places - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc, TRUE AS forest_holds_majority FROM n""",
)
def model_quality(spark, sf_dir):
    """F1, accuracy and AUC of repeatable scores on the held-out rows, and the claim about a tuned forest."""
    train, test = split_rows(spark, sf_dir)
    scored = test.select("order_id", LABEL, (hash_bucket("order_id", buckets=1000) / 1000.0).alias("score"))
    scored = materialize(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), "scores")
    quality = models.accuracy(scored, LABEL).withColumn("accuracy", F.round("accuracy", 9))
    quality = quality.withColumn("f1", F.round(models.f1_of(scored, LABEL).scalar(), 9))
    quality = quality.withColumn("auc", F.round(F.lit(models.auc_evaluator(LABEL, "score").evaluate(scored)), 6))
    forest = models.forest(features.FEATURES, LABEL, trees=10, depth=8, min_leaf=4).fit(train).transform(test)
    return quality.withColumn("forest_holds_majority", claim(forest, "held").select("held").scalar())


@query("batch_scores", f"WITH {EVENTS_SQL} SELECT customer_id, ts, is_fulfilled, TRUE AS scored, 'v1' AS version FROM order_events")
def batch_scores(spark, sf_dir):
    """Two versions are registered; scoring follows the alias, which is set back to the first."""
    root = scratch_path(spark, "models")
    rows = training_rows(spark, sf_dir)
    train, test = hash_split(rows, ["order_id"], 80)
    versions = {"v1": (10, 8), "v2": (20, 6)}
    fitted = models.fit_all([models.forest(features.FEATURES, LABEL, trees=trees, depth=depth) for trees, depth in versions.values()], train)
    for version, model in zip(versions, fitted):
        quality = models.f1_of(model.transform(test), LABEL).first()[0]
        models.log_model(model, root, "fulfilment", version, {"f1": quality})
    models.set_alias(spark, root, "fulfilment", "v2")
    models.set_alias(spark, root, "fulfilment", "v1")
    scored = models.batch_scores(rows, root, "fulfilment", ["customer_id", "ts", LABEL, *features.FEATURES])
    return materialize(scored, "order-scores").select(
        "customer_id", "ts", LABEL, F.col("prediction").isin(0, 1).alias("scored"), F.lit(models.resolve(spark, root, "fulfilment")).alias("version")
    )


@query(
    "forest_as_sql",
    f"""WITH {TEST_SQL} SELECT is_fulfilled, COUNT(*) AS rows, COUNT(*) AS same FROM test GROUP BY is_fulfilled""",
)
def forest_as_sql(spark, sf_dir):
    """Held-out rows scored by the model and by the SQL text of its stored nodes, compared row by row."""
    root = scratch_path(spark, "models")
    train, test = split_rows(spark, sf_dir)
    models.log_model(models.forest(features.FEATURES, LABEL, trees=10, depth=6).fit(train), root, "fulfilment", "v1")
    models.set_alias(spark, root, "fulfilment", "v1")
    by_model = models.batch_scores(test, root, "fulfilment", [LABEL, *features.FEATURES]).withColumnRenamed("prediction", "by_model")
    both = batch_scores_by_sql(by_model, root, "fulfilment", [LABEL, "by_model"])
    same = F.count_if(F.col("by_model") == F.col("prediction"))
    return both.groupBy(LABEL).agg(F.count("*").alias("rows"), same.alias("same"))


@query(
    "champion_challenger",
    f"""WITH {TEST_SQL}, n AS (
      SELECT COUNT(*) AS rows, COUNT(*) FILTER (is_fulfilled = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER ((is_fulfilled = 1) <> (score >= 0.5)) AS wrong,
             COUNT(*) FILTER (is_fulfilled = 1 AND other = 1) AS other_tp, COUNT(*) FILTER (is_fulfilled <> other) AS other_wrong FROM test)
    SELECT rows, ROUND(2 * tp / (2 * tp + wrong), 9) AS champion_f1, ROUND(2 * other_tp / (2 * other_tp + other_wrong), 9) AS challenger_f1,
           2 * other_tp / (2 * other_tp + other_wrong) >= 2 * tp / (2 * tp + wrong) AS promote, rows AS forest_rows FROM n""",
)
def champion_challenger(spark, sf_dir):
    """The rule on two repeatable predictions, and two forests through the same comparison."""
    train, test = split_rows(spark, sf_dir)
    learners = [models.forest(features.FEATURES, LABEL, trees=10, depth=8, min_leaf=4), models.forest(features.FEATURES, LABEL)]
    champion, challenger = models.fit_all(learners, train)
    forests = models.champion_challenger(test, champion, challenger, LABEL)
    fixed = test.select(
        LABEL,
        (hash_bucket("order_id", buckets=1000) / 1000.0 >= 0.5).cast("int").alias("champion"),
        (hash_bucket("customer_id", "order_id", buckets=1000) >= 400).cast("int").alias("challenger"),
    )
    scores = models.compare_predictions(fixed, LABEL, "champion", "challenger")
    rounded = scores.withColumns({c: F.round(c, 9) for c in ("champion_f1", "challenger_f1")})
    return rounded.withColumn("forest_rows", forests.select("rows").scalar())
