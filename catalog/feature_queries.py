"""Features, label, split, exploratory statistics and evaluation curves."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from basketry import testbed as tb
from basketry.operators import curves, stats
from basketry.plans import features, serving, warehouse
from basketry.session import settle
from basketry.vocabulary import EDA_FEATURES, FEATURE_COLUMNS
from catalog.common import (
    EV_DAY, EV_NOW, EVENTS_CTE, ORD_DAY, ORD_NOW, ORDERS_CTE, Catalog, cents, exact_ratio, time_text,
)
from catalog.warehouse_queries import GAP_CTE, SCORES_CTE, fresh_folder

CATALOG = Catalog()
add = CATALOG.add

DAY_US = 86400000000
RFM_CTE = f"""
r0 AS (
  SELECT customer_id, count(order_id) AS frequency, sum(total_amount) AS spend, max(event_timestamp) AS l,
         min(event_timestamp) AS f, max(total_amount)::DOUBLE AS max_purchase_value,
         min(total_amount)::DOUBLE AS min_purchase_value
  FROM fo WHERE total_amount > 0 GROUP BY 1),
rfm AS (
  SELECT *, spend::DOUBLE AS monetary,
         {exact_ratio(cents('spend'), 'frequency', 4, in_cents=True)} AS avg_purchase_value,
         ((epoch_us(TIMESTAMP '{ORD_NOW}') - epoch_us(l)) // {DAY_US})::BIGINT AS recency_days,
         ((epoch_us(l) - epoch_us(f)) // {DAY_US})::BIGINT AS customer_lifespan_days,
         round_even(CASE WHEN l > f THEN frequency / (((epoch_us(l) - epoch_us(f)) // {DAY_US}) / 30)
                         ELSE frequency END, 4) AS monthly_orders FROM r0)"""

BEHAVIOR_CTE = f"""
b0 AS (
  SELECT customer_id, count(*) FILTER (event_type = 'PRODUCT_VIEW') AS product_view_count,
         count(*) FILTER (event_type = 'SEARCH') AS search_count,
         count(*) FILTER (event_type = 'ADD_TO_CART') AS cart_add_count,
         count(*) FILTER (event_type = 'PURCHASE') AS purchase_count,
         count(*) FILTER (event_type = 'LOGIN') AS login_count,
         max(event_timestamp) FILTER (event_type = 'LOGIN') AS last_login
  FROM ev GROUP BY 1),
beh AS (
  SELECT *, round_even(CASE WHEN cart_add_count = 0 THEN 0.0 ELSE greatest(0.0, least(1.0,
           (cart_add_count - purchase_count) / cart_add_count)) END, 4) AS cart_abandonment_rate,
         coalesce((epoch_us(TIMESTAMP '{EV_NOW}') - epoch_us(last_login)) // {DAY_US}, 9999)::BIGINT
           AS days_since_last_login FROM b0)"""


@add("rfm_features", f"""WITH {ORDERS_CTE}, {RFM_CTE}
SELECT * EXCLUDE (spend, l, f), {time_text('l')} AS last_purchase_date, {time_text('f')} AS first_purchase_date
FROM rfm""")
def _(spark, sf_dir):
    return features.rfm_features(tb.fact_orders(spark, sf_dir), ORD_NOW)


@add("rfm_snapshot", f"""WITH {ORDERS_CTE}, {RFM_CTE}
SELECT customer_id, '{ORD_DAY}' AS snapshot_date, 'rfm' AS feature_set, recency_days, frequency, monetary,
       avg_purchase_value, max_purchase_value, min_purchase_value FROM rfm""")
def _(spark, sf_dir):
    return features.rfm_snapshot(tb.fact_orders(spark, sf_dir), ORD_NOW)


@add("behavioral_features", f"""WITH {EVENTS_CTE}, {BEHAVIOR_CTE}
SELECT * EXCLUDE (last_login), {time_text('last_login')} AS last_login_date FROM beh""")
def _(spark, sf_dir):
    return features.behavioral_features(tb.events(spark, sf_dir), EV_NOW)


@add("behavioral_pivot", f"""WITH {EVENTS_CTE}, c AS (
  SELECT customer_id, {", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in features.PIVOTED_TYPES)}
  FROM ev GROUP BY 1)
SELECT *, greatest(0.0, least(1.0, (ADD_TO_CART - PURCHASE) / greatest(ADD_TO_CART, 1))) AS cart_abandonment_rate,
       '{EV_DAY}' AS snapshot_date, 'behavioral' AS feature_set FROM c""")
def _(spark, sf_dir):
    return features.behavioral_pivot(tb.events(spark, sf_dir), EV_NOW)


SESSION_CTE = f"""{GAP_CTE},
gs AS (
  SELECT customer_id, sid, epoch(date_trunc('second', max(event_timestamp)))
                          - epoch(date_trunc('second', min(event_timestamp))) AS seconds
  FROM gapped GROUP BY 1, 2),
sess AS (SELECT customer_id, sum(seconds)::BIGINT / count(*) AS avg_session_duration FROM gs GROUP BY 1)"""


@add("session_features", f"WITH {EVENTS_CTE}, {SESSION_CTE} SELECT * FROM sess")
def _(spark, sf_dir):
    return features.session_features(warehouse.gap_sessions(tb.events(spark, sf_dir)))


NEVER = {"recency_days": 9999, "days_since_last_login": 9999}
ALL_CTE = f"""{EVENTS_CTE}, {BEHAVIOR_CTE}, {SESSION_CTE}, {ORDERS_CTE}, {RFM_CTE},
comb AS (
  SELECT customer_id, {", ".join(f"coalesce({c}, {NEVER.get(c, 0)}) AS {c}" for c in FEATURE_COLUMNS)},
         coalesce(customer_lifespan_days, 0) AS customer_lifespan_days, l, f, last_login
  FROM rfm FULL JOIN beh USING (customer_id) FULL JOIN sess USING (customer_id)),
lab AS (SELECT *, (recency_days > 90)::BIGINT AS is_churned FROM comb)"""


@add("combined_features", f"""WITH {ALL_CTE}
SELECT * EXCLUDE (l, f, last_login), {time_text('l')} AS last_purchase_date, {time_text('f')} AS first_purchase_date,
       {time_text('last_login')} AS last_login_date, '{EV_DAY}' AS snapshot_date, 'combined_v2' AS feature_set
FROM comb""")
def _(spark, sf_dir):
    return tb.combined_features(spark, sf_dir)


def stored_features(spark, sf_dir):
    """The feature store as it lies on disk: one folder per snapshot and set."""
    folder = fresh_folder(spark)
    tb.feature_store(spark, sf_dir).write.partitionBy("snapshot_date", "feature_set").parquet(folder)
    return spark.read.parquet(folder)


@add("latest_features", f"WITH {ALL_CTE} SELECT customer_id, {', '.join(FEATURE_COLUMNS)} FROM comb")
def _(spark, sf_dir):
    return features.latest_features(stored_features(spark, sf_dir), FEATURE_COLUMNS)


@add("features_over_all_snapshots", f"""WITH {ALL_CTE}
SELECT customer_id, recency_days + 7 AS recency_days, frequency, product_view_count FROM comb""")
def _(spark, sf_dir):
    return features.latest_features(
        stored_features(spark, sf_dir), ["recency_days", "frequency", "product_view_count"], latest_only=False
    )


@add("feature_snapshots", f"""WITH {ALL_CTE}
SELECT '{EV_DAY}' AS snapshot_date, count(*) AS customer_count FROM comb
UNION ALL SELECT '2024-01-24', count(*) FROM comb""")
def _(spark, sf_dir):
    return serving.feature_snapshots(stored_features(spark, sf_dir))


@add("feature_snapshots_of_many", f"""WITH {ALL_CTE}
SELECT strftime(DATE '{EV_DAY}' - k * INTERVAL 7 DAY, '%Y-%m-%d') AS snapshot_date, count(*) AS customer_count
FROM comb, (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS k) WHERE k < 5 GROUP BY 1""")
def _(spark, sf_dir):
    """Eight weekly snapshots, of which five are shown."""
    weeks = tb.combined_features(spark, sf_dir).withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(7))))
    store = weeks.withColumn("snapshot_date", F.expr("date_sub(snapshot_date, 7 * week)"))
    return serving.feature_snapshots(store)


@add("label_churn", f"WITH {ALL_CTE} SELECT customer_id, recency_days, is_churned FROM lab")
def _(spark, sf_dir):
    return features.label_churn(tb.combined_features(spark, sf_dir)).select(
        "customer_id", "recency_days", "is_churned"
    )


@add("stratified_split", f"""WITH {SCORES_CTE}, t AS (
  SELECT customer_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(customer_id || ':42'), customer_id)
         AS rn, count(*) OVER (PARTITION BY label) AS n FROM sc)
SELECT customer_id, label, rn <= round(n * 0.2) AS is_test FROM t""")
def _(spark, sf_dir):
    rows = tb.churn_scores(spark, sf_dir).select("customer_id", "label")
    return features.stratified_split(rows, "label")


@add("stratified_folds", f"""WITH {SCORES_CTE}
SELECT customer_id, label, (row_number() OVER (PARTITION BY label ORDER BY md5(customer_id || ':42'), customer_id)
       - 1) % 5 AS fold FROM sc""")
def _(spark, sf_dir):
    return features.stratified_folds(tb.churn_scores(spark, sf_dir).select("customer_id", "label"), 5, "label")


@add("training_gate", "SELECT count(*) >= 100 AS enough FROM customer")
def _(spark, sf_dir):
    enough = features.training_gate(tb.churn_scores(spark, sf_dir))
    return tb.churn_scores(spark, sf_dir).agg(F.lit(enough).alias("enough"))


@add("extended_features", f"""WITH {EVENTS_CTE}, m AS (
  SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS r
  FROM ev WHERE category IS NOT NULL GROUP BY 1, 2),
d AS (
  SELECT customer_id, device, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, device) AS r
  FROM ev GROUP BY 1, 2),
c AS (
  SELECT customer_id, count(DISTINCT session_id) AS session_count,
         max(event_timestamp) FILTER (event_type = 'PURCHASE') AS lp,
         count(*) FILTER (event_type = 'SEARCH') AS s, count(*) FILTER (event_type = 'PRODUCT_VIEW') AS v,
         count(*) FILTER (event_type = 'REFUND') AS rf, count(*) FILTER (event_type = 'PURCHASE') AS p
  FROM ev GROUP BY 1)
SELECT c.customer_id, session_count, m.category AS preferred_category, d.device AS preferred_device,
       coalesce((epoch_us(TIMESTAMP '{EV_NOW}') - epoch_us(lp)) // {DAY_US}, 9999)::BIGINT
         AS days_since_last_purchase, s / nullif(v, 0) AS search_to_view_ratio, rf / nullif(p, 0) AS refund_rate
FROM c LEFT JOIN (SELECT * FROM m WHERE r = 1) m USING (customer_id)
LEFT JOIN (SELECT * FROM d WHERE r = 1) d USING (customer_id)""")
def _(spark, sf_dir):
    return features.extended_features(tb.events(spark, sf_dir), EV_NOW)


# --- exploratory statistics -----------------------------------------------------------------------------------


def labelled(spark, sf_dir):
    """Features are a stored table: several passes read them, none computes them again."""
    return settle(features.label_churn(tb.combined_features(spark, sf_dir)))


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean,
       round(stddev_samp({c}::DOUBLE), 4) AS std, round(min({c}::DOUBLE), 4) AS min,
       round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
       round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, round(max({c}::DOUBLE), 4) AS max FROM lab"""


@add("describe", f"WITH {ALL_CTE} " + " UNION ALL ".join(_describe_sql(c) for c in EDA_FEATURES))
def _(spark, sf_dir):
    return stats.describe(labelled(spark, sf_dir), EDA_FEATURES, 4)


CORRELATED = EDA_FEATURES + ["is_churned"]


@add("correlation_matrix", f"WITH {ALL_CTE} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_x, '{b}' AS column_y, round(corr({a}::DOUBLE, {b}::DOUBLE), 4) AS correlation FROM lab"
    for a, b in product(CORRELATED, CORRELATED)))
def _(spark, sf_dir):
    return stats.correlation_matrix(labelled(spark, sf_dir), CORRELATED)


HISTOGRAMS = ["monetary", "recency_days", "product_view_count"]


@add("clipped_histogram", f"WITH {ALL_CTE}, long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, is_churned AS label, {c}::DOUBLE AS value FROM lab" for c in HISTOGRAMS) + """),
clip AS (SELECT feature, quantile_cont(value, 0.99) AS top FROM long GROUP BY 1),
cut AS (SELECT feature, label, least(value, top) AS value FROM long JOIN clip USING (feature)),
edge0 AS (SELECT feature, label, min(value) AS a, max(value) AS b, count(*) AS total FROM cut GROUP BY 1, 2),
edge AS (
  SELECT feature, label, total, CASE WHEN a = b THEN a - 0.5 ELSE a END AS low,
         CASE WHEN a = b THEN b + 0.5 ELSE b END AS high FROM edge0)
SELECT feature, label, least(floor((value - low) / ((high - low) / 40)), 39)::BIGINT AS bin, count(*) AS n,
       round(any_value(low) + least(floor((value - low) / ((high - low) / 40)), 39)
             * any_value((high - low) / 40), 6) AS bin_start,
       round(count(*) / any_value(total * ((high - low) / 40)), 6) AS density
FROM cut JOIN edge USING (feature, label) GROUP BY 1, 2, least(floor((value - low) / ((high - low) / 40)), 39)""")
def _(spark, sf_dir):
    return stats.clipped_histogram(labelled(spark, sf_dir), HISTOGRAMS, "is_churned")


def _score_sql(column: str) -> str:
    return f"""greatest(1, ceil(5 * (row_number() OVER (ORDER BY {column}, customer_id) - 1)
                           / (count(*) OVER () - 1)))::BIGINT"""


RFM_SCORE_CTE = f"""{ALL_CTE},
q AS (
  SELECT customer_id, monetary, recency_days, is_churned, 6 - {_score_sql('recency_days')} AS r_score,
         {_score_sql('frequency')} AS f_score, {_score_sql('monetary')} AS m_score FROM lab),
seg AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
         CASE WHEN r_score + f_score + m_score <= 6 THEN 'Bronze' WHEN r_score + f_score + m_score <= 9 THEN 'Silver'
              WHEN r_score + f_score + m_score <= 12 THEN 'Gold' ELSE 'Platinum' END AS rfm_segment FROM q)"""


@add("rfm_quintiles", f"""WITH {RFM_SCORE_CTE}
SELECT customer_id, r_score, f_score, m_score, rfm_score, rfm_segment FROM seg""")
def _(spark, sf_dir):
    return stats.rfm_quintiles(labelled(spark, sf_dir)).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment"
    )


@add("segment_summary", f"""WITH {RFM_SCORE_CTE}
SELECT rfm_segment, count(*) AS count, round_even(avg(is_churned), 2) AS churn_rate,
       round_even(avg(monetary), 2) AS avg_spend, round_even(avg(recency_days), 2) AS avg_recency
FROM seg GROUP BY 1""")
def _(spark, sf_dir):
    return stats.segment_summary(
        stats.rfm_quintiles(labelled(spark, sf_dir)).withColumn("monetary", F.col("monetary").cast("double"))
    )


# --- evaluation -----------------------------------------------------------------------------------------------


def judged(spark, sf_dir):
    return tb.churn_scores(spark, sf_dir).select("label", F.col("churn_probability").alias("score"))


CURVE_CTE = f"""{SCORES_CTE}, g AS (
  SELECT m, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM sc GROUP BY 1),
c AS (
  SELECT m / 1000.0 AS threshold, pos, neg, sum(pos) OVER (ORDER BY m DESC)::BIGINT AS tp,
         sum(neg) OVER (ORDER BY m DESC)::BIGINT AS fp, sum(pos) OVER ()::BIGINT AS p, sum(neg) OVER ()::BIGINT AS n
  FROM g)"""


FINE_CTE = """
sc AS (
  SELECT (c_custkey * 7919 % 1000 - 300) + (c_custkey % 17) * 0.00000003125::DOUBLE AS s,
         CASE WHEN c_custkey * 104729 % 1000 < c_custkey * 7919 % 1000 THEN 1 ELSE 0 END AS label FROM customer),
g AS (SELECT s, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM sc GROUP BY 1),
c AS (
  SELECT s AS threshold, pos, neg, sum(pos) OVER (ORDER BY s DESC)::BIGINT AS tp,
         sum(neg) OVER (ORDER BY s DESC)::BIGINT AS fp, sum(pos) OVER ()::BIGINT AS p, sum(neg) OVER ()::BIGINT AS n FROM g)"""


def fine(spark, sf_dir):
    """Scores far outside 0 to 1 that differ in the eighth decimal only."""
    key = F.col("c_custkey")
    return tb.table(spark, sf_dir, "customer").select(
        ((key * 7919 % 1000 - 300) + (key % 17) * F.lit(0.00000003125)).alias("score"),
        F.when(key * 104729 % 1000 < key * 7919 % 1000, 1).otherwise(0).alias("label"))


@add("roc_curve_any_score", f"""WITH {FINE_CTE}
SELECT threshold, fp / n AS fpr, tp / p AS tpr FROM c UNION ALL SELECT NULL, 0, 0""")
def _(spark, sf_dir):
    return curves.roc_curve(fine(spark, sf_dir))


@add("pr_curve_any_score", f"""WITH {FINE_CTE}
SELECT threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM c UNION ALL SELECT NULL, 1, 0""")
def _(spark, sf_dir):
    return curves.pr_curve(fine(spark, sf_dir))


@add("areas_any_score", f"""WITH {FINE_CTE}
SELECT max(p) AS positives, max(n) AS negatives,
       round(sum(neg::DOUBLE * (tp - pos / 2)) / (max(p)::DOUBLE * max(n)), 6) AS auc_roc,
       round(sum(pos * tp / (tp + fp)) / max(p), 6) AS avg_precision FROM c""")
def _(spark, sf_dir):
    return curves.areas(fine(spark, sf_dir))


@add("roc_curve", f"""WITH {CURVE_CTE}
SELECT threshold::DOUBLE AS threshold, fp / n AS fpr, tp / p AS tpr FROM c UNION ALL SELECT NULL, 0, 0""")
def _(spark, sf_dir):
    return curves.roc_curve(judged(spark, sf_dir))


@add("pr_curve", f"""WITH {CURVE_CTE}
SELECT threshold::DOUBLE AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM c
UNION ALL SELECT NULL, 1, 0""")
def _(spark, sf_dir):
    return curves.pr_curve(judged(spark, sf_dir))


@add("auc_and_average_precision", f"""WITH {CURVE_CTE}
SELECT max(p) AS positives, max(n) AS negatives,
       round(sum(neg::DOUBLE * (tp - pos / 2)) / (max(p)::DOUBLE * max(n)), 6) AS auc_roc,
       round(sum(pos * tp / (tp + fp)) / max(p), 6) AS avg_precision FROM c""")
def _(spark, sf_dir):
    return curves.areas(judged(spark, sf_dir))


@add("classification_report", f"""WITH {SCORES_CTE}, k AS (
  SELECT count(*) FILTER (label = 0 AND m < 500)::DOUBLE AS tn, count(*) FILTER (label = 0 AND m >= 500)::DOUBLE AS fp,
         count(*) FILTER (label = 1 AND m < 500)::DOUBLE AS fn, count(*) FILTER (label = 1 AND m >= 500)::DOUBLE AS tp
  FROM sc),
x AS (
  SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0, tn + fp AS s0,
         tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1 FROM k)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0::BIGINT AS support FROM x
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1::BIGINT FROM x
UNION ALL SELECT 'accuracy', round((tn + tp) / (s0 + s1), 6), round((tn + tp) / (s0 + s1), 6),
                 round((tn + tp) / (s0 + s1), 6), (s0 + s1)::BIGINT FROM x
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), (s0 + s1)::BIGINT FROM x
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f0 * s0 + f1 * s1) / (s0 + s1), 6), (s0 + s1)::BIGINT FROM x""")
def _(spark, sf_dir):
    return curves.classification_report(judged(spark, sf_dir))
