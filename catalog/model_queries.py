"""Churn model and vector search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry import testbed as tb
from basketry.operators import ivf, vectors
from basketry.plans import churn, features
from basketry.session import settle
from basketry.vocabulary import FEATURE_COLUMNS, WEEKLY_FEATURES
from catalog.common import EV_NOW, Catalog
from catalog.feature_queries import ALL_CTE
from catalog.warehouse_queries import fresh_folder

CATALOG = Catalog()
add = CATALOG.add

def training_rows(spark, sf_dir):
    return settle(features.label_churn(tb.combined_features(spark, sf_dir)))


_trained: dict[tuple, tuple] = {}


def trained(spark, sf_dir, params=churn.ChurnParams(), wanted=FEATURE_COLUMNS):
    """The model with its real settings, learnt once per session and data for all queries that use it."""
    key = (spark.sparkContext.applicationId, sf_dir, params, tuple(wanted))
    if key not in _trained:
        rows = training_rows(spark, sf_dir)
        names = churn.model_features(rows.columns, wanted)
        model, metrics = churn.train_churn(rows, names, params)
        _trained[key] = (model, settle(metrics), rows, names)
    return _trained[key]


@add("train_churn")
def _(spark, sf_dir):
    _, metrics, _, _ = trained(spark, sf_dir)
    return metrics


@add("feature_importance")
def _(spark, sf_dir):
    model, _, _, names = trained(spark, sf_dir)
    return churn.feature_importance(model, names)


@add("score_customers")
def _(spark, sf_dir):
    model, metrics, rows, names = trained(spark, sf_dir)
    folder = fresh_folder(spark)
    churn.save_model(model, metrics, folder)
    return churn.score_customers(churn.load_model(folder), rows, names, EV_NOW)


def _facts(metrics):
    """What the data determine, whatever trees come out."""
    return metrics.select(
        "training_samples", "test_samples", F.size(F.from_json("features", "array<string>")).alias("features"),
        F.get_json_object("params", "$.trees").cast("int").alias("trees"), F.get_json_object("params", "$.depth").cast("int").alias("depth"),
        (F.col("auc_roc").isNull() | F.col("auc_roc").between(0, 1)).alias("auc_in_range"))


def _facts_sql(n_features: int, trees: int) -> str:
    return f"""WITH {ALL_CTE}, n AS (SELECT is_churned, count(*) AS n FROM lab GROUP BY 1)
SELECT CAST(sum(n) - sum(round(n * 0.2)) AS BIGINT) AS training_samples, CAST(sum(round(n * 0.2)) AS BIGINT) AS test_samples,
       {n_features}::BIGINT AS features, {trees}::BIGINT AS trees, 6::BIGINT AS depth, TRUE AS auc_in_range FROM n"""


@add("train_churn_facts", _facts_sql(len(FEATURE_COLUMNS) - 1, 300))
def _(spark, sf_dir):
    return _facts(trained(spark, sf_dir)[1])


@add("weekly_churn_facts", _facts_sql(len(WEEKLY_FEATURES) - 1, 200))
def _(spark, sf_dir):
    """The weekly retraining: its own settings and features."""
    return _facts(trained(spark, sf_dir, churn.WEEKLY, WEEKLY_FEATURES)[1])


@add("churn_scores_facts", f"""WITH {ALL_CTE}
SELECT customer_id, TRUE AS in_range, TRUE AS band_fits, TRUE AS same_after_reload FROM lab""")
def _(spark, sf_dir):
    """One score per customer, its band by the probability, the same from a stored and loaded model."""
    model, metrics, rows, names = trained(spark, sf_dir)
    folder = fresh_folder(spark)
    churn.save_model(model, metrics, folder)
    scores = churn.score_customers(model, rows, names, EV_NOW)
    again = churn.score_customers(churn.load_model(folder), rows, names, EV_NOW).select(
        "customer_id", F.col("churn_probability").alias("again"))
    p = F.col("churn_probability")
    band = F.when(p <= 0.3, "low_risk").when(p <= 0.6, "medium_risk").otherwise("high_risk")
    return scores.join(again, "customer_id").select(
        "customer_id", p.between(0, 1).alias("in_range"), (F.col("churn_segment") == band).alias("band_fits"),
        (p == F.col("again")).alias("same_after_reload"))


@add("cross_validate")
def _(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    mean, std = churn.cross_validate(rows, churn.model_features(rows.columns))
    return rows.agg(F.lit(mean).alias("cv_auc_mean"), F.lit(std).alias("cv_auc_std"), F.count("*").alias("customers"))


SINGLE = [c for c in FEATURE_COLUMNS if c != churn.LEAKY]


@add("churn_beats_single_features", "SELECT unnest([" + ", ".join(f"'{c}'" for c in SINGLE) + "]) AS feature, TRUE AS beaten")
def _(spark, sf_dir):
    """Over all customers the model ranks better than any one of its features does, in either direction."""
    model, _, rows, names = trained(spark, sf_dir)
    scored = settle(churn.probabilities(model, churn._ready(rows, names)).select(
        F.col("is_churned").cast("double").alias("label"), "score", *[F.col(c).cast("double").alias(c) for c in names]))
    found = churn.areas_by_column(scored, ["score", *names])
    best = found.pop("score")
    found = [(c, max(a, 1 - a) <= best) for c, a in found.items()]
    return spark.createDataFrame(found, "feature string, beaten boolean")


@add("importance_of_a_planted_feature", "SELECT 'planted' AS feature, 1::BIGINT AS place, TRUE AS sums_to_one")
def _(spark, sf_dir):
    """A feature that nearly tells the label takes the first place among the real ones; a short model shows it."""
    noise = F.pmod(F.xxhash64("customer_id"), F.lit(1000)) / 1000 * 1.2
    rows = training_rows(spark, sf_dir).withColumn("planted", F.col("is_churned") + noise)
    names = [*churn.model_features(rows.columns), "planted"]
    model, _ = churn.train_churn(rows, names, churn.ChurnParams(trees=10))
    weights = churn.feature_importance(model, names, top=len(names))
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # one row per feature
    total = F.sum("importance").over(Window.partitionBy())
    return weights.select("feature", place.alias("place"), (F.abs(total - 1) < 1e-9).alias("sums_to_one")).filter("place = 1")


# --- vectors --------------------------------------------------------------------------------------------------


def label_means(spark, sf_dir):
    """One query vector per label: the mean of its vectors over the whole table."""
    items = tb.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = items.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("embedding")
    )


@add("similarity_topk", """WITH x AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
qm AS (SELECT label, pos, avg(x) AS x FROM x GROUP BY 1, 2),
qn AS (SELECT label, sqrt(sum(x * x)) AS n FROM qm GROUP BY 1),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM x GROUP BY 1),
s AS (
  SELECT qm.label AS query_id, x.vec_id, round(sum(qm.x * x.x) / any_value(qn.n * vn.n), 6) AS similarity
  FROM qm JOIN x ON x.pos = qm.pos JOIN qn ON qn.label = qm.label JOIN vn ON vn.vec_id = x.vec_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS place FROM s)
SELECT query_id::BIGINT AS query_id, vec_id, similarity, place FROM r WHERE place <= 3""")
def _(spark, sf_dir):
    stored = tb.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.similarity_topk(label_means(spark, sf_dir), stored, 3)


@add("similarity_blocks", """WITH v AS (
  SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))) AS n FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         round(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: p[1]::DOUBLE * p[2])) / (q.n * v.n), 6) AS similarity
  FROM v AS q, v WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS place FROM s)
SELECT query_id, vec_id, similarity, place FROM r WHERE place <= 5""")
def _(spark, sf_dir):
    """Every hundredth vector asks all vectors; the queries fall into several blocks."""
    stored = tb.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = stored.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return vectors.similarity_topk(asked, stored, 5, query_bytes=1 << 10)


def indexed(spark, sf_dir):
    """The index of all vectors, every hundredth vector as a query, and the vectors."""
    folder = fresh_folder(spark)
    stored = tb.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ivf.build_index(stored, folder)
    return folder, stored.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"), stored


@add("indexed_search")
def _(spark, sf_dir):
    folder, asked, _stored = indexed(spark, sf_dir)
    return ivf.search_index(asked, folder, 10)


@add("indexed_search_recall", """SELECT count(*) AS queries, sum(least(10, n))::BIGINT AS neighbours, TRUE AS recall_at_least_90
FROM embeddings, (SELECT count(*) AS n FROM embeddings) WHERE vec_id % 100 = 0""")
def _(spark, sf_dir):
    """Against the exact search of the same queries."""
    folder, asked, stored = indexed(spark, sf_dir)
    measured = ivf.recall_of(ivf.search_index(asked, folder, 10), vectors.similarity_topk(asked, stored, 10))
    return measured.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_at_least_90"))


@add("indexed_search_all_lists", CATALOG.oracles["similarity_blocks"])
def _(spark, sf_dir):
    """All lists asked, in small cells: the exact neighbours."""
    folder, asked, _stored = indexed(spark, sf_dir)
    lists = spark.read.parquet(f"{folder}/centres").count()
    return ivf.search_index(asked, folder, 5, probes=lists, list_rows=20, query_bytes=1 << 11)


def tickets(spark, sf_dir):
    ticket = F.concat_ws("-", F.lit("TKT"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return tb.table(spark, sf_dir, "conversations").select(
        ticket.alias("ticket_id"), tb.customer_code(F.col("conv_id")).alias("customer_id"),
        F.col("text").alias("issue_text"), F.when(F.col("role") == "user", "Open").otherwise("Resolved").alias("status"),
        F.lit("2024-01-31T00:00:00").alias("created_at"),
    )


@add("ticket_documents", """
SELECT text, 'TKT-' || conv_id || '-' || turn AS ticket_id, 'C' || lpad(conv_id::VARCHAR, 7, '0') AS customer_id,
       CASE WHEN role = 'user' THEN 'Open' ELSE 'Resolved' END AS status FROM conversations""")
def _(spark, sf_dir):
    documents = vectors.tickets_to_documents(tickets(spark, sf_dir))
    return documents.select("text", "metadata.ticket_id", "metadata.customer_id", "metadata.status")


def collection(spark, sf_dir):
    folder = f"{fresh_folder(spark)}/support_tickets"
    vectors.replace_collection(vectors.embed(vectors.tickets_to_documents(tickets(spark, sf_dir))), folder)
    return spark.read.parquet(folder)


@add("ticket_embeddings", """
SELECT 'TKT-' || conv_id || '-' || turn AS ticket_id, 384::BIGINT AS dimensions,
       CASE WHEN trim(coalesce(text, '')) = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS length FROM conversations""")
def _(spark, sf_dir):
    stored = collection(spark, sf_dir)
    return stored.select(
        "metadata.ticket_id", F.size("embedding").alias("dimensions"),
        F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), 4).alias("length"),
    )


@add("ticket_finds_itself", """
SELECT DISTINCT text, 1.0::DOUBLE AS similarity FROM conversations WHERE trim(text) <> ''""")
def _(spark, sf_dir):
    """Every ticket text as a query: the best ticket has similarity 1."""
    documents = collection(spark, sf_dir)
    asked = documents.filter("trim(text) <> ''").select("text").distinct().withColumn("query_id", F.xxhash64("text"))
    best = vectors.search_tickets(asked, documents, 1).select("query_id", "similarity")
    return asked.join(best, "query_id").select("text", F.round("similarity", 4).alias("similarity"))


@add("ticket_search")
def _(spark, sf_dir):
    asked = tb.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return vectors.search_tickets(asked, collection(spark, sf_dir), 3)
