"""Features, order statistics, curves and the churn model, checked against numpy and pandas."""

import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketry.operators import boosting, curves, ordering, stats
from basketry.plans import churn, features
from basketry.session import setting, settle


def test_row_numbers_and_running_totals_over_ranges(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "hot"], 500, p=[0.1, 0.1, 0.8]), "v": rng.integers(0, 40, 500),
                        "id": range(500)})
    df = spark.createDataFrame(pdf).repartition(5)
    got = ordering.with_row_number(df, [F.col("v"), F.col("id")], ["g"], total="n").toPandas().set_index("id")
    pdf = pdf.sort_values(["g", "v", "id"])
    want = pdf.assign(r=pdf.groupby("g").cumcount() + 1, n=pdf.groupby("g")["id"].transform("size")).set_index("id")
    assert (got["row_number"].sort_index() == want["r"].sort_index()).all()
    assert (got["n"].sort_index() == want["n"].sort_index()).all()
    running = ordering.with_running_totals(df, [F.col("v"), F.col("id")], {"upto": "v"}, totals_as={"all": "v"})
    got = running.toPandas().sort_values(["v", "id"])
    assert (got["upto"].to_numpy() == got["v"].cumsum().to_numpy()).all() and (got["all"] == pdf["v"].sum()).all()


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"x": rng.normal(size=301).round(3), "y": rng.integers(0, 5, 301).astype(float)})
    got = stats.describe(spark.createDataFrame(pdf), ["x", "y"], 6).toPandas().set_index("feature")
    want = pdf.describe()
    for name in pdf:
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                             ("min", "min"), ("max", "max"), ("count", "count")):
            assert got.loc[name, ours] == pytest.approx(want.loc[theirs, name], abs=1e-6)


def test_correlations_match_pandas_and_constants_are_null(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(size=100), "z": 1.0})
    pdf["y"] = pdf.x * 2 + rng.normal(size=100)
    rows = {(r.column_x, r.column_y): r.correlation for r in
            stats.correlation_matrix(spark.createDataFrame(pdf), ["x", "y", "z"]).collect()}
    assert len(rows) == 9 and rows[("x", "y")] == pytest.approx(pdf.x.corr(pdf.y), abs=1e-4)
    assert rows[("x", "x")] == 1 and rows[("x", "z")] is None


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.exponential(size=400), "label": rng.integers(0, 2, 400)})
    pdf["same"] = 3.0
    got = stats.clipped_histogram(spark.createDataFrame(pdf), ["x", "same"], "label").toPandas()
    for label in (0, 1):
        part = pdf[pdf.label == label].x.clip(upper=pdf.x.quantile(0.99))
        density, _ = np.histogram(part, bins=40, density=True)
        ours = got[(got.feature == "x") & (got.label == label)].set_index("bin").density.reindex(range(40)).fillna(0)
        assert np.allclose(ours, density, atol=1e-5)
    flat = got[got.feature == "same"]
    assert len(flat) == 2 and set(flat.bin) == {20}


@pytest.mark.parametrize("n", [1, 5, 7, 101])
def test_quintiles_match_pandas_cuts(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"customer_id": [f"C{i:05d}" for i in range(n)], "recency_days": rng.integers(0, 9, n),
                        "frequency": 1, "monetary": rng.normal(size=n).round(2)})
    got = stats.rfm_quintiles(spark.createDataFrame(pdf)).toPandas().set_index("customer_id")
    if n == 1:
        assert (got.r_score.iloc[0], got.f_score.iloc[0], got.m_score.iloc[0]) == (5, 1, 1)
        return
    pdf = pdf.set_index("customer_id")
    for column, ours in (("frequency", "f_score"), ("monetary", "m_score")):
        want = pd.qcut(pdf[column].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert (got[ours].sort_index() == want.sort_index()).all()
    stalest = pdf.recency_days.sort_values().index[-1]
    opposite = stats.rfm_quintiles(spark.createDataFrame(pdf.reset_index()), stale_is_high=True).toPandas()
    assert got.r_score[stalest] == 1 and opposite.set_index("customer_id").r_score[stalest] == 5


def scored(spark, label, score):
    return spark.createDataFrame(list(zip(map(int, label), map(float, score))), "label int, score double")


def test_areas_by_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    score = rng.integers(0, 20, 300) / 20
    label = (rng.random(300) < score).astype(int)
    row = curves.areas(scored(spark, label, score)).first()
    p, n = score[label == 1], score[label == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in p for b in n])
    assert row.auc_roc == pytest.approx(auc, abs=1e-6)
    ap, last = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        tp, fp = ((score >= t) & (label == 1)).sum(), ((score >= t) & (label == 0)).sum()
        ap += (tp / len(p) - last) * tp / (tp + fp)
        last = tp / len(p)
    assert row.avg_precision == pytest.approx(ap, abs=1e-6)
    roc = curves.roc_curve(scored(spark, label, score)).collect()
    assert len(roc) == len(set(score)) + 1
    lowest = min((r for r in roc if r.threshold is not None), key=lambda r: r.threshold)
    assert (lowest.fpr, lowest.tpr) == (1.0, 1.0)


def test_one_class_has_no_area(spark):
    row = curves.areas(scored(spark, [1, 1], [0.2, 0.4])).first()
    assert row.auc_roc is None and row.avg_precision == 1.0
    report = {r["class"]: r for r in curves.classification_report(scored(spark, [1, 1], [0.2, 0.8])).collect()}
    assert report["1"].recall == 0.5 and report["0"].support == 0 and report["accuracy"].f1 == 0.5


def test_bands_on_their_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.300001,), (0.6,), (1.0,)], "p double")
    assert [r[0] for r in df.select(churn.churn_band(F.col("p"))).collect()] == [
        "low_risk", "low_risk", "medium_risk", "medium_risk", "high_risk"]


def labelled(spark, n=400):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"customer_id": [f"C{i:05d}" for i in range(n)], "frequency": rng.integers(0, 30, n),
                        "monetary": rng.random(n) * 100, "recency_days": rng.integers(0, 200, n)})
    pdf["is_churned"] = ((30 - pdf.frequency) * 4 + rng.normal(size=n) * 10 > 60).astype(int)
    return spark.createDataFrame(pdf)


def test_split_and_folds_are_stratified_and_repeatable(spark):
    df = labelled(spark)
    first = features.stratified_split(df).toPandas()
    again = features.stratified_split(df.repartition(7)).toPandas()
    for label, part in first.groupby("is_churned"):
        assert part.is_test.sum() == int(len(part) * 0.2 + 0.5)
    assert set(first[first.is_test].customer_id) == set(again[again.is_test].customer_id)
    sizes = features.stratified_folds(df).groupBy("is_churned", "fold").count().toPandas()
    assert sizes.groupby("is_churned")["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def test_split_leaves_rows_in_their_partitions(spark):
    """Two labels in 8 partitions: a join that shuffles by label leaves rows in two partitions at most."""
    df = labelled(spark).repartition(8)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        split = settle(features.stratified_split(df))
    sizes = split.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and sum(r["count"] for r in sizes) == 400 and split.filter("is_test").count() == 80


def test_rows_of_one_task_come_label_by_label(spark):
    df = settle(labelled(spark).coalesce(1))
    with setting(spark, "spark.sql.shuffle.partitions", "200"):
        rows = churn._gathered(df, "is_churned").select("customer_id", "is_churned", F.spark_partition_id().alias("p")).collect()
    labels = [r.is_churned for r in rows]
    assert {r.p for r in rows} == {0} and sum(a != b for a, b in zip(labels, labels[1:])) == 1
    assert sorted(r.customer_id for r in rows) == sorted(r.customer_id for r in df.collect())


def test_combined_features_never_values(spark):
    rfm = spark.createDataFrame([("a", 5, 1)], "customer_id string, recency_days int, frequency int")
    behavior = spark.createDataFrame([("b", 7, 2)], "customer_id string, days_since_last_login int, login_count int")
    sessions = spark.createDataFrame([("c", 1.5)], "customer_id string, avg_session_duration double")
    rows = {r.customer_id: r for r in features.combined_features(rfm, behavior, sessions, "2024-01-01").collect()}
    assert (rows["a"].recency_days, rows["a"].days_since_last_login) == (5, 9999)
    assert (rows["c"].recency_days, rows["c"].frequency, rows["c"].avg_session_duration) == (9999, 0, 1.5)
    zeros = features.combined_features(rfm, behavior, sessions, "2024-01-01", never_as_zero=True)
    assert zeros.filter("customer_id = 'c'").first().recency_days == 0


def test_leaky_feature_is_left_out_by_default():
    names = ["recency_days", "frequency", "other"]
    assert churn.model_features(names) == ["frequency"]
    assert churn.model_features(names, exclude_leaky=False) == ["recency_days", "frequency"]


def test_folds_grow_at_the_same_time(spark, monkeypatch):
    """Each fold's model waits until all are being fitted; one after the other they would wait in vain."""
    meeting, fit = threading.Barrier(3), churn.GBTClassifier.fit

    def fit_when_all_are_there(self, *given):
        meeting.wait(30)
        return fit(self, *given)

    monkeypatch.setattr(churn.GBTClassifier, "fit", fit_when_all_are_there)
    mean, std = churn.cross_validate(labelled(spark), ["frequency", "monetary"], churn.ChurnParams(trees=3, depth=2), folds=3)
    assert 0.9 < mean <= 1 and 0 <= std < 0.1


def made_up(spark, rows):
    """Five uneven features, among them one constant and one mostly zero, and a label that hangs on three of them."""
    rng = np.random.default_rng(3)
    x = np.stack([rng.gamma(2, 50, rows).round(1), rng.normal(size=rows), np.where(rng.random(rows) < 0.6, 0, rng.gamma(2, 9, rows)),
                  np.ones(rows), rng.integers(0, 6, rows)], 1)
    odds = x[:, 0] / 60 - 1.5 + 0.8 * x[:, 1] - x[:, 2] / 20 + 0.2 * x[:, 4]
    label = (rng.random(rows) < 1 / (1 + np.exp(-odds))).astype(int)
    values = [(f"C{i}", *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    return spark.createDataFrame(values, "customer_id string, a double, b double, c double, d double, e double, is_churned int")


def test_trees_of_all_folds_are_those_of_spark_ml(spark):
    names = list("abcde")
    params = churn.ChurnParams(trees=6, depth=4, rate=0.3, min_child=60)
    how = boosting.Boosting(6, 4, 0.3, 0.8, 0.8, 60, 3.0, 42)
    df = churn._weighted(churn._ready(made_up(spark, 40_000), names, "is_churned"), "is_churned", params)
    df = settle(df.withColumn("fold", F.substring("customer_id", 2, 9).cast("int") % 3).repartition(2))
    scored = boosting.held_out_scores(df, names, "is_churned", 3, how).toPandas()
    for fold in range(3):
        model = churn._pipeline(names, "is_churned", params).fit(df.filter(F.col("fold") != fold))
        held_out = model.transform(df.filter(F.col("fold") == fold))
        raw = held_out.select("is_churned", vector_to_array("rawPrediction")[1].alias("score")).toPandas()
        for label in (0, 1):
            mine = scored[(scored.fold == fold) & (scored.label == label)]
            assert np.allclose(np.sort(np.repeat(mine.score, mine.n.astype(int))), np.sort(raw.score[raw.is_churned == label]))


def test_folds_of_several_tasks_grow_in_the_same_jobs(spark, monkeypatch):
    """No model is fitted on its own, and the areas are those of models that are."""
    df, names, params = made_up(spark, 6000), list("abcde"), churn.ChurnParams(trees=4, depth=3, min_child=50)
    mean, std = churn.cross_validate(df, names, params, folds=3)
    monkeypatch.setattr(churn, "ROWS_OF_ONE_TASK", 1000)
    monkeypatch.setattr(churn, "LEAST_ROWS", 2000)
    monkeypatch.setattr(churn.GBTClassifier, "fit", lambda *_: pytest.fail("fitted on its own"))
    again, spread = churn.cross_validate(df, names, params, folds=3)
    assert abs(again - mean) < 0.02 and spread < 0.05
    with pytest.raises(ValueError, match="0 or 1"):
        odd = df.withColumn("fold", F.lit(0)).withColumn("is_churned", F.lit(None).cast("double"))
        boosting.held_out_scores(odd, names, "is_churned", 1, boosting.Boosting(1, 1, 0.1, 1.0, 1.0, 1, 1.0, 1))


def test_random_numbers_are_those_of_spark(spark):
    drawn = [r[0] for r in spark.range(0, 1000, 1, 1).select(F.rand(43)).collect()]
    assert boosting.uniforms(43, 0, 1000).tolist() == drawn and boosting.uniforms(43, 700, 300).tolist() == drawn[700:]


def test_trees_grow_in_as_many_tasks_as_there_are_cores(spark):
    dealt = churn._gathered(spark.range(0, 200_000, 1, 1).withColumnRenamed("id", "customer_id"))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == min(8, spark.sparkContext.defaultParallelism) and sum(sizes) == 200_000
    assert max(sizes) < 1.1 * min(sizes)
    assert churn._gathered(spark.range(0, 1000, 1, 4)).rdd.getNumPartitions() == 1
    assert [churn._tasks(n, 12) for n in (0, 99_999, 100_000, 720_000, 4_300_000, 60_000_000)] == [1, 1, 4, 12, 12, 120]


def test_areas_by_column_are_those_of_the_rows(spark):
    df = labelled(spark).withColumn("gaps", F.when(F.col("frequency") > 9, F.col("frequency")))
    found = churn.areas_by_column(df, ["frequency", "monetary", "gaps"], "is_churned")
    for name, area in found.items():
        scored = df.select(F.col("is_churned").alias("label"), F.coalesce(name, F.lit(0)).cast("double").alias("score"))
        assert area == pytest.approx(curves.areas(scored).first().auc_roc, abs=1e-6)


def test_model_round_trip(spark, folder):
    df, names = labelled(spark), ["frequency", "monetary"]
    model, metrics = churn.train_churn(df, names, churn.ChurnParams(trees=5, depth=3))
    row = metrics.first()
    assert row.auc_roc > 0.9 and row.training_samples + row.test_samples == 400
    churn.save_model(model, metrics, folder)
    again = churn.load_model(folder)
    a = churn.score_customers(model, df, names, "2024-01-01").orderBy("customer_id").collect()
    b = churn.score_customers(again, df, names, "2024-01-01").orderBy("customer_id").collect()
    assert a == b and len(a) == 400
    ranked = churn.feature_importance(model, names).collect()
    assert ranked[0].feature == "frequency" and ranked[0].importance >= ranked[1].importance
    assert features.training_gate(df, 400) and not features.training_gate(df, 401)
