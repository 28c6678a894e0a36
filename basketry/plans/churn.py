"""Churn model: training, cross-validation, scoring, storage."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import Moment, as_moment, band_up_to
from basketry.operators.boosting import Boosting, held_out_scores
from basketry.operators.curves import areas
from basketry.plans.features import stratified_folds, stratified_split
from basketry.session import settle
from basketry.vocabulary import CHURN_BANDS, CHURN_LAST, FEATURE_COLUMNS

LEAKY = "recency_days"


@dataclass(frozen=True)
class ChurnParams:
    """Boosted-tree settings; the defaults are those of the main model."""

    trees: int = 300
    depth: int = 6
    rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_child: int = 5
    positive_weight: float = 3.0
    seed: int = 42


# The weekly retraining settings.
WEEKLY = ChurnParams(trees=200, rate=0.1, min_child=1, positive_weight=1.0)


def model_features(columns: Sequence[str], wanted: Sequence[str] = FEATURE_COLUMNS, exclude_leaky: bool = True):
    """Features present in the data; the one the label is cut from is left out unless asked for."""
    return [c for c in wanted if c in columns and not (exclude_leaky and c == LEAKY)]


def _weighted(df: DataFrame, label: str, params: ChurnParams) -> DataFrame:
    return df.withColumn("_weight", F.when(F.col(label) == 1, params.positive_weight).otherwise(1.0))


def _pipeline(features: Sequence[str], label: str, params: ChurnParams) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep"),
            GBTClassifier(
                featuresCol="_features", labelCol=label, weightCol="_weight", predictionCol="_predicted", maxIter=params.trees,
                maxDepth=params.depth, stepSize=params.rate, subsamplingRate=params.row_sample,
                featureSubsetStrategy=str(params.column_sample), minInstancesPerNode=params.min_child,
                checkpointInterval=10, seed=params.seed,
            ),
        ]
    )


def _ready(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return filled if label is None else filled.withColumn(label, F.col(label).cast("double"))


#: Rows that one task alone grows trees from: hundreds of trees mean thousands of short jobs, which few tasks keep short.
ROWS_OF_ONE_TASK = 100_000
#: Rows that each of several tasks gets at least and, for its memory's sake, at most.
LEAST_ROWS, MOST_ROWS = 25_000, 500_000


def _tasks(rows: int, cores: int) -> int:
    """One task per core or, if they would get too many rows, several."""
    if rows < ROWS_OF_ONE_TASK:
        return 1
    return min(rows // LEAST_ROWS, cores * -(-rows // (cores * MOST_ROWS)))


def _gathered(df: DataFrame, label: str | None = None) -> DataFrame:
    """``df`` dealt evenly to the tasks that grow trees from it.

    The partitions it comes in are as few as their bytes allow, and ``coalesce`` never makes them more. The rows of one task
    are put in the order of a shuffle by ``label``, if given, as the seeded row samples of the trees go by the place of a row.
    """
    tasks = _tasks(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    if tasks > 1:
        return df.repartition(tasks)
    return (df if label is None else df.repartition(label)).coalesce(1)


def train_churn(
    df: DataFrame, features: Sequence[str], params: ChurnParams = ChurnParams(), label: str = "is_churned",
    test_share: float = 0.2,
) -> tuple[PipelineModel, DataFrame]:
    """A fitted model, and one row of metrics measured on the held-out share."""
    split = settle(_weighted(_ready(stratified_split(df, label, test_share, params.seed), features, label), label, params))
    learned, held_out = split.filter(~F.col("is_test")), split.filter("is_test")
    model = _pipeline(features, label, params).fit(_gathered(learned, label))
    judged = probabilities(model, held_out).select(F.col(label).cast("int").alias("label"), "score")
    metrics = areas(judged).select(
        "auc_roc",
        "avg_precision",
        learned.agg(F.count("*")).scalar().alias("training_samples"),
        held_out.agg(F.count("*")).scalar().alias("test_samples"),
        F.lit(json.dumps(list(features))).alias("features"),
        F.lit(json.dumps(asdict(params))).alias("params"),
    )
    return model, metrics


def cross_validate(
    df: DataFrame, features: Sequence[str], params: ChurnParams = ChurnParams(), folds: int = 5,
    label: str = "is_churned",
) -> tuple[float, float]:
    """Mean and standard deviation of the area under the ROC curve over stratified folds.

    The models of all folds grow at the same time. Rows of one task (``_gathered``) are learnt from by Spark ML, a thread per
    fold: every model is a long row of short jobs, and ``CrossValidator`` would fit fold after fold, as its ``parallelism``
    only holds for the settings of one fold. Over several tasks ``operators.boosting`` grows the same trees, for all folds
    in one job per level.
    """
    ready = _weighted(_ready(stratified_folds(df, folds, label, params.seed), features, label), label, params)
    dealt = _gathered(settle(ready))
    if dealt.rdd.getNumPartitions() > 1:
        return _cross_validate_large(dealt, features, params, folds, label)
    judge = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label, numBins=0)

    def area(fold: int) -> float:
        learned, held_out = dealt.filter(F.col("fold") != fold).cache(), dealt.filter(F.col("fold") == fold)
        try:
            if learned.isEmpty() or held_out.isEmpty():
                raise ValueError(f"fold {fold} has no rows to learn from or to judge by")
            return judge.evaluate(_pipeline(features, label, params).fit(learned).transform(held_out))
        finally:
            learned.unpersist()

    with ThreadPool(folds) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(area), range(folds))
    return float(np.mean(found)), float(np.std(found))


def _cross_validate_large(
    dealt: DataFrame, features: Sequence[str], params: ChurnParams, folds: int, label: str
) -> tuple[float, float]:
    how = Boosting(params.trees, params.depth, params.rate, params.row_sample, params.column_sample, params.min_child,
                   params.positive_weight, params.seed)
    scored = held_out_scores(dealt, features, label, folds, how).persist()
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", weightCol="n", numBins=0)
    try:
        found = [judge.evaluate(scored.filter(F.col("fold") == fold)) for fold in range(folds)]
    finally:
        scored.unpersist()
    return float(np.mean(found)), float(np.std(found))


def areas_by_column(scored: DataFrame, columns: Sequence[str], label: str = "label", at_once: int = 4) -> dict[str, float]:
    """Area under the ROC curve of every column taken as a score (null as 0), a few columns at a time.

    Rows are counted by value and label first, so what is sorted are the different values, not the rows.
    """

    def area(column: str) -> float:
        value = F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value")
        counted = scored.select(F.col(label).cast("double").alias("label"), value).groupBy("label", "value").agg(
            F.count("*").cast("double").alias("n"))
        return BinaryClassificationEvaluator(
            rawPredictionCol="value", labelCol="label", weightCol="n", numBins=0).evaluate(counted)

    with ThreadPool(at_once) as pool:
        return dict(zip(columns, pool.map(inheritable_thread_target(scored.sparkSession)(area), columns)))


def probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def feature_importance(model: PipelineModel, features: Sequence[str], top: int = 10) -> DataFrame:
    """The most important features, at most one row per feature of the model."""
    from pyspark.sql import SparkSession

    weights = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def churn_band(probability: F.Column) -> F.Column:
    """Right-closed bands; probability 0 is low risk."""
    return band_up_to(probability, CHURN_BANDS, CHURN_LAST)


def score_customers(
    model: PipelineModel, features_df: DataFrame, features: Sequence[str], as_of: Moment, version: str = "v1.0"
) -> DataFrame:
    """Probability and risk band per customer, shaped for the score table."""
    scored = probabilities(model, _ready(features_df, features))
    return scored.select(
        "customer_id",
        F.col("score").cast("decimal(8,6)").alias("churn_probability"),
        churn_band(F.round("score", 6)).alias("churn_segment"),
        F.lit(version).alias("model_version"),
        as_moment(as_of).alias("scored_at"),
    )


def save_model(model: PipelineModel, metrics: DataFrame, folder: str, version: str = "latest") -> str:
    path = f"{folder.rstrip('/')}/churn_model_{version}"
    model.write().overwrite().save(path)
    metrics.write.mode("overwrite").json(f"{path}_metrics")
    return path


def load_model(folder: str, version: str = "latest") -> PipelineModel:
    return PipelineModel.load(f"{folder.rstrip('/')}/churn_model_{version}")
