"""The corpus pipeline: raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and calls one operator; the result is written and read again. A
stage keeps the columns of its input, whatever they are called; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import packing, pii, quality_classifier, simhash, substring_dedup
from basketry.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of ``docs``.

    A null or empty text is scored like any other; without labels every document stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    table = stored(quality_classifier.features(docs), "quality-features")
    return quality_classifier.keep_good(docs, quality_classifier.fit(table, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row: that with the smallest id, null last, and of equal ids the first stored.

    Rows are told apart by a number, not by their id: different texts of one id, or of none, are different documents.
    """
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    groups = stored(simhash.near_duplicates(rows, id_column="__row"), "near-duplicates")
    groups = groups.select(F.col("doc_id").alias("__row"), "component_id")
    named = rows.select("__row", F.col("doc_id").cast("long").alias("id")).join(groups, "__row")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "__row")
    first = named.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.__row").alias("__first"))
    # As many rows as there are groups: merged at every size, never broadcast.
    kept = rows.join(first.hint("merge"), F.col("__row") == F.col("__first"), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that a document with a smaller id has too.

    A text that loses words becomes its other words, joined by a space, and ``n_chars`` their length; others stay.
    """
    names = ("__n_words", "__n_removed", "__kept")
    rows = substring_dedup.remove_repeats(docs, names=names)
    changed = F.col("__n_removed") > 0
    rows = rows.withColumn("text", F.when(changed, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(changed, F.length("__kept").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; the tagger learns from ``docs``."""
    return pii.mask(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with their ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("PII", personal_data),
    ("packing", packed),
]
#: No SQL: a trained classifier and tagger, connected components and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage{number + 1}")
    return docs
