"""Batch sinks: dated snapshots, topic rows, views and tables, quality and run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import Moment, as_moment
from basketry.operators.keyed import upsert
from basketry.plans.warehouse import topic_of
from basketry.schemas import shaped
from basketry.session import settle
from basketry.sources.readers import FINISHED


def write_gold(df: DataFrame, path: str, run_date: str) -> None:
    """One snapshot per run date; writing a date again replaces that date only.

    A mark beside the snapshots says that a run is finished; it goes before the run is written again.
    """
    jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    mark = jvm_path(f"{path}/{FINISHED}/run_date={run_date}")
    system = mark.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    system.delete(mark, False)
    (
        df.withColumn("run_date", F.lit(run_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )
    system.create(mark, True).close()


def upsert_partitions(
    updates: DataFrame, path: str, keys: Sequence[str], partition: str, update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> None:
    """Upsert into a table stored by ``partition``, which is one of the keys.

    Only the partitions the updates touch are read and rewritten; the null partition is one of them if an update has
    no partition value, and its stored rows stay. The merged rows are stored before the old ones are replaced.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys")
    target = updates.sparkSession.read.parquet(path)
    touched = updates.select(F.col(partition).cast(target.schema[partition].dataType).alias("_touched")).distinct()
    touched = settle(touched)
    known = target.join(touched, F.col(partition) == F.col("_touched"), "left_semi")
    if not touched.filter("_touched IS NULL").isEmpty():
        known = known.unionByName(target.filter(F.col(partition).isNull()))
    merged = settle(upsert(known, updates.select(*[c for c in target.columns if c in updates.columns]),
                           keys, update_cols, order_by))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def to_topic_rows(events: DataFrame) -> DataFrame:
    """(key, value, topic) rows, ready for ``format("kafka")``: key customer, value the event as JSON."""
    return events.select(
        F.coalesce("customer_id", F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
        topic_of(F.col("event_type")).alias("topic"),
    )


def materialize(df: DataFrame, name: str, kind: str = "table") -> None:
    """Staging models become views, everything else a managed table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization {kind}")


def append_dq_results(results: DataFrame, path: str) -> None:
    shaped(results, schemas.QUALITY_RESULTS).write.mode("append").parquet(path)


def run_log_row(
    output: DataFrame, dag_id: str, run_id: str, task_id: str, started: Moment, completed: Moment,
    status: str = "success",
) -> DataFrame:
    """One log row that counts the records of ``output``."""
    start, end = as_moment(started), as_moment(completed)
    counted = output.agg(F.count("*").alias("records_processed"))
    row = counted.select(
        F.lit(dag_id).alias("dag_id"), F.lit(run_id).alias("run_id"), F.lit(task_id).alias("task_id"),
        F.lit(status).alias("status"), "records_processed",
        (F.unix_seconds(end) - F.unix_seconds(start)).alias("duration_seconds"),
        start.alias("started_at"), end.alias("completed_at"),
    )
    return shaped(row, schemas.RUN_LOG)


def append_run_log(row: DataFrame, path: str) -> None:
    shaped(row, schemas.RUN_LOG).write.mode("append").parquet(path)
