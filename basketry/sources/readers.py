"""Sources: event streams, layer tables, event files, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry import schemas
from basketry.streaming.compaction import live_batches
from basketry.vocabulary import TOPIC_OF_EVENT

ALL_TOPICS = sorted(set(TOPIC_OF_EVENT.values()))
#: Hidden folder of a snapshot table with one empty file per finished run.
FINISHED = "_finished"


def read_event_stream(
    spark: SparkSession, source: str, *, kind: str = "kafka", max_per_trigger: int = 50_000, max_files: int = 1000,
    starting: str = "latest",
) -> DataFrame:
    """All topics as one stream of (key, value, topic, partition, offset, timestamp).

    ``kind="kafka"`` reads from the brokers in ``source`` and needs the Kafka connector on the classpath.
    ``max_per_trigger`` messages make a batch. ``kind="files"`` reads message files (Parquet) from the folder
    ``source``, ``max_files`` to a batch.
    """
    if kind == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source)
            .option("subscribe", ",".join(ALL_TOPICS))
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", max_per_trigger)
            .option("failOnDataLoss", "false")
            .load()
        )
    return spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", max_files).parquet(source)


def read_layer_stream(
    spark: SparkSession, path: str, schema: str | StructType = schemas.SILVER, max_files: int | None = None
) -> DataFrame:
    """A layer's Parquet files as a stream with a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_layer(
    spark: SparkSession, path: str, schema: str | StructType | None = None, since: str | None = None
) -> DataFrame:
    """A layer as a batch; ``since`` (a date) prunes by the year/month/day partitions of the layer.

    Of a layer in batch folders those are read that count at this moment (``streaming.compaction``).
    """
    reader = spark.read.schema(schema) if schema else spark.read
    batches = live_batches(spark, path)
    df = reader.option("basePath", path).parquet(*[f"{path}/{b}" for b in batches]) if batches else reader.parquet(path)
    if since is None:
        return df
    year, month, day = (int(x) for x in since.split("-"))
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    return df.filter((y > year) | ((y == year) & ((m > month) | ((m == month) & (d >= day)))))


def read_new_files(spark: SparkSession, path: str, schema: str | StructType, max_files: int | None = None) -> DataFrame:
    """Files not seen before, for a query that runs with ``trigger(availableNow=True)`` and a fixed checkpoint."""
    return read_layer_stream(spark, path, schema, max_files)


def read_events_files(spark: SparkSession, path: str, fmt: str, schema: str | StructType = schemas.PAYLOAD) -> DataFrame:
    """Event files as Parquet, JSON lines or CSV with a header; list fields in CSV are JSON text."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt == "csv":
        flat, wanted = StructType(), schemas.struct(schema) if isinstance(schema, str) else schema
        for f in wanted.fields:
            flat.add(f.name, "string" if f.dataType.typeName() == "array" else f.dataType)
        df = spark.read.schema(flat).csv(path, header=True, escape='"')
        return df.withColumns(
            {f.name: F.from_json(f.name, f.dataType) for f in wanted.fields if f.dataType.typeName() == "array"}
        )
    raise ValueError(f"unknown event file format {fmt}")


def read_json_array(spark: SparkSession, path: str, schema: str | StructType = schemas.TICKETS) -> DataFrame:
    """A file holding one JSON array of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_table(
    spark: SparkSession, name: str, *, jdbc_url: str | None = None, split_on: str | None = None,
    bounds: tuple | None = None, splits: int = 32, **options: str,
) -> DataFrame:
    """A catalog table, or a database table read in ``splits`` ranges of the column ``split_on``."""
    if jdbc_url is None:
        return spark.read.table(name)
    reader = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", name).options(**options)
    if split_on is not None:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", splits)
        )
    return reader.load()


def read_latest_snapshot(spark: SparkSession, path: str, partition: str = "run_date") -> DataFrame:
    """Rows of the newest finished run: the last partition folder by name, as dates and padded numbers sort. Only its
    files are listed and read. Where the writer left marks (``sinks.writers.write_gold``), a run without one is not
    finished; a table without any mark has finished runs only."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = spark._jvm.org.apache.hadoop.fs.Path(place, FINISHED)
    listed = lambda at: [e.getPath().getName() for e in system.listStatus(at)]
    names = [n for n in listed(place) if n.startswith(f"{partition}=") and "__HIVE_DEFAULT" not in n]
    if system.exists(marks):
        done = set(listed(marks))
        names = [n for n in names if n in done]
    if not names:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(f"{path}/{max(names)}")
