"""What the text operators share: tables in the shared folder, Arrow batches of text, keyed groups of blobs."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import shared_path

#: Bytes of text that a task takes up at a time; a longer text is taken alone.
PIECE_BYTES = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Later steps read one fixed result, column by column, and survive the loss of executors.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which follows the size of the data on a tuned cluster."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_thread_each(spark: SparkSession) -> None:
    """Python workers started from now on compute with one thread: a task has one core, and the threads of many tasks
    would wait for each other. A setting of the deployment goes first."""
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")


def texts_of(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` and ``text`` (null text: empty). Other columns stay out."""
    one_thread_each(df.sparkSession)
    return df.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of UTF-8 bytes, and where each begins (one more entry than texts)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def each_piece(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text") -> DataFrame:
    """``make`` over slices of ``df``; it returns columns in the order of ``schema``."""

    def run(batches):
        for piece in pieces(batches, text):
            yield record_batch(make(piece))

    return df.mapInArrow(run, schema)


def record_batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for first in range(0, batch.num_rows, 8):  # a batch of blobs may be large: never all of it as Python objects
            yield from batch.slice(first, 8).to_pylist()


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows that arrive sorted by ``key``, one list per key, across batches."""
    for value, rows in itertools.groupby(rows_of(batches), key=lambda r: r[key]):
        yield value, list(rows)


def by_key(df: DataFrame, key: str, *then: str) -> DataFrame:
    """Rows dealt out by ``key`` and sorted, for ``groups_of``."""
    return df.repartition(partitions(df.sparkSession), key).sortWithinPartitions(key, *then)
