"""Many small batch folders of a layer into few large ones, while readers go on.

A layer holds a folder ``batch=N`` per micro-batch. Compaction adds ``batch=low-high`` with the rows of all of them; the
folder appears whole, by one rename, and from then on stands for those it covers. ``live_batches`` is the list that
readers go by (``sources.readers.read_layer`` does): so a reader sees either the small folders or the merged one. The
covered folders go with the next run, so that readers at work can finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

MERGED = "_merged-"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _listed(system, place) -> dict[str, object]:
    return {f.getPath().getName(): f.getPath() for f in system.listStatus(place)} if system.exists(place) else {}


def _range(name: str) -> tuple[int, int]:
    low, _, high = name.removeprefix("batch=").partition("-")
    return int(low), int(high or low)


def _sorted_out(names: list[str]) -> tuple[list[str], list[str]]:
    """Batch folders that count, by number, and those that a merged one covers."""
    batches = sorted((n for n in names if n.startswith("batch=")), key=lambda n: (_range(n)[0], -_range(n)[1]))
    live, covered, end = [], [], -1
    for name in batches:
        (covered if _range(name)[1] <= end else live).append(name)
        end = max(end, _range(name)[1])
    return live, covered


def live_batches(spark: SparkSession, path: str) -> list[str]:
    """The batch folders of the layer at ``path`` that a reader has to read; none if it has no such folders."""
    return _sorted_out(list(_listed(*_place(spark, path))))[0]


def compact(
    spark: SparkSession, path: str, partitions: list[str], keep: int = 10, at_least: int = 10,
    order: Sequence[str] = (), options: dict[str, str] | None = None,
) -> int:
    """Merges the batch folders of the layer at ``path``, but for the newest ``keep``, and returns how many.

    A stream may still write its newest batch again, never an older one. Single batches are merged once there are
    ``at_least`` of them, merged ones once there are as many of those, so a row is written again a logarithmic number of
    times. What a run left behind that was broken off is removed by the next. ``order`` sorts the rows of a file, and
    ``options`` go to the writer.
    """
    system, place = _place(spark, path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    found = _listed(system, place)
    live, covered = _sorted_out(list(found))
    for name, folder in found.items():
        if name in covered or name.startswith(MERGED):
            system.delete(folder, True)
    old = live[:-keep] if keep else live
    ranges = [n for n in old if "-" in n]
    singles = old[len(ranges):]  # merged ones hold the lowest numbers
    chosen = old if len(ranges) >= at_least else singles if len(singles) >= max(at_least, 2) else []
    if not chosen:
        return 0
    low, high = _range(chosen[0])[0], _range(chosen[-1])[1]
    # Partition values stay as the folders spell them: inferred types would drop leading zeros of text.
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in chosen]).drop("batch")
        target = f"{path}/{MERGED}{low}-{high}"
        rows = rows.hint("rebalance", *partitions)
        rows = rows.sortWithinPartitions(*order) if order else rows
        rows.write.options(**(options or {})).partitionBy(*partitions).parquet(target)
    finally:
        spark.conf.set(setting, before)
    if not system.rename(jvm_path(target), jvm_path(place, f"batch={low}-{high}")):
        raise OSError(f"could not rename {target}")
    return len(chosen)
