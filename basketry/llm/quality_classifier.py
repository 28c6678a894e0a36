"""Document quality from text statistics: random Fourier features, ridge regression, isotonic calibration.

Cosines of random projections approximate a Gaussian kernel over a few statistics of a text. Every task adds up its
part of the normal equations, by fold; the sums meet in a few slots, and the driver solves one small system, and one per
fold without its rows. The scores that the latter give the rows they have not seen, counted in fixed bins, make a rising
curve (pool adjacent violators) that turns a score into a share of good documents.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import by_key, each_piece, one_thread_each, pieces, record_batch, rows_of, stored, texts_of
from basketry.llm.text_stats import counts

N_FEATURES = 13
#: Labelled documents fall into so many folds by their id; calibration sees each by a model without its fold.
FOLDS = 4
#: Partial sums meet in so many slots per fold before the driver adds them.
SLOTS = 4
#: Bins for calibration: raw scores from -0.5 to 1.5.
BINS, LOW, HIGH = 1000, -0.5, 1.5


def features_of(column: pa.Array) -> np.ndarray:
    """One row of statistics per text, in fixed ranges; an empty text gives finite values too."""
    c = {k: v.astype(float) for k, v in counts(column).items()}
    per = lambda a, b, top=1.0: np.minimum(c[a] / np.maximum(c[b], 1), top)
    return np.column_stack([
        np.log1p(c["n_words"]),
        per("word_chars", "n_words", 20.0),
        np.log1p(20 * per("n_symbols", "n_words", 4.0)),
        per("n_dup_lines", "n_lines"),
        per("n_repeat_words", "n_words"),
        per("n_upper", "n_letters"),
        per("n_digits", "n_chars"),
        np.log1p(20 * per("n_marks", "n_words", 4.0)),
        np.sqrt(per("n_ends", "n_words")),
        per("n_distinct", "n_words"),
        per("n_other", "n_chars"),
        per("n_letters", "n_chars"),
        np.log1p(c["n_words"] / np.maximum(c["n_lines"], 1)),
    ])


def is_held_out(doc_id: Column) -> Column:
    """Whether a document stays out of training: by the checksum of its id as text (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """Everything scoring needs: a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([np.ones(len(x)), waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Rounded: the last bits of a product depend on the rows beside it, and equal texts get equal scores.
        return np.round(self.expand(x) @ self.weights, 9)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.knots)


def rising_curve(centers: np.ndarray, n: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; a block is one knot at its mean place, joined by straight lines.

    Shares are drawn a little towards one half, by one row of each label per block.
    """
    blocks: list[list[float]] = []  # rows, positives, sum of places
    for place, rows, good in zip(centers, n, positives):
        blocks.append([rows, good, place * rows])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    places = np.array([b[2] / b[0] for b in blocks])
    shares = np.maximum.accumulate([(b[1] + 1) / (b[0] + 2) for b in blocks])
    return places, shares


def features(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the statistics of the whole text."""

    def measure(piece):
        return {"doc_id": piece.column("doc_id"), "x": pa.array(list(features_of(piece.column("text"))))}

    return each_piece(texts_of(documents, id_column, text_column), measure, "doc_id long, x array<double>")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, N_FEATURES)


def _sums(rows: DataFrame, model: Model) -> np.ndarray:
    """Normal equations (the target as last column) of ``rows`` (x, y, fold), one per fold: summed per task, then per
    slot, then here."""
    size = len(model.phases) + 1

    def per_task(batches):
        totals = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                z, y = model.expand(_matrix(part.column("x"))), np.asarray(part.column("y"))
                folds = np.asarray(part.column("fold"))
                for fold in np.unique(folds).tolist():
                    own = z[folds == fold]
                    totals[fold] = totals.get(fold, 0) + own.T @ np.column_stack([own, y[folds == fold]])
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() % SLOTS
        for fold, total in totals.items():
            yield record_batch({"slot": pa.array([fold * SLOTS + place], pa.int32()), "sums": pa.array([total.tobytes()])})

    def per_slot(batches):
        slot, total = None, None
        for row in rows_of(batches):
            if slot is not None and row["slot"] != slot:
                yield record_batch({"slot": pa.array([slot], pa.int32()), "sums": pa.array([total.tobytes()])})
                total = None
            slot, add = row["slot"], np.frombuffer(row["sums"])
            total = add if total is None else total + add
        if slot is not None:
            yield record_batch({"slot": pa.array([slot], pa.int32()), "sums": pa.array([total.tobytes()])})

    schema = "slot int, sums binary"
    out = np.zeros((FOLDS, size, size + 1))
    for row in by_key(rows.mapInArrow(per_task, schema), "slot").mapInArrow(per_slot, schema).toLocalIterator():
        out[row["slot"] // SLOTS] += np.frombuffer(row["sums"]).reshape(size, size + 1)
    return out


def _solved(sums: np.ndarray, ridge: float) -> np.ndarray:
    """The weights of normal equations; with no row all are zero."""
    gram, target = sums[:, :-1], sums[:, -1]
    n = gram[0, 0]
    penalty = np.full(len(gram), ridge * n + 0.01)
    penalty[0] = 0 if n else 1  # the constant
    return np.linalg.solve(gram + np.diag(penalty), target)


def fit(
    table: DataFrame, labels: DataFrame, n_waves: int = 256, width: float = 4.0, ridge: float = 2e-4, seed: int = 7,
) -> Model:
    """A model from a table of ``features`` and ``labels`` (doc_id, quality 0 or 1).

    All labelled documents that are not held out take part, every row of a repeated id; labels without a document, or
    null, do not. A label given twice counts once, and an id with both labels has none. Scales come from all documents.
    Without any labelled document every score is 0.5.
    """
    spread = [F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(N_FEATURES)]
    spread += [F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(N_FEATURES)]
    row = table.agg(*spread).first()
    mean = np.array([row[f"m{k}"] or 0.0 for k in range(N_FEATURES)])
    scale = np.array([max(row[f"s{k}"] or 0.0, 1e-3) for k in range(N_FEATURES)])
    rng = np.random.default_rng(seed)
    directions, phases = rng.normal(0, 1 / width, (N_FEATURES, n_waves)), rng.uniform(0, 2 * np.pi, n_waves)
    model = Model(mean, scale, directions, phases, np.zeros(n_waves + 1), (np.array([0.0]), np.array([0.5])))

    marks = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y IN (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = table.where(~is_held_out(F.col("doc_id"))).join(marks, "doc_id").select("x", "y", fold)
    rows = stored(rows, "quality-rows")
    sums = _sums(rows, model)
    if not sums.any():
        return model
    total = sums.sum(axis=0)
    model.weights = _solved(total, ridge)
    unseen = [replace(model, weights=_solved(total - part if (total - part)[0, 0] else total, ridge)) for part in sums]

    def binned(batches):
        for batch in batches:
            x, folds = _matrix(batch.column("x")), np.asarray(batch.column("fold"))
            raw = np.zeros(len(x))
            for k in np.unique(folds).tolist():
                raw[folds == k] = unseen[k].raw(x[folds == k])
            raw = np.clip(raw, LOW, HIGH - 1e-9)
            yield record_batch({
                "bin": ((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int32), "raw": raw, "y": batch.column("y"),
            })

    bins = (
        rows.mapInArrow(binned, "bin int, raw double, y double").groupBy("bin")
        .agg(F.avg("raw").alias("at"), F.count("*").alias("n"), F.sum("y").alias("good")).orderBy("bin").collect()
    )
    model.knots = rising_curve(*(np.array([float(r[k]) for r in bins]) for k in ("at", "n", "good")))
    return model


def score_features(table: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for a table of ``features``, one row per document."""

    def run(batches):
        for batch in batches:
            yield record_batch({"doc_id": batch.column("doc_id"), "score": model.score(_matrix(batch.column("x")))})

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def classify(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learns from ``labels`` and scores every document: ``doc_id, held_out, score`` (0 to 1) and ``predicted``.

    A null text counts as empty and gets a score like any other; equal texts get equal scores; rows with a null id are
    scored but never learnt from; repeated rows are scored once each; an empty table gives an empty result. Columns
    other than id and text are not looked at.
    """
    table = stored(features(documents, id_column, text_column), "quality-features")
    return score_features(table, fit(table, labels))


def keep_good(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The documents that ``model`` accepts, all columns as they were."""
    one_thread_each(documents.sparkSession)

    def run(batches):
        for piece in pieces(batches, text_column):
            good = model.score(features_of(piece.column(text_column))) >= 0.5
            yield piece.filter(pa.array(good))

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))
