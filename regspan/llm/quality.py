"""A quality classifier: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import keep
from .minhash import shingle_hashes
from .words import NOT_SPACE, utf8, word_hashes

# Labelled rows used to fit; of more, a share chosen by a hash of the id.
MAX_LABELLED = 200_000
# Tasks that sum up normal equations; each gives FOURIER + 1 short rows.
FIT_TASKS = 16
FOURIER = 256
RIDGE = 1e-3
SEED = 71
BINS = 400
THRESHOLD = 0.3
# Share of the uncalibrated score, which orders documents of one calibrated level.
TIES = 1e-3

STATISTICS = (
    "log_words", "word_bytes", "distinct_words", "commonest_word", "repeated_trigrams", "repeated_lines",
    "log_line_words", "letters", "upper", "digits", "spaces", "periods", "commas", "exclamations",
    "bars", "symbols", "high_bytes", "entropy",
)


def statistics(text: np.ndarray, words: np.ndarray) -> list[float]:
    """Statistics of one text from its bytes and the hashes of its words."""
    n, size = len(words), max(len(text), 1)
    share = np.bincount(text, minlength=256) / size
    per_word = size / max(n, 1)
    _, counts = np.unique(words, return_counts=True)
    _, triples = np.unique(shingle_hashes(words, 3), return_counts=True)
    raw = text.tobytes()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    some = share[share > 0]
    of = lambda chars: float(share[list(chars)].sum())
    return [
        np.log1p(n),
        (size - size * of(b" \t\n\v\f\r")) / max(n, 1),
        len(counts) / max(n, 1),
        counts.max() / n if n else 0.0,
        triples[triples > 1].sum() / max(triples.sum(), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        float(share[97:123].sum()),
        float(share[65:91].sum()),
        float(share[48:58].sum()),
        of(b" \t\n"),
        of(b".") * per_word,
        of(b",;:") * per_word,
        of(b"!?") * per_word,
        of(b"|") * per_word,
        of(b"#*$%&<>=~^{}[]\\/@_") * per_word,
        float(share[128:].sum()),
        float(-(some * np.log2(some)).sum()),
    ]


def text_statistics(column: pa.Array) -> np.ndarray:
    data, at = utf8(column)
    out = np.zeros((len(column), len(STATISTICS)))
    for i, n, _, _, hashes, first in word_hashes(column, NOT_SPACE):
        for k in range(n):
            out[i + k] = statistics(data[at[i + k] : at[i + k + 1]], hashes[first[k] : first[k + 1]])
    return out


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score; about 40 kB."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    levels: tuple[np.ndarray, np.ndarray] | None = None

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Features whose inner products approximate a Gaussian kernel, and a constant."""
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        level = np.interp(raw, *self.levels) if self.levels else np.full(len(raw), 0.5)
        return np.clip((1 - TIES) * level + TIES * np.clip((raw + 1) / 3, 0, 1), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def features(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``_id`` and ``_x`` of every document, written once."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(batch.column("_text"))
            at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(at, x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), lists], ["_id", "_x"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    return keep(rows.mapInArrow(of, f"_id {docs.schema[id].dataType.simpleString()}, _x array<double>"), "features")


def fold(id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 for a null id. Fold 0 is held out."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 5


def _equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y, first per task, then per matrix row over the tasks."""
    width = len(model.phases) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = model.expand(_matrix(batch.column("_x")))
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], ["_i", "_row"]
        )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that rounding does not depend on the order in which tasks end.
        parts = np.stack(sorted(group["_row"], key=lambda r: r.tobytes()))
        return pd.DataFrame({"_i": group["_i"][:1].to_numpy(), "_row": [parts.sum(axis=0)]})

    dealt = rows.repartition(FIT_TASKS, "_id").sortWithinPartitions("_id", "_x", "_y").select("_x", "_y")
    parts = dealt.mapInArrow(sums, "_i long, _row array<double>")
    found = parts.groupBy("_i").applyInPandas(add, "_i long, _row array<double>").orderBy("_i").collect()
    both = np.array([r["_row"] for r in found])
    return both[:, :-1], both[:, -1]


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ascending means ``y`` at ``x``, weighted by ``n``."""
    blocks: list[list[float]] = []
    for block in zip(x * n, y * n, n):
        blocks.append(list(block))
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    at = np.array(blocks)
    return at[:, 0] / at[:, 2], at[:, 1] / at[:, 2]


def _levels(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray] | None:
    """Isotonic levels from at most BINS + 2 bins of the raw score."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column("_x")))
            at = np.clip(np.floor((raw + 0.5) * BINS / 2), -1, BINS)
            columns = [pa.array(at.astype(np.int64)), pa.array(raw), batch.column("_y")]
            yield pa.RecordBatch.from_arrays(columns, ["_bin", "_raw", "_y"])

    counted = (
        rows.select("_x", "_y").mapInArrow(bins, "_bin long, _raw double, _y double").groupBy("_bin")
        .agg(F.avg("_raw").alias("x"), F.avg("_y").alias("y"), F.count(F.lit(1)).alias("n"))
        .orderBy("_bin").toPandas()
    )
    if not len(counted):
        return None
    return isotonic(counted["x"].to_numpy(), counted["y"].to_numpy(), counted["n"].to_numpy(float))


def fit(
    found: DataFrame, labels: DataFrame, id: str = "doc_id", quality: str = "quality", most: int = MAX_LABELLED
) -> Model:
    """Fit on labelled rows outside fold 0: ridge on folds 1 to 3, calibration on fold 4.

    Of more than ``most`` labelled rows a share is used, by a hash of the id. The normal equations
    are summed per task, so the driver gets one matrix of FOURIER + 1 rows. Without labels every
    score is about 0.5.
    """
    rng = np.random.default_rng(SEED)
    width = len(STATISTICS)
    directions = rng.normal(size=(width, FOURIER)) / np.sqrt(width)
    phases = rng.uniform(0, 2 * np.pi, FOURIER)
    marks = labels.where(F.col(quality).isNotNull()).select(
        F.col(id).alias("_id"), (F.col(quality) > 0).cast("double").alias("_y")
    )
    known = found.join(marks, "_id").withColumn("_fold", fold(F.col("_id"))).where("_fold != 0")
    known = keep(known, "labelled")
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(most / n * (1 << 30)))
    stats = [F.struct(F.avg(F.col("_x")[i]), F.stddev_pop(F.col("_x")[i])) for i in range(width)]
    moments = known.agg(F.array(*stats).alias("m")).first()["m"]
    if moments[0][0] is None:
        return Model(np.zeros(width), np.ones(width), directions, phases, np.zeros(FOURIER + 1))
    mean = np.array([m[0] for m in moments])
    spread = np.array([m[1] for m in moments])
    # Rounded, so that the last bits of a sum do not depend on the order of rows.
    mean, scale = np.round(mean, 9), np.round(np.where(spread > 1e-6, spread, 1.0), 9)
    model = Model(mean, scale, directions, phases, np.zeros(FOURIER + 1))
    first, rest = known.where("_fold < 4"), known.where("_fold = 4")
    if first.isEmpty() or rest.isEmpty():  # too few rows to keep some back
        first = rest = known
    left, right = _equations(first, model)
    penalty = np.eye(FOURIER + 1) * RIDGE * max(left[-1, -1], 1)
    penalty[-1, -1] = 1e-9
    model = Model(mean, scale, directions, phases, np.linalg.solve(left + penalty, right))
    return Model(mean, scale, directions, phases, model.weights, _levels(rest, model))


def labelled(docs: DataFrame, labels: DataFrame, id: str, quality: str, most: int) -> DataFrame:
    """The rows of ``docs`` that ``fit`` may use; of more than ``most`` labels a share, by a hash of the id.

    The ids are counted first, so what is broadcast is bounded by ``most`` and no text is shuffled.
    """
    ids = labels.where(F.col(quality).isNotNull() & (fold(F.col(id)) != 0)).select(id).distinct()
    n = ids.count()
    if n > most:
        ids = ids.where(F.pmod(F.xxhash64(id), F.lit(1 << 30)) < int(most / n * (1 << 30)))
    return docs.join(F.broadcast(ids), id, "left_semi")


def classify(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality",
    threshold: float = THRESHOLD, most: int = MAX_LABELLED,
) -> DataFrame:
    """Per document: ``id``, ``held_out``, ``score`` and ``predicted`` (1 if the score reaches the threshold).

    Only statistics of the whole text are inputs. Null texts count as empty and get a score
    like any text. A null id is held out. Rows repeated in ``docs`` or ``labels`` weigh as often as
    they occur; labels of unknown documents and null labels are ignored. An empty table gives an
    empty result.
    """
    found = features(docs, id, text)
    model = fit(found, labels, id, quality, most)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(_matrix(batch.column("_x"))))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), scores], ["_id", "score"])

    scored = found.mapInArrow(score, f"_id {docs.schema[id].dataType.simpleString()}, score double")
    return scored.select(
        F.col("_id").alias(id),
        (fold(F.col("_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def passing(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality",
    threshold: float = THRESHOLD, most: int = MAX_LABELLED, training: DataFrame | None = None,
) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns.

    The model is fitted on the labelled rows of ``training`` (``docs`` by default). Documents are
    not shuffled: their statistics are computed where they are read.
    """
    known = labelled(docs if training is None else training, labels, id, quality, most)
    model = fit(features(known, id, text), labels, id, quality, most)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(text_statistics(batch.column(text))) >= threshold))

    return docs.mapInArrow(select, docs.schema)
