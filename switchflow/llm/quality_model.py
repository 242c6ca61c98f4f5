"""Quality classifier: kernel ridge regression through random Fourier features, calibrated by isotonic regression.

Statistics of a document's whole text are mapped to cosines of random projections, which
approximate a Gaussian kernel. Partitions sum their share of the normal equations; the
sums, whose size depends on the number of features alone, are solved on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import whole_text
from switchflow.session import materialize

FIT_ROWS = 200_000  # labelled rows that a fit uses at most, taken by a hash of the id
FIT_PARTITIONS = 16
FEATURES = 192
LENGTH_SCALE = 3.0  # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-3  # per row
FOLDS = 4
SEED = 20_240_501
SCORE_STEPS = 2000
THRESHOLD = 0.3

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>@^~_+={}[]\\/")] = True
UPPER, LOWER, DIGIT, SPACE, HIGH = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91], LOWER[97:123], DIGIT[48:58], HIGH[128:192] = True, True, True, True
SPACE[[9, 10, 11, 12, 13, 32]] = True
N_STATS = 20


def statistics(text: bytes) -> list[float]:
    """Twenty numbers of a text, all finite; the empty text has its own."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(float)
    chars = max(1.0, counts.sum() - counts[HIGH].sum())  # code points
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=float, count=len(words)) if words else np.zeros(1)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda mask: counts[mask].sum() / chars
    return [
        np.log1p(len(words)),
        np.log1p(chars),
        lengths.mean(),
        min(lengths.std(), 50.0),
        min(lengths.max(), 100.0),
        (lengths <= 1).mean(),
        distinct / n,
        distinct / n**0.8,
        pairs / max(1, len(words) - 1),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
        share(SYMBOLS),
        share(UPPER),
        share(LOWER),
        share(DIGIT),
        share(SPACE),
        counts[[33, 63]].sum() / n,
        counts[46] / n,
        counts[44] / n,
        sum(w.isalpha() for w in words) / n,
    ]


@dataclass
class Model:
    """A fitted classifier; a few hundred numbers per feature, sent along with the tasks."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, ascending
    values: np.ndarray  # calibrated scores there, ascending

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(features(stats, self.mean, self.scale) @ self.weights, self.knots, self.values)


def _projection() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    return draw.normal(size=(N_STATS, FEATURES)) / LENGTH_SCALE, draw.uniform(0, 2 * np.pi, FEATURES)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardized statistics, and a constant."""
    w, b = _projection()
    x = np.clip((stats - mean) / scale, -6, 6)
    return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(x @ w + b), np.ones((len(x), 1))], axis=1)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 for a null id. Remainder 0 is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)).cast("int")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(doc_id, stats) of whole texts; null counts as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = [statistics(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select("doc_id", whole_text(text_column).cast("binary").alias("b")).mapInArrow(run, f"doc_id {kind}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), N_STATS)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ascending values closest to y, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in blocks])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled rows that are not held out, `fit_rows` at most.

    Ids with several labels count by their mean label; null ids and labels take no part.
    Without usable labels the model gives 0.5 to every document.
    """
    y = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))
    y = y.withColumn("fold", fold(F.col("doc_id"))).filter("fold > 0")
    rows = materialize(with_statistics(docs).join(y, "doc_id").select("doc_id", "fold", "stats", "y"), "quality-rows")
    n = rows.count()
    if not n:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    if n > fit_rows:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) < int(fit_rows / n * (1 << 40)))
    rows = materialize(rows.repartition(FIT_PARTITIONS), "quality-fit")
    moments = rows.select(*[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(N_STATS)]).first()
    mean, scale = (np.array([v or 0.0 for v in part]) for part in (moments[:N_STATS], moments[N_STATS:]))
    scale[scale < 1e-9] = 1.0

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, FEATURES + 1, FEATURES + 3))  # per fold: A, then b, then the number of rows
        for b in batches:
            phi, target, folds = features(_matrix(b.column(1)), mean, scale), b.column(2).to_numpy(), b.column(0).to_numpy()
            for k in range(FOLDS):
                own = folds == k + 1
                sums[k, :, :-2] += phi[own].T @ phi[own]
                sums[k, :, -2] += phi[own].T @ target[own]
                sums[k, 0, -1] += own.sum()
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    # At most FIT_PARTITIONS rows of one size, whatever the corpus.
    parts = [np.frombuffer(r.sums).reshape(FOLDS, FEATURES + 1, FEATURES + 3) for r in rows.select("fold", "stats", "y").mapInArrow(equations, "sums binary").collect()]
    sums = np.sum(parts, axis=0)

    def solve(s: np.ndarray) -> np.ndarray:
        penalty = np.eye(FEATURES + 1) * RIDGE * max(1.0, s[0, -1])
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(s[:, :-2] + penalty, s[:, -2])

    weights = solve(sums.sum(axis=0))
    # Each fold is scored by a model that has not seen it; the pairs calibrate.
    others = [solve(sums.sum(axis=0) - sums[k]) for k in range(FOLDS)]

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 2 * SCORE_STEPS + 1))
        for b in batches:
            raw = (features(_matrix(b.column(1)), mean, scale) @ np.array(others).T)[np.arange(b.num_rows), b.column(0).to_numpy() - 1]
            step = np.clip(np.rint((raw + 0.5) * SCORE_STEPS), 0, 2 * SCORE_STEPS).astype(int)
            np.add.at(seen[0], step, 1)
            np.add.at(seen[1], step, b.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()], pa.binary())], names=["seen"])

    seen = np.sum([np.frombuffer(r.seen).reshape(2, -1) for r in rows.select("fold", "stats", "y").mapInArrow(out_of_fold, "seen binary").collect()], axis=0)
    at = np.flatnonzero(seen[0])
    values = isotonic(seen[1, at] / seen[0, at], seen[0, at])
    return Model(mean, scale, weights, at / SCORE_STEPS - 0.5, np.clip(values, 0, 1))


def with_score(docs: DataFrame, model: Model, name: str = "score", text_column: str = "text", keep_above: float | None = None) -> DataFrame:
    """docs with one more column, the score of the whole text; with keep_above, only rows of that score or more.

    Rows are neither moved nor joined, so nulls, repeats and further columns pass as they
    are; a column of docs with the score's name is replaced. An empty table stays empty.
    """
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*kept).schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = np.array([statistics(t.as_py()) for t in b.column(b.num_columns - 1)], dtype=float).reshape(-1, N_STATS)
            score = model.score(stats)
            out = pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64())], names=[*kept, name])
            yield out if keep_above is None else out.filter(pa.array(score >= keep_above))

    return docs.select(*kept, whole_text(text_column).cast("binary").alias("__text_bytes")).mapInArrow(run, schema)
