"""Quality classifier on random Fourier features (operator 2).

Each document becomes a row of statistics of its text (``STATS``). Random
Fourier features cos(w x + b) of the standardised statistics approximate a
Gaussian kernel; ridge regression on them is fitted from normal equations that
every partition sums over its own labelled rows and a tree of tasks adds up.
The raw scores are calibrated by isotonic regression. Sums are kept for each of
``FOLDS`` folds, so the calibration uses scores of models that did not see the
row. Nothing is sampled: all labelled rows outside the held-out fold take part.

The driver holds sums only: at most ``FOLDS`` matrices of ``FEATURES``
squared, and ``BINS`` bins of scores. Rows are never gathered.

Results on odd input: a null text is the empty text and has a score like any
other; a null doc_id counts as the empty string in the fold; null labels are
left out; several labels of one doc_id count as their mean; without labels, or
with labels of one kind, the score is the mean label (0.5 without any); an
empty table gives an empty one. Input columns named like output columns are
replaced; labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm.common import clear_others, find_package_on_workers, map_rows, materialize

STATS = (
    "log_chars", "log_words", "word_chars", "word_chars_dev", "upper_share", "digit_share", "space_share", "symbol_share",
    "other_share", "byte_entropy", "distinct_words", "top_word", "distinct_pairs", "repeat_words", "log_lines", "distinct_lines",
    "line_words", "ends_with_stop", "bang_share", "mark_words", "upper_words",
)
FEATURES, FOLDS, BINS, SEED = 192, 4, 2048, 20240611
#: Width of the Gaussian kernel over standardised statistics, and ridge weight per row.
WIDTH, RIDGE = 4.0, 1e-4
THRESHOLD = 0.3

_KIND = np.full(256, 5, np.int64)  # letters of other scripts: bytes from 128 on
for _k, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32))):
    _KIND[list(_bytes)] = _k
_KIND[[b for b in range(128) if _KIND[b] == 5]] = 4


def statistics(text: str) -> list[float]:
    """The ``STATS`` of one whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return [0.0] * len(STATS)
    counts = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=6) / len(raw)
    p = counts[counts > 0] / len(raw)
    words = text.split()
    n = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    marked = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:")
    shouted = sum(map(str.isupper, words))
    return [
        np.log1p(len(text)), np.log1p(len(words)), min(sizes.mean(), 50.0), min(sizes.std(), 50.0),
        kinds[0], kinds[2], kinds[3], kinds[4], kinds[5], float(-(p * np.log2(p)).sum()),
        len(seen) / n, max(seen.values(), default=0) / n, pairs / n, repeats / n,
        np.log1p(m), len(set(lines)) / m, np.log1p(len(words) / m), float(text.rstrip()[-1:] in tuple(".!?")),
        counts[33] / len(raw) * 10, marked / n, shouted / n,
    ]


def with_statistics(docs: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """Add the array of statistics of ``text``."""

    def make():
        return lambda texts: ([statistics(t or "") for t in texts],)

    return map_rows(docs, [text], [(name, T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))], make)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


@dataclass
class Model:
    """Standardisation, Fourier features, ridge weights and calibration knots."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = features(stats, self.mean, self.scale) @ self.weights
        return np.interp(raw, self.knots, self.values)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics; the first is 1."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((len(STATS), FEATURES - 1)) / WIDTH
    b = rng.uniform(0, 2 * np.pi, FEATURES - 1)
    x = np.clip((stats - mean) / scale, -8, 8)
    return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / (FEATURES - 1)) * np.cos(x @ w + b)])


def isotonic(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins that rise in score: mean score and
    mean label of each pool."""
    pools: list[list[float]] = []
    for s, y, n in zip(scores, labels, counts, strict=True):
        pools.append([s * n, y * n, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.asarray(pools)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Statistics, label and fold of up to 4096 rows at a time."""
    clear_others()
    for whole in batches:
        for lo in range(0, whole.num_rows, 4096):
            b = whole.slice(lo, 4096)
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))
            yield x, b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)


def tree_sum(parts: DataFrame, width: int = 16) -> np.ndarray | None:
    """Sum of the float64 arrays in the rows (part, packed), added up in tasks
    of about ``width`` arrays each until one task's worth is left."""
    rows = materialize(parts, "partial-sums")
    n = rows.count()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, least = None, None
        for b in batches:
            for part, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(packed)
                total, least = (x.copy(), part) if total is None else (total + x, min(least, part))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "packed"])

    while n > width:
        groups = -(-n // width)
        # Sorted by part within a task, so that the sum has one order.
        dealt = rows.repartitionByRange(groups, "part").sortWithinPartitions("part")
        rows = materialize(dealt.mapInArrow(add, "part long, packed binary"), "partial-sums")
        fewer = rows.count()
        if fewer >= n:
            break
        n = fewer
    total = None
    for r in rows.orderBy("part").collect():
        x = np.frombuffer(r["packed"])
        total = x.copy() if total is None else total + x
    return total


def fit(labelled: DataFrame) -> Model:
    """A model from rows (stats, label, fold 1 to FOLDS)."""
    find_package_on_workers(labelled.sparkSession)
    d = len(STATS)

    def moments(batches):
        from pyspark import TaskContext

        total = np.zeros(2 * d + 2)
        for x, y, _ in _blocks(batches):
            total += np.concatenate([x.sum(0), (x * x).sum(0), [len(x), y.sum()]])
        if total[-2]:
            yield _partial(TaskContext.get().partitionId(), total)

    total = tree_sum(labelled.mapInArrow(moments, "part long, packed binary"), width=64)
    if total is None or not 0 < total[-1] < total[-2]:
        y = 0.5 if total is None else float(total[-1] / total[-2])
        return Model(np.zeros(d), np.ones(d), np.zeros(FEATURES), np.zeros(1), np.full(1, y))
    n = total[-2]
    mean = total[:d] / n
    variance = np.maximum(total[d : 2 * d] / n - mean**2, 0)
    scale = np.where(variance > 1e-12, np.sqrt(variance), 1.0)
    upper = np.triu_indices(FEATURES)
    size = len(upper[0]) + FEATURES

    def equations(batches):
        from pyspark import TaskContext

        sums = np.zeros((FOLDS, size))
        for x, y, folds in _blocks(batches):
            z = features(x, mean, scale)
            for k in range(FOLDS):
                if (of := folds == k + 1).any():
                    sums[k] += np.concatenate([(z[of].T @ z[of])[upper], z[of].T @ y[of]])
        if sums.any():
            yield _partial(TaskContext.get().partitionId(), sums.ravel())

    sums = tree_sum(labelled.mapInArrow(equations, "part long, packed binary")).reshape(FOLDS, size)

    def solve(s: np.ndarray) -> np.ndarray:
        a = np.zeros((FEATURES, FEATURES))
        a[upper] = s[:-FEATURES]
        a = a + a.T - np.diag(np.diag(a))
        return np.linalg.solve(a + RIDGE * max(a[0, 0], 1.0) * np.eye(FEATURES), s[-FEATURES:])

    whole = sums.sum(0)
    others = np.stack([solve(whole - s) for s in sums])

    def binned(batches):
        out = np.zeros((BINS, 3))
        for x, y, folds in _blocks(batches):
            raw = (features(x, mean, scale) * others[folds.astype(int) - 1]).sum(1)
            at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            for k, v in enumerate((np.ones(len(raw)), y, raw)):
                out[:, k] += np.bincount(at, v, BINS)
        used = np.flatnonzero(out[:, 0])
        cols = [pa.array(used, pa.int64()), *(pa.array(out[used, k], pa.float64()) for k in range(3))]
        yield pa.RecordBatch.from_arrays(cols, names=["bin", "n", "y", "raw"])

    bins = labelled.mapInArrow(binned, "bin long, n double, y double, raw double").groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum("raw").alias("raw")
    )
    got = np.asarray([(r["bin"], r["n"], r["y"], r["raw"]) for r in bins.collect()])
    got = got[got[:, 0].argsort()]
    knots, values = isotonic(got[:, 3] / got[:, 1], got[:, 2] / got[:, 1], got[:, 1])
    return Model(mean, scale, solve(whole), knots, np.clip(values, 0.0, 1.0))


def _partial(part: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["part", "packed"]
    )


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """stats, label and fold of the labelled documents outside the held-out fold."""
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    marks = marks.where(fold() != 0)
    return stats.select("doc_id", "stats").join(marks, "doc_id").select("stats", "label", fold().cast("int").alias("fold"))


def score(docs: DataFrame, model: Model, stats: str = "stats") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on)."""

    def make():
        return lambda rows: (model.score(np.asarray(rows, np.float64).reshape(-1, len(STATS))).tolist(),)

    scored = map_rows(docs, [stats], [("score", T.DoubleType(), pa.float64())], make, rows=4096)
    return scored.withColumn("predicted", (F.col("score") >= F.lit(THRESHOLD)).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``."""
    stats = materialize(with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "doc-stats")
    model = fit(materialize(training_rows(stats, labels), "labelled-stats"))
    held = (fold() == 0).alias("held_out")
    return score(stats, model).select("doc_id", held, "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, all columns as they
    were. The statistics of a text are computed again while filtering, so the
    texts need no shuffle and no copy."""
    stats = materialize(with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "doc-stats")
    model = fit(materialize(training_rows(stats, labels), "labelled-stats"))

    def make():
        return lambda texts: ((model.score(np.asarray([statistics(t or "") for t in texts])) >= THRESHOLD).tolist(),)

    mark = "keep_" + format(zlib.crc32("|".join(docs.columns).encode()), "08x")  # unlike any input column
    return map_rows(docs, ["text"], [(mark, T.BooleanType(), pa.bool_())], make).where(F.col(mark)).drop(mark)
