"""Short codes for integer vectors, by exact matrix products (operator 11).

A product quantiser in whole numbers. Components become ``floor(scale * x)``,
vectors are cut into equal parts, and each part position has a codebook whose
entries move for a fixed number of rounds from the parts of the smallest ids to
``floor(sum / count)`` of the parts that chose them.

The squared distance of a part x to an entry c is ``x.x - 2 x.c + c.c``. The
dot products run as float64 BLAS products and are exact: every integer is
broken into a low limb of ``LIMB`` bits and a signed high one, so that products
of limbs, summed over a part, stay below 2^53; the four products are recombined
in int64. The first of the least distances is the code. The sums of a round are
products as well, of the parts' limbs with a matrix that marks who chose what.

Vectors stay in Spark. A round is one job: a task adds up its rows in int64 and
emits ``parts * entries * (1 + part length)`` numbers, Spark sums these by
partial aggregation, and the driver gets one such table (1,152 numbers for 64
dimensions). All sums are integers, so partitions do not matter.

Results on odd input: rows whose vector is null, empty or holds null, NaN or
infinity are dropped, and so are vectors whose length differs from the most
frequent one that can be cut into equal parts (ties: the shorter). Null ids are
kept and come last, after those the order is by the vector itself, so equal ids
and equal rows are defined. Fewer rows than entries make a shorter codebook, an
empty table makes an empty result. Components too large for exact distances in
int64 (beyond 2^15 at 64 dimensions and scale 4096) raise ``OverflowError``
before anything is computed. Other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import clear_others, find_package_on_workers, materialize

#: Bits of the low limb. A limb is below 2^16 in size, so sums of products stay
#: below 2^53 for up to 2^21 terms.
LIMB = 16
#: Largest component, so that the high limb has at most ``LIMB`` bits as well.
LARGEST = 1 << 31
#: Labels whose sums are broadcast; beyond, they are joined by shuffle.
BROADCAST_LABELS = 100_000

SUMS = "part int, entry int, place int, total long"


def limbs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low limb of int64 numbers, as float64: x = high * 2^LIMB + low."""
    return (x >> LIMB).astype(np.float64), (x & ((1 << LIMB) - 1)).astype(np.float64)


def exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y`` (or a stack of such products) of int64 matrices, in int64, by
    float64 products of limbs. Needs components below ``LARGEST`` and at most
    2^(53 - 2 * LIMB) terms a sum, and a result that int64 holds."""
    if x.shape[-1] > 1 << (53 - 2 * LIMB):
        raise OverflowError("too many terms for exact products")
    (xh, xl), (yh, yl) = limbs(x), limbs(y)
    whole = lambda a: a.astype(np.int64)
    middle = whole(xh @ yl) + whole(xl @ yh)
    return (whole(xh @ yh) << (2 * LIMB)) + (middle << LIMB) + whole(xl @ yl)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the first of equals, and its squared
    distance, for parts ``x`` (parts, rows, length) and ``books`` (parts,
    entries, length); both results are (parts, rows)."""
    scores = (books * books).sum(2)[:, None, :] - 2 * exact_product(x, books.transpose(0, 2, 1))
    code = scores.argmin(2)
    error = np.take_along_axis(scores, code[:, :, None], 2)[:, :, 0] + (x * x).sum(2)
    return code, error


def chosen_sums(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """(parts, entries, 1 + length): how many parts chose each entry, then the
    sums of their components."""
    marks = (code[:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)
    return np.concatenate([marks.sum(2)[:, :, None], exact_product(marks, x)], 2)


def _parts(column: pa.Array, parts: int, length: int) -> np.ndarray:
    """(parts, rows, length) of a column of integer lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, length).transpose(1, 0, 2)


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part position: (parts, entries, length) of int64."""

    entries: np.ndarray

    @property
    def dimensions(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The vector that a code stands for."""
        chosen = bytes.fromhex(code)
        return [int(v) for p, e in enumerate(chosen) for v in self.entries[p, e]]


def integer_vectors(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", scale: int = 4096, parts: int = 8
) -> tuple[DataFrame, int]:
    """(vec_id, label, values) of the rows with a whole vector, written as a
    table, and their length (0 where there is none)."""
    v = F.col(vector)
    whole = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    good = df.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & F.forall(v, whole))
    largest: Column = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    shapes = good.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("top"))
    best = shapes.orderBy(F.desc("n"), "d").first()
    d = best["d"] if best else 0
    if best:
        top = int(best["top"]) * scale + scale
        if top >= LARGEST or d * (2 * top) ** 2 >= 1 << 63:
            raise OverflowError(f"components up to {best['top']} are too large for exact distances")
    kept = good.where(F.size(v) == d).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("int")).alias("values"),
    )
    return materialize(kept, "integer-vectors"), d


def first_entries(kept: DataFrame, d: int, parts: int, entries: int) -> Codebooks:
    """The parts of the smallest ids."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "values").select("values").limit(entries).collect()
    x = np.array([r["values"] for r in rows], np.int64).reshape(len(rows), parts, -1 if rows else 0)
    return Codebooks(np.ascontiguousarray(x.transpose(1, 0, 2)))


def _round_sums(kept: DataFrame, books: Codebooks) -> np.ndarray:
    """``chosen_sums`` over the whole table."""
    b = books.entries
    parts, entries, length = b.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        sums = np.zeros((parts, entries, 1 + length), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _parts(batch.column(0), parts, length)
                sums += chosen_sums(x, nearest(x, b)[0], entries)
        at = np.nonzero(sums)
        cols = [pa.array(a.astype(np.int32)) for a in at] + [pa.array(sums[at])]
        yield pa.RecordBatch.from_arrays(cols, names=["part", "entry", "place", "total"])

    found = kept.select("values").mapInArrow(run, SUMS).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
    out = np.zeros((parts, entries, 1 + length), np.int64)
    for r in found.collect():  # at most parts * entries * (1 + length) rows
        out[r["part"], r["entry"], r["place"]] = r["total"]
    return out


def improve(kept: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """``rounds`` rounds of choosing and averaging; unused entries stay."""
    find_package_on_workers(kept.sparkSession)
    for _ in range(rounds):
        sums = _round_sums(kept, books)
        n = sums[:, :, :1]
        books = Codebooks(np.where(n > 0, sums[:, :, 1:] // np.maximum(n, 1), books.entries))
    return books


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): the entries chosen, two hex digits a part,
    and the squared distance to the vector they stand for."""
    find_package_on_workers(kept.sparkSession)
    b = books.entries
    parts, _, length = b.shape
    schema = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = nearest(_parts(batch.column(2), parts, length), b)
            text = code.T.astype(np.uint8).tobytes().hex()
            codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error.sum(0))],
                names=["vec_id", "label", "code", "error"],
            )

    return kept.select("vec_id", "label", "values").mapInArrow(run, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of ``error`` over equal labels, nulls together. The sums of
    up to ``BROADCAST_LABELS`` labels are broadcast; more labels than that meet
    the rows by a shuffle, which Spark splits where one label is hot."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    few = sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    sums = F.broadcast(sums) if few else sums
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]), "left").drop("_label")


def compress(
    df: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """Codes of all whole vectors, (vec_id, label, code, error, label_error),
    and the codebooks they refer to; at most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept, d = integer_vectors(df, vector, vec_id, label, scale, parts)
    books = first_entries(kept, d, parts, entries)
    if d:
        books = improve(kept, books, rounds)
        coded = encode(kept, books)
    else:
        coded = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    return with_label_error(materialize(coded, "vector-codes")), books
