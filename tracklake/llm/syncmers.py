"""Document fingerprints from closed syncmers (operator 8).

Of all substrings of ``K`` code points, those whose smallest inner substring of
``S`` code points (by hash) lies at one edge are closed syncmers. The choice
looks at the substring alone, so equal passages give equal anchors wherever
they stand, and an edit changes only anchors that overlap it. Every run of
``K - S + 1`` substrings holds at least one anchor.

A fingerprint lists all anchors of the whole text in order, ``position`` and
32-bit hash; of a run of anchors with one hash (a text that repeats itself) the
first in each stretch of ``(K - S + 1) // 2`` code points is listed, about as
many as other text has. Texts under ``SHORT`` code points also list the closed
syncmers of the smaller ``FINE`` lengths, and texts under ``TINY`` each code
point with the one before it. The two low bits of a hash name its scheme (0 for
``K`` and ``S``, 1 fine, 2 tiny), and two fingerprints are compared by the
schemes that both texts list, so a text's length alone makes no copy unlike.
The likeness of two fingerprints is the Dice share of the anchors that match in
order: the longest common subsequence of their hashes.

Results on odd input: a null text is the empty text, whose fingerprint is the
empty string; two empty fingerprints have likeness 1, an empty and another 0;
rows with equal doc_id follow one another by text; null doc_ids come first; a
single document is followed by itself; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm.common import clean_text, clear_others, find_package_on_workers, map_rows, with_fields

K, S = 40, 8
#: (K, S) of short texts, and their length; the length of tiny ones.
FINE, SHORT, TINY = (8, 3), 256, 64
#: Documents of one range of doc_ids, about.
RANGE_ROWS = 4096

_MIX = tuple(np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))
_BASE = 0x100000001B3


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


def _windows(h: np.ndarray, width: int, wanted: int) -> np.ndarray:
    """Hashes of all windows of ``wanted`` code points from those of ``width``,
    by doubling: a window's hash is its left part's times a power plus its right's."""
    while width * 2 <= wanted:
        h = h[: len(h) - width] * np.uint64(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    if width < wanted:
        # Overlapping halves still name the window: its first and last ``width``.
        step = wanted - width
        h = _mixed(h[: len(h) - step]) * _MIX[2] + h[step:]
    return h


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n, have = len(h) - width + 1, 1
    while have * 2 <= width:
        h = np.minimum(h[: len(h) - have], h[have:])
        have *= 2
    return np.minimum(h[:n], h[width - have : width - have + n])


def closed_syncmers(first: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes, from the hashes of the code points."""
    inner = _windows(first, 1, s)
    ranked = _mixed(inner)
    w = k - s + 1
    low = _smallest(ranked, w)
    at = np.flatnonzero((ranked[: len(low)] == low) | (ranked[w - 1 :] == low))
    return at, _mixed(_windows(inner, s, k)[at]) >> np.uint64(32)


def _thinned(at: np.ndarray, hashes: np.ndarray, step: int) -> np.ndarray:
    """Which anchors stay: the first of each stretch of ``step`` code points of
    a run with one hash, counted from the start of the run."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    starts = np.flatnonzero(fresh)
    stretch = (at - at[starts][np.cumsum(fresh) - 1]) // step
    fresh[1:] |= stretch[1:] != stretch[:-1]
    return fresh


def anchors(text: str) -> list[tuple[int, int]]:
    """(position, hash) of the text's anchors, in order."""
    n = len(text)
    if not n:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    first = _mixed(codes * _MIX[2])
    parts = []
    for scheme, (k, s), used in ((0, (K, S), n >= K), (1, FINE, FINE[0] <= n < SHORT)):
        if used:
            at, hashes = closed_syncmers(first, k, s)
            keep = _thinned(at, hashes, (k - s + 1) // 2)
            parts.append((at[keep], hashes[keep] & ~np.uint64(3) | np.uint64(scheme)))
    if n < TINY:
        before = np.concatenate((_MIX[:1], first[:-1]))  # a start mark, then the code points
        parts.append((np.arange(n), _mixed(before * _MIX[2] + first) >> np.uint64(32) & ~np.uint64(3) | np.uint64(2)))
    at, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(parts) > 1:
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
    return list(zip(at.tolist(), hashes.tolist(), strict=True))


def to_string(marks: list[tuple[int, int]]) -> str:
    """``position.hash`` in hexadecimal, comma-joined."""
    return ",".join([f"{p:x}.{h:08x}" for p, h in marks])


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    least, head, tail = min(len(a), len(b)), 0, 0
    while head < least and a[head] == b[head]:
        head += 1
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    shared = set(a).intersection(b)
    a, b = ([h for h in x if h in shared] for x in (a, b))
    places: dict[int, int] = {}
    for i, h in enumerate(b):
        places[h] = places.get(h, 0) | 1 << i
    every = (1 << len(b)) - 1
    left = every
    for h in a:
        met = left & places[h]
        left = (left + met | left - met) & every
    return head + tail + len(b) - left.bit_count()


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    if not a or not b:
        return float(not a and not b)
    if a == b:
        return 1.0
    # Every text of at least one code point has an anchor of its finest scheme.
    finest = [max(h & 3 for _, h in x) for x in (a, b)]
    both = min(finest)
    a, b = (x if f == both else [m for m in x if m[1] & 3 <= both] for x, f in zip((a, b), finest, strict=True))
    return 2.0 * common([h for _, h in a], [h for _, h in b]) / (len(a) + len(b))


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint string of ``text``."""
    def make():
        return lambda texts: ([to_string(anchors(t or "")) for t in texts],)

    return map_rows(df, [text], [(name, T.StringType(), pa.string())], make)


def range_starts(docs: DataFrame, doc_id: str = "doc_id", rows: int = RANGE_ROWS) -> list[int]:
    """Rising doc_ids that cut the table into ranges of about ``rows``
    documents: quantiles over all rows, at most 10,000 numbers."""
    n = docs.count()
    parts = min(10_000, -(-n // rows))
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    got = docs.agg(F.percentile_approx(doc_id, at, 100_000).alias("q")).first()["q"]
    return sorted({int(x) for x in got or []})


def range_of(key: Column, starts: list[int]) -> Column:
    """Number of ``starts`` at or below the key, by bisection; null: 0."""
    if not starts:
        return F.lit(0)
    table = F.from_json(F.lit(str(starts)), "array<bigint>")
    steps = len(starts).bit_length()
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(starts)).alias("hi")),
        lambda a, _: F.when(a["lo"] >= a["hi"], a)
        .when(
            F.element_at(table, F.floor((a["lo"] + a["hi"]) / 2).cast("int") + 1) <= key,
            F.struct((F.floor((a["lo"] + a["hi"]) / 2).cast("int") + 1).alias("lo"), a["hi"].alias("hi")),
        )
        .otherwise(F.struct(a["lo"].alias("lo"), F.floor((a["lo"] + a["hi"]) / 2).cast("int").alias("hi"))),
        lambda a: a["lo"],
    )
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def edited_text(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the next one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


COMPARED = [
    ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
    ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType()),
]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each document and its edited text (last quarter replaced by
    the start of the next document) and compare with it and with the next.

    Texts move once, to ranges of doc_id. The first document of a range is sent
    to the range before it as well, where it only follows the last one."""
    find_package_on_workers(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), clean_text(text).alias("text"))
    starts = range_starts(docs.select(doc_id), doc_id)
    # The document after the last is the first: of the smallest key, null before all.
    least = docs.agg(F.min(doc_id).alias("k"), F.count_if(F.col(doc_id).isNull()).alias("nulls")).first()
    is_first = F.col("doc_id").isNull() if least["nulls"] else F.coalesce(F.col("doc_id") == F.lit(least["k"]), F.lit(False))
    own = range_of(F.col("doc_id"), starts)
    begins = F.array_contains(F.from_json(F.lit(str(starts)), "array<bigint>"), F.col("doc_id")) if starts else F.lit(False)
    role = F.array_compact(
        F.array(
            F.struct(F.col("own").alias("range"), F.lit(0).alias("ahead")),
            F.when(F.col("begins"), F.struct((F.col("own") - 1).alias("range"), F.lit(1).alias("ahead"))),
            F.when(is_first, F.struct(F.lit(len(starts)).alias("range"), F.lit(2).alias("ahead"))),
        )
    )
    dealt = (
        rows.withColumn("own", own).withColumn("begins", F.coalesce(begins, F.lit(False)))
        .withColumn("to", F.explode(role))
        .select("doc_id", "text", F.col("to.range").alias("range"), F.col("to.ahead").alias("ahead"))
    )
    sorted_ = dealt.repartition(len(starts) + 1, "range").sortWithinPartitions("range", "ahead", "doc_id", "text")
    schema = with_fields(dealt.select("doc_id"), *COMPARED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        held, out = None, []  # the last document, which waits for the next one

        def compared(following: tuple) -> tuple:
            key, now, marks = held[1], held[2], held[3]
            edited = edited_text(now, following[2])
            edited_marks = marks if edited == now else anchors(edited)
            return (
                key, len(now), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_string(marks),
                to_string(edited_marks), likeness(marks, edited_marks), likeness(marks, following[3]),
            )

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for key, now, where, ahead in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    if ahead and (held is None or held[0] != where):
                        continue  # repeats of the first row ahead, or an empty range
                    row = (where, key, now, anchors(now))
                    if held is not None and held[0] == where:
                        out.append(compared(row))
                    held = None if ahead else row
                if len(out) >= 256:
                    yield _compared_batch(out, schema)
                    out = []
        if out:
            yield _compared_batch(out, schema)

    return sorted_.mapInArrow(run, schema)


def _compared_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())
