"""N-gram Jaccard join by grouped prefixes (operator 1).

Documents with equal shingle sets count once. In one global order of shingles,
two sets whose Jaccard similarity reaches ``num / den`` share a shingle of
their prefixes, the first ``n - ceil(n * num / den) + 1`` shingles. Sets with
the same prefix and size form a group; groups that share a prefix shingle are
paired and filtered by size, by the place of their last common shingle and by
the number of common ones; the groups left are expanded and their members
verified on whole sets.

Order: shingles in the lower quarter of the hash range that at most
``frequent`` documents hold, then the upper three quarters, then the frequent
ones, each by hash. The counts cover all documents. The list of frequent
shingles is bounded: where it would pass ``LIST`` entries the threshold
doubles until it fits. Any order gives the same links.

A shingle shared by many groups is not paired out: all its groups are tied to
the smallest. Tied and paired groups make clusters, so every link lies within
one; clusters are verified as blocks of bounded size against each other, in
bands of sizes that can match, and a block yields only the links that span it. Links
between blocks meet in connected components.

Results on odd input: a null text, or one without words, has an empty set and
links with nothing; a text of fewer words than a shingle has its whole sequence
as one; rows with equal doc_id count each by their text; a null doc_id takes
part and names no component (null if there is no other); an empty table gives
an empty one. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm.common import clear_others, find_package_on_workers, map_rows, materialize
from tracklake.llm.components import connected
from tracklake.llm.shingles import shingle_sets

#: Shingles in more documents than this are frequent; most frequent ones listed.
FREQUENT, LIST = 32, 2_000_000
#: Members of all groups that share a shingle, up to which groups are paired out.
PAIRED = 32
#: A block of a cluster holds about so many shingles, counting ``SET_WEIGHT``
#: more for each set: some 900 short sets, fewer long ones.
BLOCK, SET_WEIGHT = 500_000, 400
#: Most documents to verify that are named to all tasks; more are joined by shuffle.
NAMED = 500_000
_LOW = 1 << 62


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (128-bit hash of the set; null if empty)."""

    def make():
        def apply(texts):
            sets = shingle_sets(texts, size)
            ids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            return [len(s) for s in sets], ids

        return apply

    outputs = [("n_shingles", T.LongType(), pa.int64()), ("set_id", T.BinaryType(), pa.binary())]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_rows(rows, ["text"], outputs, make).drop("text")


def frequent_shingles(docs: DataFrame, size: int, more_than: int = FREQUENT, most: int = LIST) -> tuple[np.ndarray, int]:
    """The shingles of the lower quarter of the hash range that more than the
    returned number of documents hold, sorted.

    Tasks send the quarter's shingles of 256 documents at a time, packed by
    hash range; a range is counted in one task."""
    spark = docs.sparkSession
    find_package_on_workers(spark)
    parts = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = np.uint64(-(-_LOW // parts))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        for whole in batches:
            rows: dict[str, list] = {"part": [], "tokens": [], "counts": []}
            for lo in range(0, whole.num_rows, 256):
                sets = shingle_sets(whole.slice(lo, 256).column(0).to_pylist(), size)
                low = np.concatenate([s[: np.searchsorted(s, np.uint64(_LOW))] for s in sets])
                tokens, counts = np.unique(low, return_counts=True)
                cuts = np.searchsorted(tokens, np.arange(parts + 1, dtype=np.uint64) * width).tolist()
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if b > a:
                        c = counts[a:b]
                        rows["part"].append(p)
                        rows["tokens"].append(tokens[a:b].tobytes())
                        rows["counts"].append(None if c.max() == 1 else c.astype("<u2").tobytes())
            yield pa.RecordBatch.from_pydict(
                rows, pa.schema([("part", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
            )

    packed = docs.select("text").mapInArrow(pack, "part long, tokens binary, counts binary")
    dealt = packed.repartition("part").sortWithinPartitions("part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part, tokens, counts):
            all_tokens, all_counts = np.concatenate(tokens), np.concatenate(counts)
            order = np.argsort(all_tokens, kind="stable")
            all_tokens, all_counts = all_tokens[order], all_counts[order]
            first = np.flatnonzero(np.concatenate(([True], all_tokens[1:] != all_tokens[:-1])))
            totals = np.add.reduceat(all_counts, first)
            keep = totals > more_than
            return pa.RecordBatch.from_arrays(
                [pa.array(all_tokens[first][keep].view(np.int64)), pa.array(totals[keep])], names=["token", "n"]
            )

        now, tokens, counts = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != now:
                    if tokens:
                        yield done(now, tokens, counts)
                    now, tokens, counts = row["part"], [], []
                tokens.append(np.frombuffer(row["tokens"], np.uint64))
                c = row["counts"]
                counts.append(np.ones(len(tokens[-1]), np.int64) if c is None else np.frombuffer(c, "<u2").astype(np.int64))
        if tokens:
            yield done(now, tokens, counts)

    counted = materialize(dealt.mapInArrow(count, "token long, n long"), "frequent-shingles")
    while counted.where(F.col("n") > more_than).count() > most:
        more_than *= 2
    got = counted.where(F.col("n") > more_than).select("token").toArrow().column(0).to_numpy()
    return np.sort(got.astype(np.int64).view(np.uint64)), more_than


def prefix_length(n: int, num: int, den: int) -> int:
    return n + 1 - -(-n * num // den)


def prefix(s: np.ndarray, frequent: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first shingles of a sorted set in the global order."""
    length = prefix_length(len(s), num, den)
    cut = int(np.searchsorted(s, np.uint64(_LOW)))
    low = s[:cut]
    at = np.minimum(np.searchsorted(frequent, low), max(len(frequent) - 1, 0))
    often = frequent[at] == low if len(frequent) else np.zeros(cut, bool)
    rare = low[~often]
    if len(rare) >= length:
        return rare[:length]
    return np.concatenate([rare, s[cut:], low[often]])[:length]


def prefix_rows(docs: DataFrame, size: int, frequent: np.ndarray, num: int, den: int) -> DataFrame:
    """set_id, n, group_id and prefix of each document with a set."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)  # at most LIST numbers

    def make():
        def apply(texts):
            sets = shingle_sets(texts, size)
            firsts = [prefix(s, held.value, num, den) for s in sets]
            ids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            groups = [xxhash.xxh3_64_intdigest(f.tobytes(), len(s)) - (1 << 63) for s, f in zip(sets, firsts, strict=True)]
            ends = np.cumsum([0] + [len(f) for f in firsts])
            flat = np.concatenate([*firsts, np.zeros(0, np.uint64)]).view(np.int64)
            return ids, [len(s) for s in sets], groups, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

        return apply

    outputs = [
        ("set_id", T.BinaryType(), pa.binary()), ("n", T.IntegerType(), pa.int32()),
        ("group_id", T.LongType(), pa.int64()), ("prefix", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    ]
    return map_rows(docs.select("text"), ["text"], outputs, make).drop("text").where("set_id IS NOT NULL")


def _ceil_share(n: Column, num: int, den: int) -> Column:
    return F.floor((n * F.lit(num) + F.lit(den - 1)) / F.lit(den))


def group_links(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``a``-``b`` of groups that tie every two groups which may hold a
    linked pair. ``groups``: group_id, n, members, prefix."""
    index = groups.select("group_id", "n", "members", F.posexplode("prefix").alias("place", "token"))
    # Counted by token and joined on: a token's rows need not meet in one task's window.
    counted = index.groupBy("token").agg(F.count(F.lit(1)).alias("sharing"), F.sum("members").alias("weight"), F.min("group_id").alias("least"))
    shared = materialize(index.join(counted.where("sharing > 1"), "token"), "shared-prefixes")
    often = shared.where(F.col("weight") > PAIRED)
    few = shared.where(F.col("weight") <= PAIRED)
    # Frequent tokens of a group, which the pairs below do not count.
    beside = often.groupBy("group_id").agg(F.count(F.lit(1)).alias("beside"))
    side = few.join(beside, "group_id", "left").select(
        "token", "group_id", "n", "place", F.coalesce("beside", F.lit(0)).alias("beside")
    )
    a, b = side.alias("a"), side.alias("b")
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    pairs = (
        a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.group_id") < F.col("b.group_id")))
        .where(small * F.lit(den) >= large * F.lit(num))
        .groupBy(F.col("a.group_id").alias("a"), F.col("b.group_id").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("common"), F.max("a.place").alias("place_a"), F.max("b.place").alias("place_b"),
            F.max("a.n").alias("n_a"), F.max("b.n").alias("n_b"), F.least(F.max("a.beside"), F.max("b.beside")).alias("beside"),
        )
    )
    # Fewest common shingles: |x and y| >= num / (num + den) * (|x| + |y|).
    need = F.floor(((F.col("n_a") + F.col("n_b")) * F.lit(num) + F.lit(num + den - 1)) / F.lit(num + den))
    n_a, n_b = F.col("n_a"), F.col("n_b")
    rest = lambda n: _ceil_share(n, num, den) - F.lit(1)  # noqa: E731  shingles behind the prefix
    common = F.col("common") + F.col("beside")
    by_count = common + F.greatest(rest(n_a), rest(n_b))
    # All common shingles up to the last common one are counted, or are frequent.
    by_place = common + F.least(n_a - F.col("place_a"), n_b - F.col("place_b")) - F.lit(1)
    left = pairs.where((by_count >= need) & (by_place >= need)).select("a", "b")
    return left.unionAll(often.select(F.col("group_id").alias("a"), F.col("least").alias("b")))


def _spanning(sets: list[np.ndarray], left: int, num: int, den: int, within: bool) -> list[int]:
    """For each set the first set of its component, over the links between the
    first ``left`` sets and the rest, or among all if ``within``."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    used = np.flatnonzero(counts > 1)  # a shingle of one set is common to none
    column = np.full(len(tokens), -1)
    column[used] = np.arange(len(used))
    column = column[at]
    rows = slice(0, len(sets)) if within else slice(0, left)
    cols = slice(0, len(sets)) if within else slice(left, len(sets))
    common = np.zeros((rows.stop - rows.start, cols.stop - cols.start), np.float32)
    for lo in range(0, len(used), 4096):
        pick = (column >= lo) & (column < lo + 4096)
        grid = np.zeros((len(sets), min(4096, len(used) - lo)), np.float32)
        grid[owner[pick], column[pick] - lo] = 1
        common += grid[rows] @ grid[cols].T
    union = sizes[rows, None] + sizes[None, cols] - common
    linked = den * common.astype(np.float64) >= num * union.astype(np.float64)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(rows.stop - rows.start):
        for j in np.flatnonzero(linked[i]).tolist():
            a, b = find(i), find(j + cols.start)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def verified_links(docs: DataFrame, members: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Links ``a``-``b`` between set ids that span the components of each
    cluster. ``members``: cluster, n, set_id, doc_id of the sets to compare."""
    # Sizes in bands: a linked pair lies in one band or in two that follow.
    if num < den:
        band = F.floor(F.log("n") / F.lit(math.log(den / num) * (1 + 1e-9)))
    else:
        band = F.col("n")
    banded = materialize(members.withColumn("band", band.cast("long")), "cluster-members")
    weights = banded.groupBy("cluster", "band").agg(F.sum(F.col("n") + F.lit(SET_WEIGHT)).alias("weight"))
    parts = weights.select("cluster", "band", F.ceil(F.col("weight") / BLOCK).alias("parts"))
    number = lambda sub: F.shiftleft(F.col("band"), 32) + sub
    spans = banded.join(parts, ["cluster", "band"]).withColumn("block", number(F.pmod(F.xxhash64("set_id"), F.col("parts"))))
    blocks = parts.select("cluster", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"))
    blocks = blocks.select("cluster", "band", number(F.col("sub")).alias("block"))
    first = blocks.select("cluster", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("block").alias("x"))
    jobs = first.join(blocks.withColumnRenamed("block", "y"), ["cluster", "band"]).where("x <= y").select("cluster", "x", "y")
    ends = jobs.select("cluster", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    wanted = materialize(spans.join(ends, ["cluster", "block"]).select("doc_id", "set_id", "cluster", "x", "y", "block"), "sets-to-compare")
    keyed = wanted.groupBy(F.col("doc_id").alias("w_doc"), F.col("set_id").alias("w_set")).agg(
        F.collect_set(F.struct("cluster", "x", "y", "block")).alias("jobs")
    )
    if wanted.count() <= NAMED:
        keyed = F.broadcast(keyed)
    texts = docs.select("doc_id", "text").join(keyed, F.col("doc_id").eqNullSafe(F.col("w_doc")))

    def make():
        def apply(texts, ids):
            sets = shingle_sets(texts, size)
            return ([s.tobytes() if xxhash.xxh3_128_digest(s.tobytes()) == bytes(i) else None for s, i in zip(sets, ids, strict=True)],)

        return apply

    sets = map_rows(texts, ["text", "w_set"], [("tokens", T.BinaryType(), pa.binary())], make).drop("text")
    dealt = sets.where("tokens IS NOT NULL").select(F.col("w_set").alias("set_id"), "tokens", F.explode("jobs").alias("job")).select(
        "job.cluster", "job.x", "job.y", "job.block", "set_id", "tokens"
    )

    def compare(table: pa.Table) -> pa.Table:
        clear_others()
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        held: dict[bytes, tuple[int, np.ndarray]] = {}
        for block, i, raw in zip(*(table.column(c).to_pylist() for c in ("block", "set_id", "tokens")), strict=True):
            held[i] = (block, np.frombuffer(raw, np.uint64))
        ids = sorted(held, key=lambda i: (held[i][0], i))
        left = sum(held[i][0] == x for i in ids)
        roots = _spanning([held[i][1] for i in ids], left, num, den, x == y)
        made = [(ids[i], ids[r]) for i, r in enumerate(roots) if i != r]
        return pa.table({"a": pa.array([m[0] for m in made], pa.binary()), "b": pa.array([m[1] for m in made], pa.binary())})

    return dealt.groupBy("cluster", "x", "y").applyInArrow(compare, "a binary, b binary")


def components(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id and component_id of every row of ``docs``.

    Two documents link when ``den * |both| >= num * |either|`` over their
    distinct shingles of ``size`` words; the component is named by its smallest
    doc_id. Rows with equal sets always share a component."""
    rows = materialize(set_rows(docs, size), "shingle-sets")
    frequent, _ = frequent_shingles(docs, size)
    prefixes = prefix_rows(docs, size, frequent, num, den)
    sets = materialize(prefixes.groupBy("set_id").agg(F.first("n").alias("n"), F.first("group_id").alias("group_id"), F.first("prefix").alias("prefix")), "set-prefixes")
    groups = sets.groupBy("group_id", "n").agg(F.count(F.lit(1)).alias("members"), F.first("prefix").alias("prefix"))
    links = materialize(group_links(groups, num, den), "group-links")
    # Groups of two sets or more are a cluster by themselves.
    alone = sets.groupBy("group_id").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select(F.col("group_id").alias("a"), F.col("group_id").alias("b"))
    clusters = connected(links.unionAll(alone)).select(F.col("node").alias("group_id"), F.col("component").alias("cluster"))
    named = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    members = sets.select("set_id", "n", "group_id").join(clusters, "group_id").join(named, "set_id").select("cluster", "n", "set_id", "doc_id")
    spanning = materialize(verified_links(docs, members, size, num, den), "set-links")
    joined = connected(spanning).select(F.col("node").alias("c_set"), F.col("component").alias("c_root"))
    # Name each component by its smallest doc_id, over one row per set.
    rooted = named.join(joined, F.col("set_id") == F.col("c_set"), "left").select("set_id", F.coalesce("c_root", "set_id").alias("root"), "doc_id")
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_set = rooted.join(names, "root").select(F.col("set_id").alias("k_set"), "component_id")
    named_rows = rows.where("set_id IS NOT NULL").join(by_set, F.col("set_id") == F.col("k_set")).drop("k_set")
    return named_rows.unionByName(rows.where("set_id IS NULL").withColumn("component_id", F.col("doc_id")))



def one_of_each(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, at ties
    the smallest text hash. Rows without words, and rows of components that
    have no doc_id, all stay. Only the keys of rows that go meet the texts."""
    found = components(docs, size, num, den).where("set_id IS NOT NULL AND component_id IS NOT NULL")
    found = found.groupBy("component_id", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    found = materialize(found, "near-duplicates")
    first = found.where("doc_id = component_id").groupBy("component_id").agg(F.min("text_hash").alias("first_hash"))
    ranked = found.join(first, "component_id")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    key = [F.col("doc_id").alias("k_doc"), F.col("text_hash").alias("k_hash")]
    gone = materialize(ranked.where(~stays).select(*key), "rows-that-go")
    repeated = materialize(ranked.where(stays & (F.col("rows") > 1)).select(*key), "rows-that-repeat")
    out = _by_key(docs, gone.unionAll(repeated), "left_anti")
    if not repeated.isEmpty():
        out = out.unionByName(_by_key(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
    return out


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    if keys.count() <= NAMED:
        keys = F.broadcast(keys)
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["k_doc"]) & (F.xxhash64(docs["text"]) == keys["k_hash"]), how)
