"""Merkle manifest of a dataset with resumable parents (operator 12).

Every row is a leaf, the digest of its fields. The rows of a tree (a language)
are ranked; while a tree has several nodes, every ``FAN`` consecutive ones
become the digest of their digests as hex text. The roots of the trees, in the
order of their names, are the leaves of one more tree, whose root stands for
the dataset.

A parent retains copies of its SHA-256 state, one taken before each child slot.
Folding a replaced child to the root copies the state of its slot and hashes
the replacement and the right siblings only; left siblings are never hashed
again. States live in the task that folds, digests are what tables hold.

Trees are built and folded in blocks of ``FAN ** LEVELS`` consecutive nodes (512), a
block a group, whatever a tree's size: bottom up, blocks give the nodes of the
next layer until one node is left; top down, each block passes its nodes the
path (slots and runs of siblings) from them to the root; the blocks of the
lowest layer fold their leaves. No group is larger than a block and its path,
and no task and no driver holds a tree. Texts are hashed where they are read and
never move.

Results on odd input: a null field counts as ``-``; a null tree name is a tree,
the first; null ids come first; equal ids are ordered by their leaves, so equal
rows are defined; an empty table gives an empty result. A tree of one leaf is
that leaf. Other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import clear_others, find_package_on_workers, materialize
from tracklake.operators.ordered import exact_rank

#: Children of a parent, and levels of a block.
FAN, LEVELS = 8, 3
#: Trees whose list is broadcast; beyond, it is joined by shuffle.
BROADCAST_TREES = 100_000

PATH = "array<struct<slot: int, run: string>>"
NODES = "tree long, place long, node string"


def field(c: str | Column) -> Column:
    """A value as it enters a leaf: ``-``, or its bytes' count, ``:``, itself."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: str | Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _hex(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


class Block:
    """The tree over a block's nodes, ``levels`` high: runs of siblings by
    level, and each parent's states before its slots."""

    def __init__(self, nodes: list[str], levels: int) -> None:
        self.runs: list[list[list[str]]] = []
        self.states: list[list[list]] = []
        self.nodes = nodes
        for _ in range(levels):
            self.runs.append([self.nodes[i : i + FAN] for i in range(0, len(self.nodes), FAN)])
            self.states.append([])
            self.nodes = [self._parent(run) for run in self.runs[-1]]

    def _parent(self, run: list[str]) -> str:
        state, before = hashlib.sha256(), []
        for child in run:
            before.append(state.copy())
            state.update(child.encode())
        self.states[-1].append(before)
        return state.hexdigest()

    def path(self, place: int) -> list[tuple[int, str]]:
        """(slot, digests of the run) from a node up to the block's root."""
        out = []
        for runs in self.runs:
            place, slot = divmod(place, FAN)
            out.append((slot, "".join(runs[place])))
        return out

    def fold(self, place: int, node: str, known: dict) -> str:
        """The block's root with ``node`` put at ``place``: each parent goes
        on from its state there. ``known`` remembers parents of equal children."""
        for level, runs in enumerate(self.runs):
            place, slot = divmod(place, FAN)
            key = level, place, slot, node
            if (found := known.get(key)) is None:
                found = known[key] = resumed(self.states[level][place][slot], node, "".join(runs[place][slot + 1 :]))
            node = found
        return node


def resumed(state, node: str, right: str) -> str:
    """A parent's digest from its state before a slot on."""
    after = state.copy()
    after.update(node.encode())
    after.update(right.encode())
    return after.hexdigest()


def siblings(path: list[tuple[int, str]]) -> str:
    """The digests beside a path, level by level, left to right."""
    return "".join(run[: 64 * slot] + run[64 * (slot + 1) :] for slot, run in path)


class Above:
    """The path from a block's root to the root of all, with the states of its
    parents before their slots."""

    def __init__(self, path: list[tuple[int, str]]) -> None:
        self.steps = [(hashlib.sha256(run[: 64 * slot].encode()), run[64 * (slot + 1) :]) for slot, run in path]
        self.known: dict[str, str] = {}

    def fold(self, node: str) -> str:
        if (found := self.known.get(node)) is None:
            found = node
            for state, right in self.steps:
                found = resumed(state, found, right)
            self.known[node] = found
        return found


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / F.lit(FAN**LEVELS)))


def _levels(layer: int) -> Column:
    """How many levels a block of a layer has: ``LEVELS``, fewer at the top."""
    return F.greatest(F.least(F.col("height") - layer * LEVELS, F.lit(LEVELS)), F.lit(0)).cast("int")


def _next_layer(nodes: DataFrame, layer: int) -> DataFrame:
    """(tree, height, place, node) of the blocks' roots."""
    schema = "tree long, height int, place long, node string"

    def root(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["place"].to_pylist(), group["node"].to_pylist(), strict=True))
        top = Block([n for _, n in rows], group["levels"][0].as_py()).nodes
        cols = [[group[c][0].as_py()] for c in ("tree", "height", "block")] + [top]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["tree", "height", "place", "node"])

    blocks = _blocks(nodes).select("tree", "height", "place", "node", "block", _levels(layer).alias("levels"))
    return blocks.groupBy("tree", "block").applyInArrow(root, schema)


def layers(leaves: DataFrame, tallest: int) -> list[DataFrame]:
    """The nodes of a forest layer by layer, from ``leaves`` (tree, height,
    place, node) to the roots; ``tallest`` is the largest height."""
    find_package_on_workers(leaves.sparkSession)
    out = [leaves]
    for layer in range(max(1, -(-tallest // LEVELS))):
        out.append(materialize(_next_layer(out[-1], layer), "merkle-layer"))
    return out


def _paths(nodes: DataFrame, layer: int, above: DataFrame) -> DataFrame:
    """(tree, place, path) of each node of a layer to the root of all, from the
    paths ``above`` (tree, place, path) of its blocks."""
    schema = f"tree long, place long, path {PATH}"

    def extend(group: pa.Table) -> pa.Table:
        rows, top, levels = _opened(group)
        block = Block([r[1] for r in rows], levels)
        paths = [[{"slot": s, "run": r} for s, r in block.path(i) + top] for i in range(len(rows))]
        return pa.Table.from_arrays(
            [pa.array([group["tree"][0].as_py()] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array(paths, _PATH)],
            names=["tree", "place", "path"],
        )

    return _with_above(nodes, layer, above).groupBy("tree", "block").applyInArrow(extend, schema)


_PATH = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.string())]))


def _with_above(nodes: DataFrame, layer: int, above: DataFrame) -> DataFrame:
    """The nodes by block, and one row more for each block: its path."""
    extra = [c for c in nodes.columns if c not in ("tree", "height", "place", "node")]
    rows = _blocks(nodes).select(
        "tree", "block", "place", "node", _levels(layer).alias("levels"), F.lit(None).cast(PATH).alias("path"), *extra
    )
    types = {f.name: f.dataType for f in nodes.schema.fields}
    paths = above.select(
        "tree", F.col("place").alias("block"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("node"),
        F.lit(None).cast("int").alias("levels"), "path", *[F.lit(None).cast(types[c]).alias(c) for c in extra],
    )
    return rows.unionByName(paths)


def _opened(group: pa.Table, *more: str) -> tuple[list[tuple], list[tuple[int, str]], int]:
    """The nodes of a block in order with other columns, its path, its levels."""
    names = ("place", "node", "levels", "path", *more)
    rows, top = [], []
    for r in zip(*(group[n].to_pylist() for n in names), strict=True):
        if r[0] is None:
            top = [(s["slot"], s["run"]) for s in r[3]]
        else:
            rows.append(r)
    rows.sort(key=lambda r: r[0])
    return rows, top, rows[0][2]


def _folded(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, proof_sha256, folded_root) of every leaf."""
    schema = "tree long, doc_id long, leaf string, proof_sha256 string, folded_root string"

    def fold(group: pa.Table) -> pa.Table:
        clear_others()
        rows, top, levels = _opened(group, "doc_id", "changed")
        block, outside, beside, known = Block([r[1] for r in rows], levels), Above(top), siblings(top), {}
        proofs, roots = [], []
        for place, r in enumerate(rows):
            proofs.append(_hex(siblings(block.path(place)) + beside))
            roots.append(outside.fold(block.fold(place, r[5] or r[1], known)))
        n = len(rows)
        return pa.Table.from_arrays(
            [
                pa.array([group["tree"][0].as_py()] * n, pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows]),
                pa.array(proofs),
                pa.array(roots),
            ],
            names=["tree", "doc_id", "leaf", "proof_sha256", "folded_root"],
        )

    return _with_above(leaves, 0, above).groupBy("tree", "block").applyInArrow(fold, schema)


def _join_trees(rows: DataFrame, trees: DataFrame, on: Column, few: bool) -> DataFrame:
    return rows.join(F.broadcast(trees) if few else trees, on)


def manifest(rows: DataFrame) -> DataFrame:
    """(name, doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)
    of ``rows`` (name: the tree's name, doc_id, leaf, changed: the leaf of the
    row as found, null where it is the same)."""
    spark: SparkSession = rows.sparkSession
    find_package_on_workers(spark)
    ranked = exact_rank(rows, ["name"], ["doc_id", "leaf", "changed"], "rank")  # checkpointed within
    sizes = ranked.groupBy("name").agg(F.max("rank").alias("n"))
    trees = materialize(
        exact_rank(sizes, [], ["name"], "rank").select(
            (F.col("rank") - 1).alias("tree"), "name", "n", _height_of(F.col("n")).alias("height")
        ),
        "merkle-trees",
    )
    facts = trees.agg(F.count(F.lit(1)).alias("n"), F.max("height").alias("tallest")).first()
    n_trees, tallest = facts["n"], facts["tallest"] or 0
    few = n_trees <= BROADCAST_TREES
    named = _join_trees(ranked.alias("r"), trees.alias("t"), F.col("r.name").eqNullSafe(F.col("t.name")), few)
    leaves = named.select("tree", "height", (F.col("rank") - 1).alias("place"), F.col("leaf").alias("node"), "doc_id", "changed")
    forest = layers(leaves, tallest)
    subroots = forest[-1].select("tree", F.col("node").alias("subroot"))
    crown_leaves = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(height(n_trees)).alias("height"), F.col("tree").alias("place"), F.col("subroot").alias("node")
    )
    crown = layers(crown_leaves, height(n_trees))
    root = crown[-1].select("node").first()  # one row: the root of all
    # Down again: through the crown to each tree's root, through its layers to the leaves.
    above = crown[-1].select("tree", "place", F.array().cast(PATH).alias("path"))
    for layer in reversed(range(len(crown) - 1)):
        above = materialize(_paths(crown[layer].select("tree", "height", "place", "node"), layer, above), "merkle-paths")
    above = above.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "path")
    for layer in reversed(range(1, len(forest) - 1)):
        above = materialize(_paths(forest[layer], layer, above), "merkle-paths")
    folded = _folded(leaves, above)
    found = _join_trees(
        folded.alias("f"), trees.join(subroots, "tree").select("tree", "name", "subroot").alias("t"), F.col("f.tree") == F.col("t.tree"), few
    )
    top = F.lit(root["node"] if root else None).cast("string")
    return found.select(
        "name", "doc_id", "leaf", "subroot", top.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == top).alias("verified")
    )


def _height_of(n: Column) -> Column:
    """``height`` as an expression: the least h with FAN ** h >= n."""
    powers = [FAN**h for h in range(22) if FAN**h < 1 << 63]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n)).cast("int")


def lower_ascii(c: str | Column) -> Column:
    return F.translate(F.col(c) if isinstance(c, str) else c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """``manifest`` of documents, a tree for each lang; rows where ``tampered``
    holds are folded with their text lower-cased."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    rows = docs.select(
        F.col("lang").cast("string").alias("name"), F.col("doc_id").cast("long").alias("doc_id"), leaf(*fields, "text").alias("leaf"),
        F.when(tampered, leaf(*fields, lower_ascii("text"))).alias("changed"),
    )
    return manifest(rows).drop("name")
