"""Chat formatting from reply trees (operator 6).

Messages form trees by their parent. Iterative self-joins with doubled steps
(a message's ancestor 1, 2, 4, ... replies up) give each message its depth and
the score of the path down to it, and list the messages of every root-to-leaf
path chosen. Branches are ranked by path score within their tree, and each
chosen path is formatted as one conversation. Paths of n messages take about
2 log2(n) joins over ids; texts join once.

Template: a turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts
a backslash is put between ``<`` and ``|`` (and one more where some stand there
already), so no control string can come from data; reading takes one out again.
In roles a line end is written ``\\n`` and a backslash ``\\b``.

Results on odd input: a null role or text is empty; a message whose parent is
unknown, or that takes part in a reply circle, belongs to no tree and is left
out; equal scores rank by the smaller leaf id; an empty table gives an empty
one. Message ids must differ within a tree; ``turn_messages`` numbers them, so
repeated rows of a turn table become turns one after the other. Extra columns
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(?=\\*\|)", r"<\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(?=\\*\|)", "<")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def turn_messages(turns: DataFrame) -> DataFrame:
    """Messages of a linear chat: each turn answers the one before it."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    msg = (F.row_number().over(w) - F.lit(1)).cast("long")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("msg_id", msg)
    return rows.select(
        F.col("conv_id").alias("tree_id"),
        "msg_id",
        F.when(F.col("msg_id") > 0, F.col("msg_id") - 1).alias("parent_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1.0).alias("score"),
    )


def _climb(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and path score of each message in a tree, and for k = 0, 1, ...
    the table (message, its ancestor 2^k replies up)."""
    step = materialize(
        messages.select("tree_id", "msg_id", F.col("parent_id").alias("up"), F.lit(1).alias("depth"), F.col("score").alias("path_score")),
        "reply-steps",
    )
    jumps = []
    longest = messages.count()
    while not (open_ := step.where("up IS NOT NULL")).isEmpty() and 2 ** len(jumps) <= longest:
        jumps.append(open_.select("tree_id", "msg_id", "up"))
        above = step.select(
            F.col("tree_id").alias("a_tree"), F.col("msg_id").alias("a_id"), F.col("up").alias("a_up"),
            F.col("depth").alias("a_depth"), F.col("path_score").alias("a_score"),
        )
        closed = step.where("up IS NULL")
        # An inner join: a message whose ancestor is unknown has no path to a root.
        moved = open_.join(above, F.col("tree_id").eqNullSafe(F.col("a_tree")) & (F.col("up") == F.col("a_id"))).select(
            "tree_id", "msg_id", F.col("a_up").alias("up"),
            (F.col("depth") + F.col("a_depth")).alias("depth"), (F.col("path_score") + F.col("a_score")).alias("path_score"),
        )
        step = materialize(closed.unionAll(moved), "reply-steps")
    return step.where("up IS NULL").drop("up"), jumps


def best_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of each tree (None: all): tree_id,
    path_rank, leaf_id, path_score, msg_id, place (0 at the root).

    Input: tree_id, msg_id, parent_id, score; a null score counts as 0."""
    ids = materialize(
        messages.select("tree_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score")), "reply-trees"
    )
    placed, jumps = _climb(ids)
    parents = ids.where("parent_id IS NOT NULL").select(F.col("tree_id").alias("p_tree"), F.col("parent_id").alias("p_id")).distinct()
    leaves = placed.join(
        parents, F.col("tree_id").eqNullSafe(F.col("p_tree")) & (F.col("msg_id") == F.col("p_id")), "left_anti"
    )
    rank = Window.partitionBy("tree_id").orderBy(F.desc("path_score"), "msg_id")
    ranked = leaves.withColumn("path_rank", F.row_number().over(rank))
    if keep is not None:
        ranked = ranked.where(F.col("path_rank") <= keep)
    paths = ranked.select("tree_id", "path_rank", F.col("msg_id").alias("leaf_id"), "path_score", "msg_id", F.col("depth").alias("below"))
    for k in reversed(range(len(jumps))):
        up = jumps[k].select(F.col("tree_id").alias("j_tree"), F.col("msg_id").alias("j_id"), "up")
        higher = paths.join(up, F.col("tree_id").eqNullSafe(F.col("j_tree")) & (F.col("msg_id") == F.col("j_id"))).select(
            "tree_id", "path_rank", "leaf_id", "path_score", F.col("up").alias("msg_id"), (F.col("below") - F.lit(2**k)).alias("below")
        )
        paths = materialize(paths.unionAll(higher), "reply-paths")
    return paths.withColumn("place", F.col("below") - 1).drop("below")


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: tree_id, path_rank, n_turns, formatted and loss_spans
    (start and end code points of the assistant texts in ``formatted``)."""
    texts = messages.select(
        F.col("tree_id").alias("m_tree"), F.col("msg_id").alias("m_id"),
        F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n")).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"), (F.coalesce("role", F.lit("")) == "assistant").alias("learn"),
    )
    turns = paths.join(texts, F.col("tree_id").eqNullSafe(F.col("m_tree")) & (F.col("msg_id") == F.col("m_id")))
    listed = turns.groupBy("tree_id", "path_rank").agg(
        F.array_sort(F.collect_list(F.struct("place", "head", "body", "learn"))).alias("turns")
    )
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate(
        "turns",
        start,
        lambda a, t: F.struct(
            (a["at"] + F.length(t["head"]) + F.length(t["body"]) + F.lit(len(END))).alias("at"),
            F.when(
                t["learn"],
                F.array_append(
                    a["spans"],
                    F.struct(
                        (a["at"] + F.length(t["head"])).alias("start"),
                        (a["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"),
                    ),
                ),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return listed.select("tree_id", "path_rank", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), spans.alias("loss_spans"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        body = F.substring(p, F.length(role) + F.lit(2), F.length(p) - F.length(role) - F.lit(1 + len(END)))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + F.lit(1), s["end"] - s["start"]))), ""
    )
