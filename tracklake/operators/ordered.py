"""Ordered per-group computations that stay bounded when one group is huge.

Spark evaluates ``Window.partitionBy(k).orderBy(t)`` with every row of a key
in one task. A track (scenario, object) or a cluster may hold a large share of
all rows, so the operators here split such groups:

* ``lag_columns`` / ``running_sum``: the window runs per chunk of the order
  key (``timestep_chunk`` steps); one small per-chunk table, built with
  partial aggregation straight from the input, carries the boundary value
  across chunks. Exact, and one plan whatever the values: the carry holds only
  chunks that follow another one, so it is empty where tracks fit one chunk.
* ``exact_rank``: row number within a group by a total order, computed from a
  range-partitioned, checkpointed sort (a hot group is spread over many
  partitions) plus per-partition offsets. Exact.
* ``top_n_per_group``: a quantile summary of each group gives a cut-off just
  above the n-th row; ``exact_rank`` ranks the rows below it, so rows that
  cannot be among the first n are not shuffled, and no task holds a group
  whatever n is.

Keys are not null (the contracts check it): a null key's chunks are not
carried over.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.session import ensure_checkpoint_dir
from tracklake.settings import DEFAULT, Settings

_CHUNK = "_chunk"


def _chunk_of(order_col: str, chunk: int) -> Column:
    return F.floor(F.col(order_col) / F.lit(chunk)).cast("bigint")


def _join_carry(inner: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of the chunked rows with the few chunks that follow another
    one. The rows already lie by (keys, chunk), so only the carry moves."""
    on = [*keys, _CHUNK]
    r = carry.select(*[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in carry.columns if c not in on])
    joined = inner.join(r, on=[inner[k] == r[f"_r_{k}"] for k in on], how="left")
    return joined.select(*[inner[c] for c in inner.columns], *[r[c] for c in carry.columns if c not in on])


def lag_columns(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    cols: Sequence[str],
    prefix: str = "prev_",
    settings: Settings = DEFAULT,
    tails_from: DataFrame | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Add ``prefix + c``: the value of ``c`` on the previous row of the group,
    or with ``among`` on the previous row for which it holds.

    Equal to ``lag(c) over (partition by keys order by order_col)``. The
    window runs per (keys, chunk); the last row of every chunk is carried to
    the next non-empty chunk of its group. ``tails_from`` may name a cheaper
    frame with the same distinct rows to take the chunk ends from.
    """
    keys = list(keys)
    chunked = df.withColumn(_CHUNK, _chunk_of(order_col, settings.timestep_chunk))
    row = F.struct(*[F.col(c) for c in cols])
    w = Window.partitionBy(*keys, _CHUNK).orderBy(order_col)
    if among is None:
        last = F.lag(row).over(w)
    else:
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        last = F.last(F.when(among, row), ignorenulls=True).over(earlier)
    inner = chunked.select("*", last.alias("_last"))
    # One row per chunk that has such a row: its last one, by partial
    # aggregation of a fixed-width buffer per column (no sort).
    source = (df if tails_from is None else tails_from).withColumn(_CHUNK, _chunk_of(order_col, settings.timestep_chunk))
    if among is not None:
        source = source.where(among)
    tails = source.groupBy(*keys, _CHUNK).agg(
        *[F.max_by(F.col(c), F.coalesce(F.col(order_col), F.lit(0))).alias(f"_tail_{c}") for c in cols]
    )
    # A row of another chunk takes the end of the last chunk before it. The
    # ends of all chunks of a track lie in one small window partition.
    if among is None:
        wc = Window.partitionBy(*keys).orderBy(_CHUNK)
        carry = tails.select(
            *keys, _CHUNK, F.lag(F.struct(*[F.col(f"_tail_{c}").alias(c) for c in cols])).over(wc).alias("_carry")
        )
    else:
        chunks = (df if tails_from is None else tails_from).select(*keys, _chunk_of(order_col, settings.timestep_chunk).alias(_CHUNK)).distinct()
        ends = tails.select(*keys, _CHUNK, F.struct(*[F.col(f"_tail_{c}").alias(c) for c in cols]).alias("_end"))
        every = chunks.join(ends, on=[*keys, _CHUNK], how="left")
        wc = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = every.select(*keys, _CHUNK, F.last("_end", ignorenulls=True).over(wc).alias("_carry"))
    joined = _join_carry(inner, carry.where(F.col("_carry").isNotNull()), keys)
    prev = F.coalesce(F.col("_last"), F.col("_carry"))
    return joined.select(*[F.col(c) for c in df.columns], *[prev.getField(c).alias(f"{prefix}{c}") for c in cols])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    exprs: dict[str, Column],
    settings: Settings = DEFAULT,
    totals_from: tuple[DataFrame, dict[str, Column]] | None = None,
) -> DataFrame:
    """Add running sums (current row included) of ``exprs`` per group.

    Equal to ``sum(e) over (partition by keys order by order_col rows between
    unbounded preceding and current row)``; within a chunk the sum is the
    window's, across chunks the totals of earlier chunks are added.
    ``totals_from`` may name a cheaper frame, and expressions over it, with the
    same totals.
    """
    keys = list(keys)
    base = df.withColumn(_CHUNK, _chunk_of(order_col, settings.timestep_chunk))
    for name, e in exprs.items():
        base = base.withColumn(f"_v_{name}", e)
    w = Window.partitionBy(*keys, _CHUNK).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inner = base.select(
        "*", *[F.sum(f"_v_{n}").over(w).alias(f"_in_{n}") for n in exprs]
    )
    source, parts = (df, exprs) if totals_from is None else totals_from
    totals = source.groupBy(*keys, _chunk_of(order_col, settings.timestep_chunk).alias(_CHUNK)).agg(
        *[F.sum(e).alias(f"_t_{n}") for n, e in parts.items()]
    )
    wc = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        _CHUNK,
        F.count(F.lit(1)).over(wc).alias("_earlier"),
        *[F.sum(f"_t_{n}").over(wc).alias(f"_o_{n}") for n in exprs],
    ).where(F.col("_earlier") > 0)
    joined = _join_carry(inner, offsets, keys)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col(f"_o_{n}").isNull(), F.col(f"_in_{n}"))
            .when(F.col(f"_in_{n}").isNull(), F.col(f"_o_{n}"))
            .otherwise(F.col(f"_o_{n}") + F.col(f"_in_{n}"))
            .alias(n)
            for n in exprs
        ],
    )


def exact_rank(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    rank_col: str = "_rank",
    settings: Settings = DEFAULT,
) -> DataFrame:
    """1-based row number within each group by ``order_cols`` (a total order).

    The rows are range-partitioned and sorted on (group, order), which splits a
    hot group over many partitions, then checkpointed to the session's
    reliable checkpoint folder so partition ids and row positions are fixed.
    A row's rank is the number of its group's rows in earlier partitions plus
    its position among the group's rows in its own partition. The offsets
    table has at most (partitions + groups) rows, since every partition holds
    one contiguous key range.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = settings.rank_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(c) for c in group_cols] + order
    snap = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .checkpoint(eager=True)
    )
    # Checkpointed partitions keep their file order: the id is partition
    # index << 33 plus the row's position in its sorted partition.
    pos = snap.withColumn("_pos", F.monotonically_increasing_id()).withColumn(
        "_pid", F.shiftright("_pos", 33)
    )
    blocks = pos.groupBy("_pid", *group_cols).agg(
        F.min("_pos").alias("_first_pos"), F.count(F.lit(1)).alias("_n")
    )
    wb = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_pid",
        *group_cols,
        "_first_pos",
        F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_before"),
    )
    # At most (partitions + groups) rows: AQE broadcasts it when its measured
    # size is under the threshold and shuffles it otherwise (many groups).
    # Null-safe on the group columns: a NULL group is a group too.
    o = offsets.select(
        F.col("_pid").alias("_o_pid"),
        *[F.col(c).alias(f"_o_{c}") for c in group_cols],
        "_first_pos",
        "_before",
    )
    cond = [pos["_pid"] == o["_o_pid"]] + [pos[c].eqNullSafe(o[f"_o_{c}"]) for c in group_cols]
    ranked = pos.join(o, on=cond, how="inner")
    return ranked.select(
        *[pos[c] for c in df.columns],
        (F.col("_before") + F.col("_pos") - F.col("_first_pos") + 1).alias(rank_col),
    )


#: Shares of a group at which its cut-off may lie, and the rank error of the
#: quantile summary: 1 / accuracy of the group's rows.
_SHARES = [0.0005 * 1.25**i for i in range(34)]
_ACCURACY = 10_000


def order_number(df: DataFrame, column: str) -> Column:
    """A double that never falls as ``column`` rises: numbers themselves (NaN
    as the largest), strings by their first six bytes."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        digits = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    x = c.cast("double")
    return F.when(F.isnan(x), F.lit(sys.float_info.max)).otherwise(x)


def below_cut_off(
    df: DataFrame, group_cols: Sequence[str], order_col: str, n: int, few_groups: bool = False
) -> DataFrame:
    """The rows that can be among the first n of their group by ``order_col``
    (ascending, nulls first), and few others.

    A quantile summary of each group, merged from partial ones, gives a value
    that at least n rows do not exceed; rows above it go. The summary's rank is
    off by at most 1 / accuracy of the rows; three times that is allowed for.
    ``few_groups`` says that the groups are few enough to broadcast their
    cut-offs (one number each)."""
    keyed = df.withColumn("_x", order_number(df, order_col))
    summary = keyed.groupBy(*group_cols).agg(
        F.percentile_approx("_x", _SHARES, _ACCURACY).alias("_q"), F.count("_x").alias("_n")
    )
    sure = F.transform(
        F.array(*[F.lit(p - 3 / _ACCURACY) for p in _SHARES]), lambda p: p * F.col("_n") >= n
    )
    at = F.array_position(sure, True)
    cut = F.when(at > 0, F.element_at("_q", at.cast("int")))
    cuts = summary.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], cut.alias("_cut")).where("_cut IS NOT NULL")
    same = [keyed[c].eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]
    met = keyed.join(F.broadcast(cuts) if few_groups else cuts, same, "left")
    keep = F.col("_cut").isNull() | F.col("_x").isNull() | (F.col("_x") <= F.col("_cut"))
    return met.where(keep).select(*[keyed[c] for c in df.columns])


def top_n_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    n: int,
    settings: Settings = DEFAULT,
    few_groups: bool = False,
) -> DataFrame:
    """Rows with ``row_number() <= n`` within each group (a total order).

    Rows beyond a cut-off just above the n-th are dropped where they are read
    (``below_cut_off``); only the others are shuffled, and their rank is
    distributed, so no task holds a group whatever n is."""
    first = below_cut_off(df, group_cols, order_cols[0], n, few_groups)
    ranked = exact_rank(first, group_cols, order_cols, settings=settings)
    return ranked.where(F.col("_rank") <= n).drop("_rank")
