"""Mixing sources to target weights by Poisson replication (operator 7).

A source with target share w of the mix gets the mean repetition rate
``rate = w * total / documents of the source``. Each document draws its count
by inverting the Poisson distribution with that mean at a uniform number taken
from a hash of the seed and the document, so the count is a pure function of
the row: a recomputed task draws the same counts. Each document is exploded by
its count, and the copies are dealt to partitions and sorted by a hash of the
copy, which is a global shuffle.

A rate above ``STEP`` is drawn as the sum of independent draws of equal smaller
rates (a sum of Poisson numbers is one), as exp(-rate) would underflow.

Results on odd input: a null source is a source of its own; a null text or
doc_id hashes as absent; repeated rows draw equal counts; sources without a
weight, or with a weight of 0 or less, are left out when weights are given; an
empty table gives an empty mix. Columns of the input named ``copy`` or
``shuffle_key`` are replaced, or kept in place of those (``keep_clashing``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import materialize

#: Highest mean of one inversion.
STEP = 64.0
#: Terms of the distribution of a mean up to STEP; the rest is below 1e-15.
TERMS = 160
#: Bytes of a rate beside the name of its source: its distribution and numbers.
RATE_BYTES = 8 * TERMS + 64
#: Rates up to this many bytes are broadcast; beyond it documents join by shuffle.
BROADCAST_BYTES = 64 << 20


def uniform(digest: Column) -> Column:
    """A hex digest's first 13 digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson number as an array."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    more = F.when(mean > 0, F.sequence(F.lit(1), F.least(F.lit(TERMS), F.ceil(mean * 2 + 25).cast("int")))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        more,
        start,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.array_append(a["c"], F.element_at(a["c"], -1) + a["p"] * mean / k).alias("c"),
        ),
        lambda a: a["c"],
    )


def rates(docs: DataFrame, weights: dict | None = None, power: float = 0.5, ratio: float = 1.0) -> DataFrame:
    """One row per source: ``documents``, ``share`` of the mix and ``rate``.

    ``weights`` maps a source to its target weight. Without it the weight is
    the document count to the given ``power``, which lifts small sources.
    ``ratio`` is the size of the mix against the input."""
    counts = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count(F.lit(1)).alias("documents"))
    counts = materialize(counts, "mix-sources")  # one read of the documents, one row a source
    if weights is None:
        weight = F.pow(F.col("documents").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(name)), F.lit(float(max(w, 0.0)))).otherwise(weight)
    weighed = counts.withColumn("weight", weight)
    total = weighed.agg(F.sum("weight").alias("w"), F.sum("documents").alias("n")).first()
    w, n = float(total["w"] or 0.0), float(total["n"] or 0)
    share = F.col("weight") / F.lit(w) if w > 0 else F.lit(0.0)
    return weighed.select(
        "mix_source", "documents", share.alias("share"), (share * F.lit(n * ratio) / F.col("documents")).alias("rate")
    )


def replicate(
    docs: DataFrame, source_rates: DataFrame, seed: int = 42, doc_id: str = "doc_id", text: str = "text", keep_clashing: bool = False
) -> DataFrame:
    """The mix: all columns of ``docs``, ``copy`` (0, 1, ...) and
    ``shuffle_key``, in the order of a global shuffle. With ``keep_clashing``
    the columns of ``docs`` alone, whatever their names.

    The rates are one row a source. Up to ``BROADCAST_BYTES``, measured, they
    are broadcast and the texts move once, in the global shuffle; beyond it they
    join by shuffle, where Spark splits a hot source. The rows are the same."""
    names = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key") or keep_clashing]
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(STEP)).cast("int"))
    table = source_rates.select("mix_source", draws.alias("mix_draws"), cdf(F.col("rate") / draws).alias("mix_cdf"))
    size = F.sum(F.coalesce(F.octet_length("mix_source"), F.lit(0)) + F.lit(RATE_BYTES))
    if (source_rates.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(doc_id).cast("string"), F.md5(F.col(text))))
    whole = docs.select(F.struct(*names).alias("whole"), key.alias("mix_key"))
    joined = whole.join(table, F.col("whole.source").eqNullSafe(F.col("mix_source")))

    def inverse(k: Column) -> Column:
        u = F.when(k == 1, uniform(F.col("mix_key"))).otherwise(
            uniform(F.md5(F.concat_ws("|", F.col("mix_key"), k.cast("string"))))
        )
        return F.size(F.filter(F.col("mix_cdf"), lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("mix_draws")), F.lit(0), lambda a, k: a + inverse(k))
    copies = (
        joined.withColumn("mix_count", count)
        .where("mix_count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("mix_count") - 1)))
    )
    place = F.md5(F.concat_ws("|", F.col("mix_key"), F.lit("copy"), F.col("copy").cast("string")))
    dealt = copies.select("whole", "copy", place.alias("shuffle_key")).repartition("shuffle_key")
    ordered = dealt.sortWithinPartitions("shuffle_key", f"whole.{doc_id}", "copy")
    return ordered.select("whole.*") if keep_clashing else ordered.select("whole.*", "copy", "shuffle_key")


def mix(
    docs: DataFrame, weights: dict | None = None, power: float = 0.5, ratio: float = 1.0, seed: int = 42, keep_clashing: bool = False
) -> DataFrame:
    return replicate(docs, rates(docs, weights, power, ratio), seed, keep_clashing=keep_clashing)
