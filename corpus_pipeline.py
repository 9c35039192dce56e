"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and rereads it as the next stage's ``docs``. All stages but the
last return the columns of ``documents``, with what they decide applied:

1. ``quality``: documents that the classifier rejects go;
2. ``near_duplicates``: one document of each group of near copies stays
   (five-word shingles, Jaccard 0.8), the one with the smallest doc_id;
3. ``personal_data``: personal data and the terms that reveal it are replaced
   in ``text``, and ``n_chars`` follows the new text;
4. ``mix``: documents are repeated or left out so that sources meet their
   target weights, in a global shuffle (repeats keep their doc_id);
5. ``tokens``: every text is encoded to byte-BPE ids and decoded again.

Null texts count as empty; the stages state what else they do with odd input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import bpe, mixing, ngram_join, pii, quality
from tracklake.llm.common import materialize
from tracklake.llm.suite import BYTE_BPE, table, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, size=5, num=8, den=10)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    unlike = "_".join(["spans", *docs.columns])  # the name of no column
    out = pii.sanitise(docs, unlike).drop(unlike)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep_clashing=True)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = vocabulary(BYTE_BPE)
    out = bpe.round_trip(docs.select("doc_id", "source", "text"), path, digest="ids_sha256")
    return out.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("personal_data", personal_data_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

#: SQL can't express the classifier, the encoder or the clustering; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
