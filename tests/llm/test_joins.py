"""Operators 1 and 9, and connected components, against brute force."""

import math
import random

import numpy as np
import pytest
from brute import components, jaccard_links
from conftest import SF001

from tracklake.llm import metric_join, ngram_join, suite
from tracklake.llm.components import connected


def check_join(got, rows, k, num, den):
    """rows: (doc_id, text) with distinct doc_ids in ascending order."""
    sets, links = jaccard_links([t for _, t in rows], k, num, den)
    root = components(len(rows), links)
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i, (doc_id, _) in enumerate(rows):
        assert by[doc_id]["n_shingles"] == len(sets[i])
        assert by[doc_id]["component_id"] == rows[root[i]][0], doc_id


def test_ngram_query_equals_brute_force(spark):
    docs = suite.table(spark, SF001, "documents")
    check_join(suite.op1_ngram_join(spark, SF001).collect(), sorted((r["doc_id"], r["text"]) for r in docs.collect()), 3, 90, 100)


def noisy_copies(seed, groups=6, copies=30, words=60):
    rng = random.Random(seed)
    texts = []
    passage = " ".join(f"p{i}" for i in range(30))
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own) + (f" {passage}" if g % 2 else ""))
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    texts += ["a", "a", "A", "a b", "a b c", "A B  C", "", "  ", None, "a\x1cb c d"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("frequent", "paired", "block"), [(32, 32, 500_000), (2, 4, 4_000), (0, 1, 500)])
@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 8, 10), (1, 1, 2)])
def test_ngram_join_of_near_copies(spark, monkeypatch, frequent, paired, block, k, num, den):
    """Also where every shingle is frequent, every token is tied and clusters
    fall into many blocks: the links stay the same."""
    monkeypatch.setattr(ngram_join.frequent_shingles, "__defaults__", (frequent, ngram_join.LIST))
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = noisy_copies(1 + k)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_join(ngram_join.components(docs, k, num, den).collect(), rows, k, num, den)


def test_list_of_frequent_shingles_is_bounded(spark):
    words = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(i, f"{words} {words if i % 2 else ''} v{i % 3}") for i in range(40)], "doc_id long, text string")
    everything, same = ngram_join.frequent_shingles(docs, 1, 1, 200)
    assert same == 1 and 10 < len(everything) < 60  # the lower quarter of the hash range
    some, limit = ngram_join.frequent_shingles(docs, 1, 1, len(everything) - 1)
    assert limit > 1 and len(some) < len(everything) and set(some.tolist()) <= set(everything.tolist())


def test_ngram_join_odd_rows(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (4, "q r s t"), (4, "q r s t"), (7, None), (None, None), (9, "z z z z")]
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t in rows], "doc_id long, text string, set_id string, cluster string")
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs, 3, 9, 10).collect()), key=str)
    assert got == sorted([(-1, 2, 4), (-1, 2, 4), (4, 2, 4), (4, 2, 4), (4, 2, 4), (7, 0, 7), (-1, 0, None), (9, 1, 9)], key=str)
    kept = ngram_join.one_of_each(docs, 3, 9, 10)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert len(left) == 4 + (len({r["text"] for r in left if r["doc_id"] == 4}) - 1)
    assert ngram_join.components(docs.where("false")).count() == 0
    assert ngram_join.one_of_each(docs.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = components(500, [e for e in edges if None not in e])
    assert got == {n: root[n] for e in edges if None not in e for n in e}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def check_vectors(got, rows, threshold=0.93):
    ids = [r[0] for r in rows]
    n, links, count = len(rows), [], [0] * len(rows)
    for i in range(n):
        for j in range(i + 1, n):
            (_, x, p), (_, y, q) = rows[i], rows[j]
            if p is None or p != q or x is None or y is None or len(x) != len(y):
                continue
            if any(v is None or not math.isfinite(v) for v in [*x, *y]) or not any(x) or not any(y):
                continue
            x, y = np.asarray(x, float), np.asarray(y, float)
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    root = components(n, links)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(
        (ids[i], count[i], ids[root[i]], root[i] == i) for i in range(n)
    )
    return links


def test_embedding_query_equals_brute_force(spark):
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in suite.table(spark, SF001, "embeddings").collect())
    check_vectors(suite.op9_embedding_dedup(spark, SF001).collect(), rows)


@pytest.mark.parametrize(("cell", "block"), [(2048, 2048), (12, 5), (4, 1000)])
def test_vectors_in_many_cells(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "BLOCK", block)
    rng = np.random.default_rng(cell)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(4)
            for _ in range(8):
                v = (centre + rng.standard_normal(4) * 0.25).astype(np.float32).tolist()
                rows += [(v, label)] * (1 + int(rng.integers(0, 5) == 0))
    rows += [([0.0] * 4, 0), ([1.0, None, 0.0, 0.0], 0), ([float("nan")] * 4, 1), ([float("inf"), 0, 0, 0], 1), (None, 1), ([], 1)]
    rows += [([1.0, 0.0], 0), ([1.0, 0.0], 0), ([-0.0, 2.0], 0), ([0.0, 2.0], 0), ([1e30, 1e30], 1), ([2e30, 2e30], 1)]
    rows = [(i, [None if x is None else float(x) for x in v] if v is not None else None, k) for i, (v, k) in enumerate(rows)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    exact = [(r["vec_id"], r["embedding"], r["label"]) for r in table.orderBy("vec_id").collect()]
    assert len(check_vectors(metric_join.near_duplicates(table).collect(), exact)) > 100
    assert metric_join.near_duplicates(table.where("false")).count() == 0


def test_repeated_and_null_vector_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (None, [1.0, 0.01], 0), (None, None, 0)]
    got = metric_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    key = lambda r: (str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"])
    assert sorted(map(key, got)) == [("1", 0, "1", True), ("1", 2, "1", True), ("1", 2, "1", True), ("None", 0, "None", False), ("None", 2, "1", False)]
