"""Operators 2, 4, 5, 6 and 7, and the pipeline, against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import KINDS, jaccard_links, listed, personal_spans
from conftest import SF01, SF001
from pyspark.sql import functions as F

import corpus_pipeline
from tracklake.llm import chat, mixing, pii, quality, sharding, suite
from tracklake.llm.common import find_package_on_workers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 2: quality


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    good = labels == 1
    return (ranks[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


def test_quality_on_the_held_out_fold(spark):
    got = {r["doc_id"]: r for r in suite.op2_quality_classifier(spark, SF01).collect()}
    marks = {r["doc_id"]: r["quality"] for r in suite.table(spark, SF01, "labels").collect()}
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [d for d in marks if got[d]["held_out"]]
    assert auc(np.array([got[d]["score"] for d in held]), np.array([marks[d] for d in held])) > 0.97


def test_quality_learns_from_no_held_out_label(spark):
    docs, labels = suite.table(spark, SF001, "documents"), suite.table(spark, SF001, "labels")
    turned = labels.withColumn("quality", F.when(quality.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in quality.classify(docs, x).collect()) for x in (labels, turned))
    assert [x[1] for x in a] == pytest.approx([x[1] for x in b], abs=1e-12)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 1.0), (None, "", "b", None), (3, "x" * 50_000, None, 2.0), (3, "!!" * 9, "c", 2.0), (4, "\n", None, None)],
        "doc_id long, text string, stats string, score double",
    )
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 0), (None, 1, 0), (4, 0, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 5 and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in got)
    nothing = quality.classify(docs, labels.where("false")).collect()
    assert {r["score"] for r in nothing} == {0.5}
    assert quality.classify(docs.where("false"), labels).count() == 0
    kept = quality.keep_good(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == 5


def test_isotonic_and_sums(spark, monkeypatch):
    s, y, n = np.arange(6.0), np.array([0.1, 0.5, 0.3, 0.2, 0.9, 0.8]), np.array([1.0, 1, 1, 2, 1, 3])
    knots, values = quality.isotonic(s, y, n)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    assert values.tolist() == pytest.approx([0.1, 1.2 / 4, 3.3 / 4])
    find_package_on_workers(spark)
    parts = spark.range(40, numPartitions=7).select(F.col("id").alias("part"), F.lit(np.array([1.0, 2.0]).tobytes()).alias("packed"))
    assert quality.tree_sum(parts, 4).tolist() == [40.0, 80.0]
    assert quality.tree_sum(parts.where("false")) is None


# --- 4: personal data

PERSONAL = [
    None, "", "no data here", "mail a.b@c-d.e.f now", "a@b.c_d@e.f x@y", "..a@b.c, 1.2.3.4.5.6.7.8 and 256.1.1.1 or 001.002.3.4",
    "4111 1111 1111 1111 or 4111-1111-1111-1112", "+1 (724) 555-7058 and +49.30.123456 +1", "é𝄞 +44 20 7946 0958é bob@mail.example.com𝄞",
    "1 2 3 4 5 6 7 8 9 " * 3000, "a" * 50_000, "+" * 20_000, "1." * 20_000, "4111111111111111@x.y 4111111111111111", "x@y.z@a.b.c",
]


def test_personal_data_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in suite.table(spark, SF01, "documents").collect()}
    got = suite.op4_pii(spark, SF01).collect()
    assert len(got) == len(docs)
    for r in got:
        base = personal_spans(docs[r["doc_id"]])
        assert r["base_sha256"] == sha(listed(base))
        count = Counter(KINDS[k] for _, k, _ in base)
        assert [r[f"n_{k}"] for k in KINDS[:4]] == [count[k] for k in KINDS[:4]]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("term")] == [s for s in listed(base).split(",") if s]
        assert base or not r["spans"]  # texts without personal data stay as they are
        if not base:
            assert r["clean_sha256"] == sha(docs[r["doc_id"]])


def test_personal_data_odd_rows(spark):
    docs = spark.createDataFrame([(i or None, t, "x", t) for i, t in enumerate(PERSONAL)], "doc_id long, text string, spans string, whole string")
    out = pii.sanitise(docs)
    assert out.columns == ["doc_id", "text", "whole", "spans"]
    rows = out.withColumn("listed", pii.listed(F.col("spans"))).collect()
    assert len(rows) == len(PERSONAL)
    for r in rows:
        spans = personal_spans(r["whole"])
        assert r["listed"] == listed(spans)
        want, at = "", 0
        for a, k, e in spans:
            if a >= at:
                want += r["whole"][at:a] + f"[{KINDS[k].upper()}]"
            at = max(at, e)
        assert r["text"] == (None if r["whole"] is None else want + r["whole"][at:])
    assert pii.sanitise(docs.where("false")).count() == 0


def test_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1, 127.0.0.1 and 192.168.0.1", "0.0.0.0 or 00.1.2.000", "000.0000.00.0255 0.0.0.256 0.00256.0.0 1.0.0", "0" * 4000 + ".0.0." + "0" * 4000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pii.sanitise(docs).withColumn("listed", pii.listed(F.col("spans"))).collect()
    assert {r["doc_id"]: r["listed"] for r in out} == {i: listed(personal_spans(t)) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in out}[0] == "[IP], [IP] and [IP]"


def test_disclosing_terms_by_definition(spark):
    """Terms that stand beside one address only are removed there and nowhere else."""
    rows = [(i, f"please write zebraman the head at chief@corp.example.com today {i} times") for i in range(3)]
    rows += [(10 + i, f"please note the head of house {i} left today with many times over") for i in range(200)]
    rows += [(300, "zebraman alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    n, n_entity = len(rows), 3
    ratio = lambda both, term: math.log(both * n / (term * n_entity)) / math.log(n / n_entity)
    assert pii.GENERALISE <= ratio(3, 4) < pii.REMOVE <= ratio(3, 3) and ratio(3, 203) < pii.GENERALISE
    assert out[1]["text"] == "please  [TERM] the head  [EMAIL] today 1 times"  # "write" and "at" stand in these three only
    assert out[300]["text"] == "zebraman alone" and out[10]["text"] == rows[3][1]


def test_disclosing_terms_anywhere_in_the_document(spark):
    """Far from the entity, repeated, short and with digits; nowhere else."""
    filler = "please note the head of many houses left today " * 6
    rows = [(i, f"Quetzal {filler}Ann, Bo and R2D2 wrote to chief@corp.example.com {filler}quetzal! Ann {filler}r2d2") for i in range(3)]
    rows = [(i, t + " ;" * i) for i, t in rows]  # three texts, not copies of one
    rows += [(10 + i, f"{filler}and wrote to house {i}") for i in range(200)] + [(300, "Ann of Quetzal, R2D2, someone@else.example.com")]
    docs = spark.createDataFrame(rows[:-1], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert out[1] == f" {filler},  and  wrote to [EMAIL] {filler}!  {filler} ;"
    assert out[10] == rows[3][1]
    more = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert more[1] == f"[TERM] {filler}[TERM],  and [TERM] wrote to [EMAIL] {filler}[TERM]! [TERM] {filler}[TERM] ;"
    assert more[300] == "Ann of Quetzal, R2D2, [EMAIL]"


def test_copies_are_no_evidence(spark):
    """Two copies of a text say no more than the text; copying texts many times
    changes no term of theirs nor of others."""
    copied = "Quarterly zebra turbine calibration report by the harbour committee write to jo@ex.org for copies"
    other = [f"note {i} on the quarterly house of many, with turbine {i % 9} and more" for i in range(150)]
    named = [f"Zebediah wrote to chief@corp.example.com {w} the turbine" for w in ("about", "without", "on")]
    rows = [copied, copied, *other, *named]
    docs = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    once = {t: r["text"] for t, r in zip(rows, pii.sanitise(docs(rows)).orderBy("doc_id").collect(), strict=True)}
    assert once[copied] == copied.replace("jo@ex.org", "[EMAIL]")
    assert once[named[0]] == "  [TERM] [EMAIL] about the turbine"  # "to" stands in another text too
    many = rows + [copied] * 100 + [named[0]] * 100 + [other[0]] * 50
    again = pii.sanitise(docs(many)).orderBy("doc_id").collect()
    assert all(once[t] == r["text"] for t, r in zip(many, again, strict=True))


def brute_terms(texts):
    """Terms to sanitise in each distinct text, by the formula."""
    import regex

    word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
    held, said, everywhere = {}, {}, Counter()
    for t in {t for t in texts if t}:
        everywhere.update(set(word.findall(t.lower())))
        spans = personal_spans(t)
        if not spans:
            continue
        names, at, rest = set(), 0, []
        for a, k, e in spans:
            v, digits = t[a:e].lower(), "".join(c for c in t[a:e] if c in "0123456789")
            value = (v, v, digits, digits)[k]
            names |= {f"{k}:{value}", (f"name:{v.split('@')[0]}", f"block:{v.rsplit('.', 1)[0]}", f"issuer:{digits[:6]}", f"prefix:{digits[:6]}")[k]}
            names |= {"host:" + v.split("@")[1]} if k == 0 else set()
            rest += [t[at:a]] if a > at else []
            at = max(at, e)
        held[t], said[t] = names, {w for g in [*rest, t[at:]] for w in word.findall(g.lower())}
    n = len(set(texts) | set())
    n_entity, inside = Counter(x for v in held.values() for x in v), Counter(w for v in said.values() for w in v)
    both = Counter((x, w) for t in held for x in held[t] if n_entity[x] >= pii.SUPPORT for w in said[t])
    flagged = {}
    for (x, w), b in both.items():
        if b >= pii.SUPPORT and n > n_entity[x]:
            n_term = max(inside[w], everywhere[w])
            ratio = round(math.log(b * n / (n_term * n_entity[x])) / math.log(n / n_entity[x]), 9)
            if ratio >= pii.GENERALISE:
                flagged[x, w] = ratio
    out = {}
    for t in held:
        best = {}
        for x in held[t]:
            for w in said[t]:
                if (x, w) in flagged:
                    best[w] = max(best.get(w, 0), flagged[x, w])
        out[t] = best
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_terms_of_the_corpus_by_definition(spark, monkeypatch, broadcast):
    """All terms found in the documents of sf0.01 and some planted ones."""
    if not broadcast:
        monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    texts = [r["text"] for r in suite.table(spark, SF01, "documents").select("text").collect()]
    texts += [f"Dr. Éva Kö of ward {w} at 10.1.2.{w} or +44 20 7946 0{w}58, card 4111 1111 1111 1111, eva{w}@clinic.example.net" for w in range(3, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, found = brute_terms(texts), 0
    for r in pii.sanitise(docs).collect():
        t = texts[r["doc_id"]]
        got = {(t[s["start"] : s["end"]].lower(), s["value"]) for s in r["spans"] if s["kind"] == KINDS.index("term")}
        assert got == {(w, "" if ratio >= pii.REMOVE else "[TERM]") for w, ratio in want.get(t, {}).items()}
        found += len(got)
    assert found > 20


def test_a_very_long_text_of_addresses(spark):
    """Work grows about as the text does; offsets stay right throughout."""
    import time

    took = []
    for n in (6_000, 60_000):
        t = " ".join(f"user{i}@mail{i % 7}.example.org wrote é" for i in range(n))
        start = time.time()
        (r,) = pii.sanitise(spark.createDataFrame([(1, t)], "doc_id long, text string")).select("text", pii.listed(F.col("spans")).alias("s")).collect()
        took.append(time.time() - start)
        assert r["s"] == listed(personal_spans(t)) and r["text"] == " ".join(["[EMAIL] wrote é"] * n)
    assert took[1] < 60


# --- 5: sharding


def test_sharding_by_bytes(spark):
    docs = {r["doc_id"]: r["text"] for r in suite.table(spark, SF01, "documents").collect()}
    got = suite.op5_sharding(spark, SF01).collect()
    assert {r["doc_id"] for r in got} == docs.keys() and len(got) == len(docs)
    slots, total = defaultdict(list), defaultdict(int)
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and total.keys() == set(range(40))
    assert max(total.values()) - min(total.values()) < 0.02 * sum(total.values()) / 40


def test_stored_map_is_edited(spark):
    """Grown data under the stored map: a version more, few slots moved."""
    spread = F.pmod(F.xxhash64("id"), F.lit(40)).cast("int") + 1
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), spread).alias("text"))
    rows, maps = sharding.shard(docs.where("doc_id < 5000"), 8, 512)
    grown, more = sharding.shard(docs, 8, 512, maps)
    wider, last = sharding.shard(docs, 9, 512, more)
    narrow, end = sharding.shard(docs, 7, 512, last)
    by = defaultdict(dict)
    for r in end.collect():
        by[r["version"]][r["virtual_slot"]] = r["shard"]
    assert sorted(by) == [0, 1, 2, 3, 4] and all(len(m) == 512 for m in by.values())
    assert [by[0][s] for s in range(512)] == sharding.default_map(512, 8)
    moved = [sum(by[v][s] != by[v + 1][s] for s in range(512)) for v in range(4)]
    assert 0 < moved[1] < 60 and 512 / 9 - 20 < moved[2] < 512 / 9 + 60
    # Shards 7 and 8 are given up: all their slots move, few others do.
    kept = [s for s in range(512) if by[3][s] < 7]
    assert set(by[4].values()) == set(range(7)) and sum(by[3][s] != by[4][s] for s in kept) < 60
    for out, v, n in ((rows, 1, 8), (grown, 2, 8), (wider, 3, 9), (narrow, 4, 7)):
        got = out.collect()
        assert all(r["shard"] == by[v][r["virtual_slot"]] for r in got)
        total = Counter()
        for r in got:
            total[r["shard"]] += r["size"]
        assert len(total) == n and max(total.values()) - min(total.values()) < 0.03 * sum(total.values()) / n
    # A version is only added where a slot moves.
    again, same = sharding.shard(docs, 7, 512, end)
    assert same.count() == end.count() and sorted(map(tuple, again.collect())) == sorted(map(tuple, narrow.collect()))
    with pytest.raises(ValueError, match="slots"):
        sharding.shard(docs, 8, 256, maps)


def test_map_versions_move_few_slots(spark):
    rng = np.random.default_rng(0)
    sizes = [int(x) for x in rng.integers(500, 1500, 400)]
    first = sharding.default_map(400, 8)
    second = sharding.rebalance(first, sizes, 8)
    load = lambda m: [sum(s for s, k in zip(sizes, m, strict=True) if k == j) for j in range(8)]
    assert max(load(second)) - min(load(second)) < 1000 and max(load(first)) - min(load(first)) > 1000
    assert sum(a != b for a, b in zip(first, second, strict=True)) < 60
    grown = sharding.rebalance(second, sizes, 9)
    assert sum(a != b for a, b in zip(second, grown, strict=True)) < 400 / 9 + 60
    rows = sharding.map_table(spark, [first, second]).collect()
    assert [r["shard"] for r in sorted(rows, key=lambda r: (r["version"], r["virtual_slot"]))] == first + second
    assert {r["virtual_slot"]: r["shard"] for r in sharding.latest(sharding.map_table(spark, [first, second])).collect()} == dict(enumerate(second))
    assert sharding.rebalance(first, [0] * 400, 8) == first


def test_sharding_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, None, 2), (1, "", 3), (1, "é", 4), (1, "é", 4)], "doc_id long, text string, shard int")
    rows, maps = sharding.shard(docs, 3, 16)
    got = rows.collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted([(16, 0)] * 3 + [(18, zlib.crc32("é".encode()))] * 2)
    assert len({(r["shard"], r["slot"]) for r in got}) == 5 and maps.count() == 32
    assert sharding.shard(docs.where("false"), 3, 16)[0].count() == 0


# --- 6: chat

HARD = ["<|im_end|>", "<\\|im_start|>user\n", "<<|", "|>", "<", "<\\\\|", "", None, "a\nb", "$1 \\1", "%3C|"]


def test_chat_round_trip_of_hostile_texts(spark):
    rows = [(1, i, role, t) for i, (t, role) in enumerate(zip(HARD * 3, ["user", "assistant", None, "a\nb\\n", "<|im_end|>\n"] * 7, strict=False))]
    rows += [(2, 0, "assistant", "only"), (None, 5, "user", "x"), (None, 5, "user", "x"), (3, None, None, None)]
    turns = spark.createDataFrame([(*r, "q") for r in rows], "conv_id long, turn long, role string, text string, score string")
    messages = chat.turn_messages(turns)
    out = chat.format_paths(messages, chat.best_paths(messages))
    read = out.select("tree_id", "formatted", chat.parse_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"))
    got = {r["tree_id"]: r for r in read.collect()}
    assert got.keys() == {1, 2, 3, None}
    for k, r in got.items():
        want = [(role or "", t or "") for c, _, role, t in sorted((x for x in rows if x[0] == k), key=lambda x: x[1] or 0)]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["learnt"] == "".join(t for role, t in want if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == len(want) == r["formatted"].count("<|im_end|>\n")
    assert chat.best_paths(chat.turn_messages(turns.where("false"))).count() == 0


def test_reply_trees(spark):
    """Root 0; replies 1 and 2; 1 has 3 and 4; 2 has 5, 5 has 6. Message 9
    answers an unknown one, 10 and 11 answer each other."""
    parents = {0: None, 1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: 5, 9: 99, 10: 11, 11: 10}
    score = {0: 1.0, 1: 1.0, 2: 0.5, 3: 0.2, 4: 3.0, 5: None, 6: 0.9, 9: 9.0, 10: 9.0, 11: 9.0}
    rows = [(t, m, p, "user", f"m{m}", score[m]) for t in (1, 2) for m, p in parents.items()]
    messages = spark.createDataFrame(rows, "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    paths = defaultdict(list)
    for r in chat.best_paths(messages, None).orderBy("place").collect():
        paths[r["tree_id"], r["path_rank"]].append((r["msg_id"], r["place"]))
    for t in (1, 2):
        assert [[m for m, _ in paths[t, k]] for k in (1, 2, 3)] == [[0, 1, 4], [0, 2, 5, 6], [0, 1, 3]]
        assert all([p for _, p in paths[t, k]] == list(range(len(paths[t, k]))) for k in (1, 2, 3))
    assert len(paths) == 6
    assert {r["path_rank"] for r in chat.best_paths(messages).collect()} == {1}


def test_long_chain(spark):
    turns = spark.range(150).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    messages = chat.turn_messages(turns)
    out = chat.format_paths(messages, chat.best_paths(messages)).select(chat.parse_turns(F.col("formatted")).alias("t")).collect()
    assert [t["text"] for t in out[0]["t"]] == [str(i) for i in range(150)]


# --- 7: mixing


def poisson_count(u, rate):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def test_mix_moves_texts_once(spark, monkeypatch):
    docs = suite.table(spark, SF001, "documents")
    once = mixing.mix(docs)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = mixing.mix(docs)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == sorted(map(str, once.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_mix_replicates_by_inverse_poisson(spark):
    docs = [r.asDict() for r in suite.table(spark, SF001, "documents").collect()]
    size = Counter(d["source"] for d in docs)
    weight = {s: math.sqrt(n) for s, n in size.items()}
    got = Counter(r["doc_id"] for r in suite.op7_poisson_mix(spark, SF001).collect())
    for d in docs:
        key = hashlib.md5(f"42|{d['doc_id']}|{hashlib.md5(d['text'].encode()).hexdigest()}".encode()).hexdigest()
        rate = weight[d["source"]] / sum(weight.values()) * len(docs) / size[d["source"]]
        assert got[d["doc_id"]] == poisson_count(int(key[:13], 16) / 16**13, rate)


def test_mix_meets_its_weights(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 19_000, "big").when(F.col("id") < 19_010, "tiny").otherwise("small").alias("source")
    )
    weights = {"big": 0.5, "small": 0.3, "tiny": 0.2, "absent": 0.4}
    got = Counter(r["source"] for r in mixing.mix(docs, weights).select("source").collect())
    for s, w in (("big", 0.5), ("small", 0.3), ("tiny", 0.2)):
        assert got[s] == pytest.approx(20_000 * w, rel=0.06), s  # tiny: rate 400, drawn in steps
    twice = [sorted(map(tuple, mixing.mix(docs.repartition(n), weights).collect())) for n in (3, 11)]
    assert twice[0] == twice[1]


def test_mix_odd_rows(spark):
    rows = [(1, "a", None, 3), (1, "a", None, 3), (None, None, None, 4), (2, "b", "s", 5), (3, None, "s", 6), (4, "", "t", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    out = mixing.mix(docs, ratio=50.0).collect()
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    assert got.keys() == {r[:3] for r in rows} and 150 < len(out) < 450
    assert got[1, "a", None] % 2 == 0  # equal rows are drawn alike
    assert mixing.mix(docs.where("false")).count() == 0
    assert mixing.mix(docs, {"t": 1.0}).select("source").distinct().collect() == [("t",)]
    assert mixing.mix(docs, {"none": 1.0}).count() == 0


# --- the pipeline


def test_pipeline_stages_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "tokens"]
    docs = suite.table(spark, SF001, "documents")
    stage = dict(corpus_pipeline.STAGES)
    scores = {r["doc_id"]: r["predicted"] for r in suite.op2_quality_classifier(spark, SF001).collect()}
    good = stage["quality"](spark, docs, SF001).cache()
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == {d for d, p in scores.items() if p}
    rows = sorted((r["doc_id"], r["text"]) for r in good.collect())
    _, links = jaccard_links([t for _, t in rows], 5, 8, 10)
    from brute import components

    root = components(len(rows), links)
    one = stage["near_duplicates"](spark, good, SF001).cache()
    assert {r["doc_id"] for r in one.collect()} == {rows[i][0] for i in range(len(rows)) if root[i] == i}
    assert one.columns == docs.columns
    clean = stage["personal_data"](spark, one, SF001).cache()
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    assert clean.columns == docs.columns and clean.count() == one.count()
    for r in clean.collect():
        spans = personal_spans(before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
        assert not [s for s in personal_spans(r["text"]) if s in spans]
        assert spans or r["text"] == before[r["doc_id"]]
    mixed = stage["mix"](spark, clean, SF001).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= before.keys()
    tokens = stage["tokens"](spark, mixed, SF001).collect()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in tokens) == sorted((r["doc_id"], sha(texts[r["doc_id"]])) for r in mixed.collect())


def test_pipeline_odd_rows(spark):
    labels = SF001
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (None, "", "en", "a", 0), (3, "a b c d e f g h +1 (724) 555-7058", "en", "b", 1)]
    rows += [(4, rows[3][1], None, "b", 2), (4, rows[3][1], None, "b", 2), (5, "z" * 40_000, "en", None, 3)]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "c", "m") for r in rows], DOCS + ", set_id string, spans string, ids string, copy string, mix_source string")
    for name, f in corpus_pipeline.STAGES:
        for given in (docs, docs.where("false")):
            out = f(spark, given, labels)
            if name != "tokens":
                assert out.columns == docs.columns, name
                assert {(r["spans"], r["copy"], r["mix_source"]) for r in out.collect()} <= {("y", "c", "m")}
            n = out.count()
            assert n == 0 if given is not docs else n >= 0
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, labels)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "5", "None", "None"]
