"""Operators 3, 8 and 10 against the tokenizers library and plain Python."""

import gc
import hashlib
import json
import random
import unicodedata
import weakref
import zlib

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake.llm import bitplanes, bpe, common, suite, syncmers
from tracklake.llm.common import shared_path

ODD = [
    None, "", " ", "\n\n a  b", "don't I'LL we're", "a<|endoftext|>b <|endoftext|> <|endoftext", "x" * 3000, "日本語 𝄞 é  ",
    "\x1c\x1d a\x85b c  d", "a\tb\r\nc", "ab " * 2000, "a", "a b",
]


def odd_docs(spark, texts=ODD):
    rows = [(i if i else None, t, f"l{i}", None, 7) for i, t in enumerate(texts)] + [(3, texts[3], "again", "s", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, range string, N_Tokens int")


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(suite.vocabulary(suite.BYTE_BPE))


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(suite.vocabulary(suite.WORD_BPE))


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


def test_bpe_query_equals_the_library(spark, byte_bpe):
    docs = {r["doc_id"]: r["text"] or "" for r in suite.table(spark, SF001, "documents").collect()}
    got = suite.op3_bpe(spark, SF001).collect()
    assert {r["doc_id"] for r in got} == docs.keys() and len(got) == len(docs)
    for r in got:
        ids = byte_bpe.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        back = byte_bpe.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_bpe_odd_rows(spark, byte_bpe):
    path = suite.vocabulary(suite.BYTE_BPE)
    out = bpe.decode(bpe.encode(odd_docs(spark), path), path, text="back")
    assert out.columns == ["doc_id", "text", "range", "N_Tokens", "ids", "back"]  # the clashing "ids" is replaced
    for r in out.collect():
        assert r["ids"] == byte_bpe.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == (r["text"] or "")
    both = bpe.round_trip(odd_docs(spark), path, back="back")
    assert both.columns == out.columns and sorted(both.collect(), key=str) == sorted(out.collect(), key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(empty, path, digest="d").count() == 0
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0
    nulls = spark.createDataFrame([(None,), ([1, None, 10**6],)], "ids array<int>")
    assert [r["text"] for r in bpe.decode(nulls, path).collect()] == ["", byte_bpe.decode([1])]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'stZ 1é日\n\t .,<|>endoftx́\x1c　"), max_size=60))
def test_bpe_equals_the_library_on_any_text(text):
    from tokenizers import Tokenizer

    path = suite.vocabulary(suite.BYTE_BPE)
    library = test_bpe_equals_the_library_on_any_text.__dict__.setdefault("t", Tokenizer.from_file(path))
    assert bpe.codec(path).encode(text) == packed(library.encode(text, add_special_tokens=False).ids)


def test_memos_of_others_are_freed_at_once():
    path = suite.vocabulary(suite.BYTE_BPE)
    common.clear_others("bpe")
    kept = weakref.ref(bpe.codec(path))
    kept().encode("some words to remember")
    common.clear_others("bpe")
    assert kept() is not None
    gc.disable()
    try:
        common.clear_others("other")
        assert kept() is None
    finally:
        gc.enable()


@pytest.mark.parametrize("flag", ["lstrip", "rstrip", "single_word"])
def test_flags_of_added_tokens_are_refused(tmp_path, flag):
    with open(suite.vocabulary(suite.BYTE_BPE), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0][flag] = True
    (tmp_path / "flags.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="added tokens"):
        bpe.Codec(str(tmp_path / "flags.json"))


def test_memo_generations_do_not_change_ids(monkeypatch, byte_bpe):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    c = bpe.Codec(suite.vocabulary(suite.BYTE_BPE))
    text = "one two three four five one six two seven one"
    assert [c.encode(text) for _ in range(3)] == [packed(byte_bpe.encode(text).ids)] * 3


def test_id_files_read_back(spark, word_bpe):
    docs = sorted((r["doc_id"], r["text"] or "") for r in suite.table(spark, SF001, "documents").collect())
    got = {r["doc_id"]: r for r in suite.op10_bitplanes(spark, SF001).collect()}
    assert len(got) == len(docs)
    start = 0
    for doc_id, text in docs:
        ids = word_bpe.encode(text, add_special_tokens=False).ids + [1]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)


def test_id_files_odd_rows_and_files_that_roll(spark, word_bpe, monkeypatch):
    path = suite.vocabulary(suite.WORD_BPE)
    docs = odd_docs(spark)
    manifest = bitplanes.write(docs, path, shared_path(spark, "ids")).cache()
    rows = bitplanes.read(spark, manifest).orderBy("start").collect()
    assert rows[0]["doc_id"] is None and len(rows) == len(ODD) + 1
    assert [r["doc_id"] for r in rows[1:]] == sorted(r["doc_id"] for r in rows[1:])
    texts = {(r["doc_id"], zlib.crc32(packed(word_bpe.encode(r["text"] or "", add_special_tokens=False).ids + [1]))) for r in docs.collect()}
    assert {(r["doc_id"], r["ids_crc32"]) for r in rows} == texts
    assert all(list(r["ids"])[-1] == 1 for r in rows)
    nothing = bitplanes.write(docs.where("false"), path, shared_path(spark, "ids"))
    assert bitplanes.read(spark, nothing).count() == 0


def test_pieces_equal_whole_texts(word_bpe):
    memo = bitplanes.pieces(suite.vocabulary(suite.WORD_BPE))
    texts = [t or "" for t in ODD] + ["ÀÉ Å x́ ́y ΑΣ ΟΔΟΣ.", "İ ǅ ẞ <|startoftext|>X"]
    assert [x.tolist() for x in memo.encode(texts)] == [word_bpe.encode(t, add_special_tokens=False).ids for t in texts]


def test_control_strings_keep_their_case(spark, word_bpe):
    path = suite.vocabulary(suite.WORD_BPE)
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|endoftext|> Upper", "X<|StartOfText|>Y<|startoftext|>Z <|END", "<|ENDOFTEXT|> <|endoftext|> A<|endoftext|>B"]
    want = [word_bpe.encode(t, add_special_tokens=False).ids for t in texts]
    assert 49407 not in want[0] + want[1] and 49407 in want[2]
    assert [x.tolist() for x in bitplanes.pieces(path).encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bitplanes.read(spark, bitplanes.write(docs, path, shared_path(spark, "ids")).cache()).orderBy("start").collect()
    starts = np.cumsum([0] + [len(ids) + 1 for ids in want]).tolist()
    assert [(r["start"], list(r["ids"])) for r in rows] == [(a, [*ids, 1]) for a, ids in zip(starts, want, strict=False)]


def test_bit_planes_round_trip(tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    for top in (1, 2, 49_408, 2**32 - 1):
        ids = rng.integers(0, top, 1000, dtype=np.uint32)
        assert (bitplanes.unpack_block(bitplanes.pack_block(ids), 1000) == ids).all()
    assert len(bitplanes.pack_block(np.zeros(9, np.uint32))) == 0
    monkeypatch.setattr(bitplanes, "BLOCK", 64)
    docs = [(i if i % 7 else None, rng.integers(0, 50_000, int(n), dtype=np.uint32)) for i, n in enumerate(rng.integers(0, 300, 50))]
    w = bitplanes.Writer(f"file:{tmp_path}/a.ids", 0)
    for d in docs:
        w.add(*d)
    assert w.close() == (tmp_path / "a.ids").stat().st_size
    back = list(bitplanes.read_file(f"file:{tmp_path}/a.ids"))
    assert [(k, x.tolist()) for k, x in back] == [(k, x.tolist()) for k, x in docs]


def edited(texts, i):
    now, following = texts[i], texts[(i + 1) % len(texts)]
    cut = len(now) // 4
    return now[: len(now) - cut] + following[:cut]


@pytest.mark.parametrize("rows", [syncmers.RANGE_ROWS, 20])
def test_fingerprints_against_neighbours(spark, monkeypatch, rows):
    monkeypatch.setattr(syncmers.range_starts, "__defaults__", ("doc_id", rows))
    table = sorted((r["doc_id"], r["text"] or "") for r in suite.table(spark, SF001, "documents").collect())
    texts = [t for _, t in table]
    got = {r["doc_id"]: r for r in suite.op8_syncmers(spark, SF001).collect()}
    assert len(got) == len(table)
    marks = [syncmers.anchors(t) for t in texts]
    for i, (doc_id, text) in enumerate(table):
        r, e = got[doc_id], edited(texts, i)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["fingerprint"] == syncmers.to_string(marks[i])
        assert r["near_edited"] == syncmers.likeness(marks[i], syncmers.anchors(e))
        assert r["near_next"] == syncmers.likeness(marks[i], marks[(i + 1) % len(texts)])
        if len(text) > 200:
            assert r["near_edited"] > r["near_next"] or text == texts[(i + 1) % len(texts)]


def test_fingerprints_odd_rows(spark):
    docs = odd_docs(spark)
    got = syncmers.compare_with_next(docs).collect()
    assert len(got) == docs.count() and sum(r["doc_id"] is None for r in got) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    one = syncmers.compare_with_next(spark.createDataFrame([(5, None)], "doc_id long, text string")).collect()
    assert [(r["n_chars"], r["fingerprint"], r["near_next"]) for r in one] == [(0, "", 1.0)]
    assert syncmers.compare_with_next(docs.where("false")).count() == 0
    named = syncmers.fingerprint(docs.withColumn("FINGERPRINT", F.lit(1)))
    assert named.columns[-1] == "fingerprint" and named.count() == docs.count()


def test_syncmers_by_definition():
    """Whether a substring is chosen depends on the substring alone, and every
    window holds a chosen one."""
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    marks = syncmers.anchors(text)
    lone = [p for p in range(len(text) - syncmers.K + 1) if any(q == 0 for q, _ in syncmers.anchors(text[p : p + syncmers.K] + "~" * 300)[:1])]
    assert [p for p, _ in marks] == lone
    assert max(b - a for (a, _), (b, _) in zip(marks, marks[1:], strict=False)) <= syncmers.K - syncmers.S + 1
    shifted = syncmers.anchors("some other start of three hundred characters" * 8 + text)
    assert {h for _, h in marks} <= {h for _, h in shifted}
    assert syncmers.likeness(marks, marks) == 1.0 and syncmers.likeness(marks, []) == 0.0


@pytest.mark.parametrize("limit", [syncmers.FINE[0], syncmers.K, syncmers.TINY, syncmers.SHORT])
def test_lengths_on_either_side_of_a_limit_compare(limit):
    rng = random.Random(limit)
    for _ in range(20):
        text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(limit + 2))
        cut = text[: limit - max(1, limit // 40)]
        assert syncmers.likeness(syncmers.anchors(text), syncmers.anchors(cut)) > 0.6
        assert syncmers.likeness(syncmers.anchors(cut), syncmers.anchors(text)) > 0.6
        other = "".join(rng.choice("qrstuvwxyz.") for _ in range(limit - 1))
        assert syncmers.likeness(syncmers.anchors(text), syncmers.anchors(other)) < 0.2


def test_every_text_has_anchors_and_short_neighbours_compare(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(300))
    assert all(syncmers.anchors(text[:n]) for n in range(1, 300))
    assert syncmers.likeness(syncmers.anchors(text[:258]), syncmers.anchors(text[:252])) > 0.8
    rows = syncmers.compare_with_next(spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["near_edited"] for r in rows}[1] > 0.7


def test_repeats_count_by_their_length():
    like = lambda a, b: syncmers.likeness(syncmers.anchors(a), syncmers.anchors(b))
    rng = random.Random(7)
    p, x, y = ("".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(3))
    assert 0.1 < like("a" * 300, "a" * 3000) < 0.3
    assert 0.65 < like("a" * 1000, "a" * 750 + y[:250]) < 0.85
    assert 0.7 < like(p + x + p, x + p) < 0.9 and 0.7 < like(p + x + p, p + x) < 0.9
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for h in a:
            new = [0]
            for j, g in enumerate(b):
                new.append(row[j] + 1 if g == h else max(row[j + 1], new[j]))
            row = new
        assert syncmers.common(a, b) == row[-1]


def test_signs_after_a_word_need_no_pattern(monkeypatch):
    """A word followed by signs is cut without the word pattern, once remembered
    or not; texts with runs of white space still go through it whole."""
    from tokenizers import Tokenizer

    path = suite.vocabulary(suite.BYTE_BPE)
    c, library, calls = bpe.Codec(path), Tokenizer.from_file(path), []

    class Words:
        findall = staticmethod(lambda text, find=c.words.findall: calls.append(text) or find(text))

    monkeypatch.setattr(c, "words", Words)
    plain = "Ansh thea, oner. éelle*** ona (x) it's. we'll, 1st, a_b, ona, ona."
    odd = [plain, plain + " ", " " + plain, plain.replace("oner. ", "oner.  "), "a b\t c", "a \nb", "ona,\nona. ona", "ona\x1c ona", "a  ", " ", "a ona　, b"]
    for text in [*odd, *odd]:
        want = library.encode(text, add_special_tokens=False).ids
        packed = c.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want
        assert c.decode_packed(packed) == c.decode(want) == library.decode(want, skip_special_tokens=False)
    assert calls and not {" thea,", " oner.", " éelle***", " ona,", " ona."} & set(calls)


def test_a_word_is_encoded_once_whatever_signs_follow(monkeypatch):
    from tokenizers import Tokenizer

    path = suite.vocabulary(suite.WORD_BPE)
    memo, library, asked = bitplanes._Pieces(path), Tokenizer.from_file(path), []
    plain = memo._encode_new
    monkeypatch.setattr(memo, "_encode_new", lambda pieces: asked.extend(pieces) or plain(pieces))
    texts = ["thedededou, Thedededou", "thedededou. (thedededou) thedededou***", "thedededou's, it's. 've! 12. é, éa, ...,",
             "x<|endoftext|>thedededou, a, b.", "o̸, á, a,́ ≠ a≠ " + "y" * 70 + ", " + "y" * 70 + "."]
    for text in [*texts, *texts]:
        assert memo.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert asked.count(b"thedededou") == 1 and b"thedededou," not in asked and b"thedededou***" not in asked
    assert not any(len(p) > bitplanes.MEMO_CHARS for p in memo.known)


def test_a_piece_is_looked_up_once_for_many_texts(monkeypatch):
    memo, asked = bitplanes._Pieces(suite.vocabulary(suite.WORD_BPE)), []

    class Known(dict):
        def get(self, piece, *other):
            asked.append(piece)
            return dict.get(self, piece, *other)

        def __getitem__(self, piece):
            asked.append(piece)
            return dict.__getitem__(self, piece)

    memo.known = Known()
    texts = [f"one, two three. four\n{'five ' * (i % 7)}, one" for i in range(200)]
    whole = memo.encode(texts)
    assert len(asked) < 30
    assert [x.tolist() for x in whole] == [memo.encode([t])[0].tolist() for t in texts]


def test_pieces_of_columns_and_long_runs(spark, word_bpe, monkeypatch):
    import pyarrow as pa

    signs = "a. b,c d.\n.e, ,f g.. h., . é. É, ÿ, ×. a×b a÷ ÀÖØÞß ßàöøÿ ª µ º İ ŉ é, ́ á. ≠ a̸ x\x1c.y a . b"
    texts = ["", " ", ".", "a.", " b", ", c", *signs.split(" "), signs, signs.upper(), f"{signs} <|endoftext|> {signs}", "A. <|ENDOFTEXT|>, b.", "\ta.\x0b b,\x0c c\r. ", *(t or "" for t in ODD)]
    want = [word_bpe.encode(t, add_special_tokens=False).ids for t in texts]
    memo = bitplanes._Pieces(suite.vocabulary(suite.WORD_BPE))
    column = pa.array(["not of the slice.", *texts, "."])
    for part in (texts, column.slice(1, len(texts)), column.cast(pa.large_string()).slice(1, len(texts))):
        assert [x.tolist() for x in memo.encode(part)] == want
    monkeypatch.setattr(bitplanes, "MEMO_PIECES", 3)
    assert [memo.encode([t])[0].tolist() for t in [*texts, *texts]] == want + want
    assert memo.encode([]) == []
    for n, size in ((1024, 1 << 23), (2, 1 << 23), (1024, 10), (1024, 0)):
        monkeypatch.setattr(bitplanes, "TEXTS", n)
        monkeypatch.setattr(bitplanes, "TEXT_BYTES", size)
        runs = list(bitplanes._slices(column))
        assert [lo for lo, _ in runs] == [0, *(hi for _, hi in runs[:-1])] and runs[-1][1] == len(column)
        assert all(hi - lo == 1 or hi - lo <= n and sum(map(len, column[lo:hi].cast(pa.binary()).to_pylist())) <= size for lo, hi in runs)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = suite.vocabulary(suite.WORD_BPE)
    rows = bitplanes.read(spark, bitplanes.write(docs, path, shared_path(spark, "ids")).cache()).orderBy("start").collect()
    assert [list(r["ids"]) for r in rows] == [[*ids, 1] for ids in want]


def test_capitals_are_composed_before_they_are_lowered(word_bpe):
    memo = bitplanes._Pieces(suite.vocabulary(suite.WORD_BPE))
    marks = [chr(c) for c in range(0x300, 0x11000) if unicodedata.combining(chr(c))]
    texts = [f"{x}{m}" for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in [*marks, "֑̈", "̖̊", "̣̱"]]
    texts += ["a T̈, H̱. é Tẗ", "T", "̈", "<|ENDOFTEXT|>T̈ W̊<|endoftext|>"]
    assert [x.tolist() for x in memo.encode(texts)] == [word_bpe.encode(t, add_special_tokens=False).ids for t in texts]
