"""Operators 11, 12 and 13 against plain Python."""

import gzip
import hashlib
import io
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake.llm import merkle, suite, vector_codes, warc
from tracklake.llm.bitplanes import filesystem
from tracklake.llm.common import materialize, shared_path


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- 11: vector codes


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_products_of_limbs_are_exact(data):
    n, d, m = (data.draw(st.integers(1, 5)) for _ in range(3))
    number = st.integers(-(1 << 29), 1 << 29)
    x, y = (np.array(data.draw(st.lists(number, min_size=a * b, max_size=a * b)), np.int64).reshape(a, b) for a, b in ((n, d), (d, m)))
    exact = [[sum(int(x[i, k]) * int(y[k, j]) for k in range(d)) for j in range(m)] for i in range(n)]
    assert vector_codes.exact_product(x, y).tolist() == exact


def test_products_that_one_double_would_round():
    x = np.array([[(1 << 30) - 1, 1]], np.int64)
    assert vector_codes.exact_product(x, x.T).tolist() == [[((1 << 30) - 1) ** 2 + 1]]
    assert int((x.astype(float) @ x.T.astype(float))[0, 0]) != ((1 << 30) - 1) ** 2 + 1


def brute_codes(rows, parts, entries, rounds, scale):
    """{index of the row: (code, error)} and the digest, with Python integers."""
    good = [(i, v) for i, (_, v, _) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    ints = {i: [math.floor(scale * x) for x in v] for i, v in good}
    order = sorted(ints, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))
    w = len(next(iter(ints.values()))) // parts
    cut = {i: [v[p * w : p * w + w] for p in range(parts)] for i, v in ints.items()}
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]
    near = lambda x, b: min((sum((q - r) ** 2 for q, r in zip(x, c, strict=True)), e) for e, c in enumerate(b))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for i in ints:
                held[near(cut[i][p], books[p])[1]].append(cut[i][p])
            books[p] = [[sum(c) // len(c) for c in zip(*held[e], strict=True)] if e in held else books[p][e] for e in range(len(books[p]))]
    out = {}
    for i in ints:
        best = [near(cut[i][p], books[p]) for p in range(parts)]
        out[i] = "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)
    return out, sha(",".join(str(x) for b in books for c in b for x in c))


def test_codes_against_plain_integers(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i) // 2, [float(x) for x in rng.normal(0, 3, 8).astype(np.float32)], int(i % 3)) for i in rng.permutation(120)]
    rows += [(500 + i, rows[3][1], None) for i in range(70)]  # many copies, null labels
    rows += [(None, [0.5] * 8, 1), (None, [-0.5] * 8, 1), (7000, [1000.25] * 8, 2)]
    rows += [(-5, None, 0), (-4, [float("nan")] * 8, 0), (-3, [float("inf")] + [0.0] * 7, 0), (-2, [None] * 8, 0), (-1, [], 0), (-6, [1.0] * 4, 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    books_of = []
    for parts_of_table in (df.repartition(5), df.coalesce(1)):
        got, books = vector_codes.compress(parts_of_table, parts=4, entries=6, rounds=3)
        books_of.append(books)
        found = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"], r["label_error"]) for r in got.collect())
        whole = [r if r[1] is None or len(r[1]) in (0, 8) else (r[0], None, r[2]) for r in rows]
        want, digest = brute_codes(whole, 4, 6, 3, 4096)
        by_label = defaultdict(int)
        for i, (_, e) in want.items():
            by_label[rows[i][2]] += e
        assert found == sorted((rows[i][0] is None, rows[i][0] or 0, c, e, by_label[rows[i][2]]) for i, (c, e) in want.items())
        assert books.digest() == digest and got.columns == ["vec_id", "label", "code", "error", "label_error"]
    code = next(iter(want.values()))[0]
    assert len(books_of[0].decode(code)) == 8


def test_codes_of_few_none_or_huge_vectors(spark):
    schema = "vec_id long, embedding array<double>, label string"
    got, books = vector_codes.compress(spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 2.5], "a")], schema), parts=2, entries=16)
    assert [(r["code"], r["error"]) for r in got.orderBy("vec_id").collect()] == [("0000", 0), ("0001", 0)]
    assert books.entries.shape == (2, 2, 1)
    none, books = vector_codes.compress(spark.createDataFrame([(1, None, "a")], schema))
    assert none.count() == 0 and books.digest() == sha("")
    with pytest.raises(OverflowError):
        vector_codes.compress(spark.createDataFrame([(1, [1e9] * 8, "a")], schema))


def test_labels_too_many_to_broadcast(spark, monkeypatch):
    rows = [(i, [float(i), 1.0], i % 5 or None) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    a = vector_codes.compress(df, parts=2, entries=3)[0].collect()
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 2)
    b = vector_codes.compress(df, parts=2, entries=3)[0].collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


# --- 12: Merkle manifest


def brute_tree(nodes):
    """Levels of nodes up to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def brute_walk(levels, i, node):
    """(siblings, root) of a node put at place i."""
    beside = ""
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        left, right = "".join(run[: i % 8]), "".join(run[i % 8 + 1 :])
        beside, node, i = beside + left + right, sha(left + node + right), i // 8
    return beside, node


def brute_leaf(row, text):
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(one(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    by_lang = defaultdict(list)
    for r in rows:
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        by_lang[r["lang"]].append((r["doc_id"], brute_leaf(r, r["text"]), brute_leaf(r, lower(r["text"]) if changed else r["text"])))
    names = sorted(by_lang, key=lambda n: (n is not None, (n or "").encode()))
    trees = []
    for n in names:
        by_lang[n].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(brute_tree([x[1] for x in by_lang[n]]))
    crown = brute_tree([t[-1][0] for t in trees])
    root, out = crown[-1][0], []
    for k, (n, tree) in enumerate(zip(names, trees, strict=True)):
        for i, (doc_id, leaf, found) in enumerate(by_lang[n]):
            beside, subroot = brute_walk(tree, i, found)
            more, folded = brute_walk(crown, k, subroot)
            out.append((doc_id, leaf, tree[-1][0], root, sha(beside + more), folded, folded == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def check_manifest(spark, rows, schema=DOCS):
    df = spark.createDataFrame(rows, schema)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.documents_manifest(df.repartition(4), tampered)
    assert got.columns == COLUMNS
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == sorted(brute_manifest([r.asDict() for r in df.collect()]), key=str)
    return found


def many(n, lang, start=0):
    return [(start + i, f"s{i % 7}", lang, None if i % 11 == 0 else i, None if i % 13 == 0 else f"Text {i} é\U0001f600" * (i % 3)) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_against_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    langs = [("en", 201), ("de", 64), ("fr", 65), (None, 9), ("", 8), ("é", 1), ("\U0001f600", 2), ("￮", 3)]
    rows = [r for k, (lang, n) in enumerate(langs) for r in many(n, lang, 1000 * k)]
    rows += [(None, None, "en", None, None)] * 2 + [(5, "x", "de", 1, "UPPER")] * 12 + [(6, "x" * 10, "en", 2, "A" * 300_000)]
    found = check_manifest(spark, rows)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_manifest_of_many_trees(spark):
    check_manifest(spark, [r for k in range(75) for r in many(1 + k % 3, f"l{k}", 10 * k)])


def test_manifest_of_few_rows_and_clashing_names(spark, monkeypatch):
    assert merkle.documents_manifest(spark.createDataFrame([], DOCS), F.lit(True)).collect() == []
    check_manifest(spark, [(3, "s", "en", 1, "x")])
    monkeypatch.setattr(merkle, "BROADCAST_TREES", 0)
    extra = [(*r, "a", 1, "b") for r in many(20, "en")]
    check_manifest(spark, extra, DOCS + ", leaf string, rank long, tree string")


def test_a_parent_goes_on_from_its_state():
    nodes = [sha(str(i)) for i in range(20)]
    block = merkle.Block(nodes, 2)
    levels = brute_tree(nodes)
    assert block.nodes == levels[2]
    for i in range(20):
        new = sha(f"new {i}")
        assert block.fold(i, new, {}) == brute_walk(levels, i, new)[1]
        assert merkle.Above(block.path(i)).fold(new) == brute_walk(levels, i, new)[1]
        assert merkle.siblings(block.path(i)) == brute_walk(levels, i, new)[0]


# --- 13: WARC


PAGES = "page_id long, url string, html string"


def round_trip(spark, pages, range_bytes=1 << 25, file_bytes=1 << 30, least=100):
    folder = shared_path(spark, "warc")
    manifest = materialize(warc.write(pages, folder, least=least, file_bytes=file_bytes), "warc-manifest")
    return manifest, warc.read(spark, manifest, range_bytes)


def brute_pages(rows):
    """(page_id, bytes, digest, type, refers_to) by the rules."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    first, out = {}, []
    for i in order:
        body = (rows[i][2] or "").encode()
        again = len(body) >= 100 and body in first
        out.append((rows[i][0], len(body), sha(body), "revisit" if again else "response", first[body] if again else None))
        first.setdefault(body, rows[i][0])
    return sorted(out, key=str)


def odd_pages():
    rows = [(i, f"http://a.example/{i}", f"<p>{i % 40}</p>" * 30) for i in range(120)]
    rows += [(i, None, "short") for i in range(200, 204)] + [(300, "u", None), (301, "u", ""), (302, "u\r\nWARC-Type: x é", "y" * 99)]
    rows += [(9, "http://a.example/9", "<p>9</p>" * 30)] * 3  # equal rows, the response among them
    rows += [(None, "n", "<p>1</p>" * 30), (None, None, "only null" * 20), (None, "z", "only null" * 20)]
    rows += [(400, "w", "WARC/1.1\r\n\r\n\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n" * 9), (401, "long", "é\U0001f600long " * 400_000)]
    return rows


def shown(df):
    return sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str
    )


@pytest.mark.parametrize("range_bytes,file_bytes", [(1 << 25, 1 << 30), (700, 5_000), (7, 300)])
def test_archives_round_trip(spark, range_bytes, file_bytes):
    rows = odd_pages() if range_bytes > 100 else odd_pages()[:9]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES + ", digest string, copies int").repartition(3)
    manifest, got = round_trip(spark, pages, range_bytes, file_bytes)
    found = got.collect()
    assert shown(got) == brute_pages(rows)
    assert sum(r["records"] for r in manifest.collect()) == len(rows)
    whole = {r["payload_digest"]: bytes(r["payload"]) for r in found if r["record_type"] == "response"}
    assert all(sha(body) == digest for digest, body in whole.items())
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in found)


def test_archives_are_plain_gzip_of_standard_records(spark):
    pages = spark.createDataFrame(odd_pages()[:50], PAGES)
    manifest, _ = round_trip(spark, pages)
    n = 0
    for row in manifest.collect():
        fs, path = filesystem(row["path"])
        data = fs.open_input_file(path).read()
        for head, block in warc.records(gzip.GzipFile(fileobj=io.BytesIO(data)).read()):
            assert len(block) == int(head["content-length"]) and head["warc-record-id"].startswith("<urn:") and head["warc-date"]
            n += 1
    assert n == 50


def test_equal_payloads_by_shuffle(spark, monkeypatch):
    rows = odd_pages()[:-1] + [(1000 + i, "c", "hot" * 50) for i in range(300)]
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    _, got = round_trip(spark, spark.createDataFrame(rows, PAGES))
    assert shown(got) == brute_pages(rows)


def test_no_pages(spark):
    _, got = round_trip(spark, spark.createDataFrame([], PAGES))
    assert got.count() == 0


def member(text):
    head = f"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {len(text)}\r\n\r\n".encode()
    return head + text + b"\r\n\r\n"


def stored(data):
    z = zlib.compressobj(0, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@pytest.mark.parametrize("cut", range(0, 130_000, 9_973))
def test_members_inside_a_payload_are_no_members(tmpdir_path, cut):
    """An archive stored without compression in a record of another archive."""
    inner = b"".join(gzip.compress(warc_record(i)) for i in range(300, 700))
    outer = [stored(member(inner[:60_000])), gzip.compress(warc_record(1)), stored(member(inner[60_000:])), gzip.compress(warc_record(2))]
    path = f"{tmpdir_path}/x.warc.gz"
    with open(path, "wb") as f:
        f.write(b"".join(outer))
    size = sum(map(len, outer))
    cut = min(cut, size - 1)
    rows = [r for lo, hi in ((0, cut), (cut, size)) if hi > lo for r in warc.read_range(f"file:{path}", lo, hi)]
    assert [r[0] for r in rows] == [1, 2]


def warc_record(page):
    body = f"<p>{page}</p>".encode() * 20
    return zlib.decompress(warc.member(page, "u", body, sha(body), None, False), 31)


def test_several_records_in_a_member_and_damage(tmpdir_path):
    path = f"{tmpdir_path}/x.warc.gz"
    data = gzip.compress(warc_record(1) + member(b"other") + warc_record(2)) + gzip.compress(warc_record(3))
    with open(path, "wb") as f:
        f.write(data)
    assert [r[0] for r in warc.read_range(f"file:{path}", 0, len(data))] == [1, 2, 3]
    assert [r[0] for r in warc.read_range(f"file:{path}", 1, len(data))] == [3]
    with open(path, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(ValueError):
        list(warc.read_range(f"file:{path}", 0, len(data)))
    bad = warc_record(4).replace(b"<p>4</p>", b"<p>5</p>", 1)
    with open(path, "wb") as f:
        f.write(gzip.compress(bad))
    with pytest.raises(ValueError):
        list(warc.read_range(f"file:{path}", 0, 1 << 20))


@pytest.mark.parametrize("name,table", [("op11_vector_codes", "embeddings"), ("op12_merkle", "documents"), ("op13_warc", "pages")])
def test_queries_return_a_row_for_each(spark, name, table):
    got = suite.QUERIES[name](spark, SF001)
    assert got.count() == suite.table(spark, SF001, table).count()
    assert pa.schema(got.limit(1).toArrow().schema) is not None
