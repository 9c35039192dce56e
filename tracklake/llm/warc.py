"""WARC archives: writer with revisits, splittable reader (operator 13).

``write`` puts each page into a record of its own gzip member, as the standard
asks: a ``response`` with an HTTP head and the page as its payload, or a
``revisit`` without payload where an earlier record holds the same one (equal
SHA-256, ``least`` bytes or more). The response of equal payloads is the one
with the smallest page_id. A task writes its files under names of its attempt,
and the manifest it returns, one row a file, lists whole files only: what a lost
attempt leaves is in no manifest.

``read`` cuts the files into byte ranges, one a task, without an index. A task
looks for gzip magic from the start of its range and takes the first candidate
that decodes to a WARC header and goes on as a chain of such members for more
than ``PROOF`` bytes or up to the end of the file. Compressed data can hold a
whole member by chance or malice only in a stored block, which ends within
65,535 bytes, so no other chain gets that far. From there members follow each
other. A task owns the records that start inside its range and reads on past
its end to finish the last one. Payload digests and lengths are checked.

Results on odd input: a null or empty page has an empty payload; null page_ids
come last among equal payloads and are read back as null; of equal rows one is
the response and the others revisit it; equal payloads under one page_id and
different urls are told apart by url; a member may hold several records; an
empty table makes an empty manifest. Characters that a URI cannot hold are
percent-encoded in urls. Damaged members raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.bitplanes import filesystem
from tracklake.llm.common import clear_others, find_package_on_workers

MAGIC = b"\x1f\x8b\x08"
#: Bytes after which a file ends (at the next record), and bytes of a range.
FILE_BYTES, RANGE_BYTES = 1 << 30, 1 << 25
#: Longest stored block of deflate: a chain of members beyond it is no accident.
PROOF = 65_535
#: Repeated digests that are broadcast; beyond, they meet the pages by shuffle.
BROADCAST_DIGESTS = 200_000
#: Bytes read at a time.
CHUNK = 1 << 20

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "payload binary, path string, offset long"
)


# --- records


def record_id(page_id: int | None, digest: str) -> str:
    """A name that tells the page and the payload."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; ``first``: the page a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": "1970-01-01T00:00:00Z",
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="%:/?#[]@!$&'()*+,;=~")
    head["WARC-Payload-Digest"] = f"sha256:{digest}"
    if revisit:
        head["WARC-Refers-To"] = record_id(first, digest)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head["Content-Type"] = "application/http; msgtype=response"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: gzip framing, no time stamp
    return z.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record in ``data``."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError("no WARC record")
        lines = re.sub(r"\r\n[ \t]+", " ", data[at:end].decode("utf-8", "replace")).split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        stop = end + 4 + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record that does not end where its length says")
        yield head, data[end + 4 : stop]
        at = stop + 4


def page_row(head: dict[str, str], block: bytes) -> tuple | None:
    """The first seven columns of ``RECORDS``, or None for other record types."""
    kind = head["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http).group(1))
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{head['warc-record-id']}: damaged payload")
    refers = page_of(head["warc-refers-to"]) if kind == "revisit" else None
    return page_of(head["warc-record-id"]), head.get("warc-target-uri"), kind, digest, size, refers, payload if kind == "response" else None


# --- the writer


def with_first(pages: DataFrame, least: int, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, first, copies): ``first`` is the page of
    the response for revisits, ``copies`` how many equal rows the row is for
    (one response, then revisits). Pages move only if the digests that occur
    more than once are too many to broadcast, and then once."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("bare"), "url")
    keys = rows.where(F.length("payload") >= least).select("digest", order.alias("o"))
    same = keys.groupBy("digest", "o").agg(F.count(F.lit(1)).alias("n"))
    repeated = (
        same.groupBy("digest").agg(F.sum("n").alias("all"), F.min_by("n", "o").alias("ties"), F.min("o").alias("least"))
        .where(F.col("all") > 1)
    )
    facts = repeated.agg(F.count(F.lit(1)).alias("n"), F.max("ties").alias("ties")).first()
    if not facts["n"]:
        return rows.select("*", F.lit(None).cast("long").alias("first"), F.lit(False).alias("revisit"), F.lit(1).cast("long").alias("copies"))
    found = _join_repeated(rows, repeated, facts["n"])
    is_first = order.eqNullSafe(F.col("least"))
    out = found.select(
        "page_id", "url", "payload", "digest", F.col("least.page_id").alias("first"),
        (F.col("least").isNotNull() & ~is_first).alias("revisit"), F.when(is_first, F.col("ties")).otherwise(1).cast("long").alias("copies"),
    )
    if facts["ties"] == 1:
        return out
    # Equal rows that tie for the response: one row stands for all of them.
    tied = out.where("copies > 1").groupBy("page_id", "url", "digest").agg(
        F.any_value("payload").alias("payload"), F.any_value("first").alias("first"), F.any_value("copies").alias("copies")
    )
    return out.where("copies = 1").unionByName(tied.withColumn("revisit", F.lit(False)).select(*out.columns))


def _join_repeated(rows: DataFrame, repeated: DataFrame, n: int) -> DataFrame:
    """Join on the digest. Beyond the broadcast, digests of more than one in
    10,000 pages (10,000 digests at most) are broadcast and the others, none of
    them hot, shuffled."""
    if n <= BROADCAST_DIGESTS:
        return rows.join(F.broadcast(repeated), "digest", "left")
    hot = repeated.where(F.col("all") > rows.count() / 10_000)
    light = repeated.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    marked = rows.join(F.broadcast(hot), "digest", "left")
    names = ["all", "ties", "least"]
    # Rows of hot digests get a key of their own each, so they lie anywhere.
    key = F.when(F.col("all").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    light = light.select(F.col("digest").alias("key"), *[F.col(c).alias(f"_{c}") for c in names])
    joined = marked.withColumn("key", key).join(light, "key", "left")
    return joined.select("digest", "page_id", "url", "payload", *[F.coalesce(c, f"_{c}").alias(c) for c in names])


class _File:
    """One archive that a task writes."""

    def __init__(self, uri: str) -> None:
        self.uri, self.records = uri, 0
        fs, path = filesystem(uri)
        self.out = fs.open_output_stream(path, compression=None)  # members are compressed one by one

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        size = self.out.tell()
        self.out.close()
        return self.uri, size, self.records


def write(
    pages: DataFrame,
    folder: str,
    least: int = 100,
    file_bytes: int = FILE_BYTES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write the archives; returns the manifest. Store it before reading: each
    run of its plan writes files anew."""
    spark = pages.sparkSession
    find_package_on_workers(spark)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    rows = with_first(pages, least, page_id, url, html).select("page_id", "url", "payload", "digest", "first", "revisit", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        part, out, number = TaskContext.get().partitionId(), None, 0
        own, made = uuid.uuid4().hex, []
        for batch in batches:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):  # one page at a time in Python
                page, at, body, digest, first, revisit, copies = (c[i].as_py() for c in cols)
                data, again = member(page, at, body, digest, first, revisit), None
                for k in range(copies):
                    if k == 1:
                        again = member(page, at, body, digest, first, True)
                    if out is None:
                        out = _File(f"{folder}/part-{part:06d}-{number:06d}-{own}.warc.gz")
                    out.add(again or data)
                    if out.out.tell() >= file_bytes:
                        made.append(out.close())
                        out, number = None, number + 1
        if out is not None:
            made.append(out.close())
        if made:
            types = [pa.string(), pa.int64(), pa.int64()]
            listed = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(listed, names=["path", "bytes", "records"])

    return rows.mapInArrow(run, MANIFEST)


# --- the reader


class _Tail:
    """A file from some byte on, read in chunks; bytes before ``base`` are let go."""

    def __init__(self, uri: str, at: int) -> None:
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()
        self.base, self.data = at, bytearray()
        self.file.seek(at)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.data += got
        return bool(got)

    def drop_to(self, at: int) -> None:
        del self.data[: at - self.base]
        self.base = at


def decoded(tail: _Tail, at: int) -> tuple[bytes, int]:
    """Content of the member at ``at`` and where the next one starts; raises
    ``ValueError`` if there is no whole WARC member."""
    z, out, pos, checked, step = zlib.decompressobj(31), bytearray(), at, False, 1 << 11
    try:
        while not z.eof:
            if pos - tail.base >= len(tail.data) and not tail.more():
                raise ValueError("the file ends within a member")
            piece = bytes(tail.data[pos - tail.base : pos - tail.base + step])
            out += z.decompress(piece)
            step = min(2 * step, CHUNK)
            pos += len(piece) - len(z.unused_data)
            if not checked and (len(out) >= 5 or z.eof):
                if not out.startswith(b"WARC/"):
                    raise ValueError("no WARC record")
                checked = True
    except zlib.error as e:
        raise ValueError(str(e)) from e
    return bytes(out), pos


def proven(tail: _Tail, at: int) -> bool:
    """Whether members follow each other from ``at`` on for more than ``PROOF``
    bytes or up to the end of the file."""
    pos = at
    while pos - at <= PROOF and pos < tail.size:
        try:
            data, pos = decoded(tail, pos)
            for _ in records(data):
                pass
        except (ValueError, KeyError):
            return False
    return True


def first_member(tail: _Tail, end: int) -> int | None:
    """The first member that starts before ``end``, found by its magic."""
    at = tail.base
    if at == 0:
        return 0
    while at < end:
        found = tail.data.find(MAGIC, at - tail.base)
        if found < 0:
            at = max(at, tail.base + len(tail.data) - len(MAGIC) + 1)
            tail.drop_to(at)
            if not tail.more():
                return None
            continue
        at = tail.base + found
        if at >= end:
            return None
        if proven(tail, at):
            return at
        at += 1
    return None


def read_range(uri: str, start: int, end: int) -> Iterator[tuple]:
    """Rows of ``RECORDS`` for the records of members that start in [start, end)."""
    tail = _Tail(uri, start)
    try:
        at = first_member(tail, min(end, tail.size)) if tail.size else None
        while at is not None and at < end and at < tail.size:
            tail.drop_to(at)
            try:
                data, after = decoded(tail, at)
                for head, block in records(data):
                    if (row := page_row(head, block)) is not None:
                        yield (*row, uri, at)
            except (ValueError, KeyError) as e:
                raise ValueError(f"{uri}, byte {at}: {e}") from e
            at = after
    finally:
        tail.file.close()


def read(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the archives listed in ``manifest`` (path, bytes)."""
    find_package_on_workers(spark)
    last = F.floor((F.col("bytes") - 1) / F.lit(range_bytes))
    ranges = manifest.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    n = ranges.count()
    ranges = ranges.repartitionByRange(max(n, 1), "path", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others()
        for batch in batches:
            for path, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                for row in read_range(path, k * range_bytes, (k + 1) * range_bytes):
                    if not with_payload:
                        row = (*row[:6], None, *row[7:])
                    rows.append(row)
                    held += len(row[6] or b"") + 200
                    if held >= 1 << 23:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    types = [number, text, text, text, number, number, pa.binary(), text, number]
    names = [f.strip().split(" ")[0] for f in RECORDS.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
