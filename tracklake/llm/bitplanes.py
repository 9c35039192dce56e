"""Token ids in files of compressed bit planes (operator 10).

File layout, integers little-endian:

    header   8 bytes ``TLPLANE1``
    blocks   for each block of ``BLOCK`` ids (the last is shorter): its bit
             planes, lowest bit first; a plane holds one bit of each id, eight
             to a byte, compressed with zstandard
    footer   zstandard-compressed arrays, see ``Footer``: the chunk index
             (ids and planes of each block, bytes of each plane) and the
             document index (ids of each document, its doc_id or null)
    tail     8 bytes footer length, 8 bytes ``TLPLANE1``

``write`` deals the documents to tasks by ranges of doc_id, sorts each range
and lets each task stream its ids to files, so file order is doc_id order and
no task holds more than a block and the document index of one file. A file is
written under a name of its attempt and renamed when whole: a task that runs
again, or twice at once, leaves the same bytes under the same name. ``read``
reads whole files back, one file at a time in a task.

Results on odd input: a null or empty text has only the end id; null doc_ids
come first; rows with equal doc_id are ordered by a hash of the text, and equal
rows are stored once each; an empty table gives an empty manifest and no files. Other
columns of the input are not stored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm.common import clean_text, clear_others, find_package_on_workers, may_clear

MAGIC = b"TLPLANE1"
#: Ids in a block, and ids after which a file ends (at the next document).
BLOCK, FILE_IDS = 1 << 16, 1 << 24
#: Pieces of text that one Python worker remembers in each generation, and the
#: bytes of the longest.
MEMO_PIECES, MEMO_CHARS = 300_000, 64
#: New pieces that are encoded as one text.
TOGETHER = 256
#: Texts that are cut into pieces together, and bytes after which they are fewer:
#: a piece is looked up once for all of them.
TEXTS, TEXT_BYTES = 512, 1 << 22
#: The normalizers and words of a vocabulary whose pieces may be cut before
#: ASCII signs at their end: after an ASCII letter or digit these are a word of
#: their own. An apostrophe may start another word, so none is among them. Letters
#: of ASCII (lower) and Latin-1 alone are one word, which the normalizers lower only.
PLAIN = ["NFC", "Replace", "Lowercase"]
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS, BEFORE_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
#: The bytes of letters a to z and U+00C0 to U+00FF; the multiplication and the
#: division sign there are none.
LETTERS = bytes({*range(97, 123), 0xC3, *range(0x80, 0xC0)} - {0x97, 0xB7})
#: Capitals that NFC may compose with a mark (U+0300 or above) only when lowered.
CAPITALS, MARKS = b"HJTWY", 0xCC
BEFORE_MARKS = re.compile(rb"[HJTWY][\xcc-\xff]")

MANIFEST = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("part", "number", "docs", "ids", "bytes")]
    + [T.StructField("path", T.StringType())]
)
DOCUMENTS = "doc_id long, start long, n_tokens long, ids array<int>, ids_crc32 long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Hadoop writes it (``file:/a``)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def pack_block(ids: np.ndarray) -> list[bytes]:
    """The compressed bit planes of a block, lowest bit first."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    c = zstandard.ZstdCompressor(level=1)
    one = np.uint32(1)
    return [c.compress(np.packbits((ids >> np.uint32(b)) & one != 0).tobytes()) for b in range(width)]


def unpack_block(planes: list[bytes], n: int) -> np.ndarray:
    d = zstandard.ZstdDecompressor()
    ids = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(d.decompress(plane), np.uint8), count=n)
        ids |= bits.astype(np.uint32) << np.uint32(b)
    return ids


class Footer:
    """The chunk index and the document index of one file."""

    ARRAYS = ("block_ids", "block_planes", "plane_bytes", "doc_ids", "doc_known", "doc_tokens")

    def __init__(self) -> None:
        for name in self.ARRAYS:
            setattr(self, name, [])

    def pack(self) -> bytes:
        c, parts = zstandard.ZstdCompressor(level=3), []
        for name in self.ARRAYS:
            raw = np.asarray(getattr(self, name), "<i8")
            body = c.compress(raw.tobytes())
            parts += [len(raw).to_bytes(8, "little"), len(body).to_bytes(8, "little"), body]
        return b"".join(parts)

    @classmethod
    def unpack(cls, data: bytes) -> Footer:
        self, at, d = cls(), 0, zstandard.ZstdDecompressor()
        for name in cls.ARRAYS:
            n, size = (int.from_bytes(data[at + k : at + k + 8], "little") for k in (0, 8))
            raw = d.decompress(data[at + 16 : at + 16 + size], max_output_size=8 * n)
            setattr(self, name, np.frombuffer(raw, "<i8", n))
            at += 16 + size
        return self


class Writer:
    """Streams documents to one file."""

    def __init__(self, uri: str, attempt: int) -> None:
        self.fs, self.path = filesystem(uri)
        self.temp = f"{self.path}.{attempt}.tmp"
        self.out = self.fs.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.footer, self.waiting, self.n_waiting = Footer(), [], 0
        self.docs = self.ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        f = self.footer
        f.doc_ids.append(doc_id or 0)
        f.doc_known.append(doc_id is not None)
        f.doc_tokens.append(len(ids))
        self.docs += 1
        self.ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        whole = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(whole) if all_of_it else len(whole) // BLOCK * BLOCK
        for lo in range(0, end, BLOCK):
            block = whole[lo : min(lo + BLOCK, end)]
            planes = pack_block(block)
            self.footer.block_ids.append(len(block))
            self.footer.block_planes.append(len(planes))
            self.footer.plane_bytes.extend(map(len, planes))
            self.out.write(b"".join(planes))
        self.waiting, self.n_waiting = [whole[end:]], len(whole) - end

    def close(self) -> int:
        """Finish the file under its own name; returns its size."""
        self._flush(True)
        end = self.footer.pack()
        self.out.write(end + len(end).to_bytes(8, "little") + MAGIC)
        size = self.out.tell()
        self.out.close()
        self.fs.move(self.temp, self.path)
        return size


def read_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document, decoding one block after the other."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 16)
        tail = f.read(16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri}: not a whole id file")
        n = int.from_bytes(tail[:8], "little")
        f.seek(size - 16 - n)
        footer = Footer.unpack(f.read(n))
        f.seek(len(MAGIC))
        blocks = zip(footer.block_ids.tolist(), footer.block_planes.tolist(), strict=True)
        sizes = iter(footer.plane_bytes.tolist())
        left = np.zeros(0, np.uint32)
        docs = zip(footer.doc_ids.tolist(), footer.doc_known.tolist(), footer.doc_tokens.tolist(), strict=True)
        for doc_id, known, tokens in docs:
            parts, missing = [left[:tokens]], tokens - len(left)
            left = left[tokens:]
            while missing > 0:
                n_ids, n_planes = next(blocks)
                block = unpack_block([f.read(next(sizes)) for _ in range(n_planes)], n_ids)
                parts.append(block[:missing])
                left = block[missing:]
                missing -= n_ids
            yield (doc_id if known else None), np.concatenate(parts)


class _Pieces:
    """Pieces of text between white space -> ids. Words of this vocabulary never
    span white space and ignore case, so the pieces' ids in a row are the ids
    of the whole text. Control strings match in their own case only, so pieces
    that hold one in any case keep theirs; so do pieces with ``CAPITALS`` before
    marks, as the library composes before it lowers. Pieces already met are remembered in
    two generations."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # Spark's tasks share the cores; threads of the library cost memory beside them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.control = [t.content.lower().encode() for t in added.values()]
        cuts = [(i, t) for i, t in added.items() if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        #: A control string that cuts a text whatever is beside it, and its id.
        self.cut_id, self.cut_text = (cuts[0][0], cuts[0][1].content) if cuts else (None, "")
        spec = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, *others = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        plain = kinds == PLAIN and split.get("pattern") == {"Regex": PLAIN_WORDS} and [o["type"] for o in others] == ["ByteLevel"]
        #: Signs at the end of a piece that may be encoded without it, and the
        #: tokenizer for letters alone, without the steps that do not change them.
        self.signs, self.letters = (SIGNS if plain else b""), None
        if plain:
            self.letters = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": others[0]}))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _cut(self, texts: pa.Array) -> pa.Array:
        """The pieces of each text as lists. Only ASCII letters are lowered and
        only ASCII white space splits; stops and commas are cut off words."""
        at, data = _layout(texts)
        raw = data.tobytes().lower()
        lower = _strings(at, np.frombuffer(raw, np.uint8))
        cut = pc.ascii_split_whitespace(_part_stops(lower) if self.signs else lower)
        held = np.zeros(len(texts), bool)
        if any(c in raw for c in self.control):
            for c in self.control:
                held |= pc.match_substring(lower, c.decode()).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(data[1:] >= MARKS)
        marked = marked[np.isin(data[marked], np.frombuffer(CAPITALS, np.uint8))]
        held[np.searchsorted(at, marked, side="right") - 1] = True
        held = np.flatnonzero(held)
        if not len(held):
            return cut
        keeps = lambda p, low: any(c in low for c in self.control) or BEFORE_MARKS.search(p)
        own = []
        for text, low in zip(texts.take(held).to_pylist(), lower.take(held).to_pylist(), strict=True):
            pairs = zip(text.encode().split(), low.encode().split(), strict=True)
            own.append([(p if keeps(p, q) else q).decode() for p, q in pairs])
        place = np.arange(len(cut))
        place[held] = len(cut) + np.arange(len(held))
        return pa.concat_arrays([cut, pa.array(own, cut.type)]).take(pa.array(place))

    def _encode_new(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces; ``TOGETHER`` at a time with a control string between
        them, which costs less than as many calls. Pieces that hold one
        themselves are encoded by themselves."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        out: list[bytes] = [b""] * len(texts)
        holds = lambda p: any(c in p for c in self.control)
        apart = range(len(texts)) if self.cut_id is None else []
        if self.cut_id is not None and holds(b" ".join(pieces).lower()):
            apart = [i for i, p in enumerate(pieces) if holds(p.lower())]
        for i, e in zip(apart, self.tokenizer.encode_batch_fast([texts[i] for i in apart], add_special_tokens=False), strict=True):
            out[i] = np.asarray(e.ids, "<u4").tobytes()
        kept = set(apart)
        rest = [i for i in range(len(texts)) if i not in kept]
        others, letters = rest, []
        if self.letters:
            odd = [p.translate(None, LETTERS) for p in pieces]
            letters, others = [i for i in rest if not odd[i]], [i for i in rest if odd[i]]
            for i in letters:
                texts[i] = texts[i].lower()
        for tokenizer, some in ((self.letters, letters), (self.tokenizer, others)):
            groups = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            joined = ["".join([texts[i] + self.cut_text for i in g]) for g in groups]
            encoded = tokenizer.encode_batch_fast(joined, add_special_tokens=False) if groups else []
            for g, e in zip(groups, encoded, strict=True):
                ids, lo = np.array(e.ids, "<u4"), 0
                raw = ids.tobytes()
                for i, at in zip(g, np.flatnonzero(ids == self.cut_id).tolist(), strict=True):
                    out[i] = raw[lo : 4 * at]
                    lo = 4 * at + 4
        return out

    def _learn(self, new: list[bytes]) -> set[bytes]:
        """Remember the ids of new pieces. One that ends with signs has the ids
        of the word before them and theirs, so a word is encoded once, whatever
        follows it; words and signs are remembered too, and returned."""
        here, parts, whole = self.known, [], []
        text = b" ".join(new).lower()
        signs = b"" if any(c in text for c in self.control) else self.signs
        for p in new:
            word = p.rstrip(signs)
            if len(word) < len(p) and word and word[-1] in BEFORE_SIGNS:
                parts.append((p, word, p[len(word) :]))
            else:
                whole.append(p)
        made = {x for _, *both in parts for x in both}.difference(here, whole)
        for part in made:
            if (ids := self.older.get(part)) is not None:
                here[part] = ids
            else:
                whole.append(part)
        here.update(zip(whole, self._encode_new(whole), strict=True))
        here.update([(p, here[word] + here[end]) for p, word, end in parts])
        return made

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces that are all different."""
        out = list(map(self.known.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if len(self.known) + len(missing) > MEMO_PIECES:
            self.older, self.known = self.known, {}
        here, new = self.known, []
        for i in missing:
            p = pieces[i]
            if (ids := self.older.get(p)) is not None:
                here[p] = out[i] = ids
            else:
                new.append(p)
        made = self._learn(new)
        for i in missing:
            if out[i] is None:
                out[i] = here[pieces[i]]
        for p in (*new, *made):
            if len(p) > MEMO_CHARS:
                del here[p]
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text. A piece is looked up once, wherever it stands; its
        ids are then dealt to its places."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary())
        if not len(texts):
            return []
        texts = _strings(*_layout(texts))
        texts.validate(full=True)
        cut = self._cut(texts)
        words = cut.flatten().dictionary_encode()
        at, data = _layout(words.dictionary)
        raw, at = data.tobytes(), at.tolist()
        ids = self._look_up(list(map(raw.__getitem__, map(slice, at, at[1:]))))
        ids = pa.array(ids, pa.large_binary()).take(words.indices)
        at, data = _layout(ids)
        ends = at[np.cumsum(cut.value_lengths().to_numpy())] // 4
        return np.split(data.view("<u4"), ends[:-1])


def _layout(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the strings starts, the end of the last, and their bytes."""
    large = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, at, data = strings.buffers()
    at = np.frombuffer(at, "<i8" if large else "<i4")[strings.offset : strings.offset + len(strings) + 1]
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]


def _strings(at: np.ndarray, data: np.ndarray) -> pa.Array:
    """The strings of a layout. They start at 0, which Arrow's functions need."""
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype("<i4")), pa.py_buffer(data))


def _part_stops(lower: pa.Array) -> pa.Array:
    """The strings with a blank before each stop or comma between an ASCII
    letter or digit and a blank or line end."""
    at, data = _layout(lower)
    stops = np.flatnonzero((data[1:-1] == ord(".")) | (data[1:-1] == ord(","))) + 1
    before, after = data[stops - 1], data[stops + 1]
    ends = (before >= ord("a")) & (before <= ord("z")) | (before >= ord("0")) & (before <= ord("9"))
    stops = stops[ends & ((after == ord(" ")) | (after == ord("\n")))]
    return _strings(at + np.searchsorted(stops, at), np.insert(data, stops, ord(" ")))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and end of runs of ``TEXTS`` texts, or fewer long ones."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = done = 0
    while lo < len(texts):
        fit = int(np.searchsorted(ends, done + TEXT_BYTES, side="right"))
        hi = max(lo + 1, min(lo + TEXTS, fit))
        yield lo, hi
        lo, done = hi, int(ends[hi - 1])


@lru_cache(maxsize=2)
def pieces(path: str) -> _Pieces:
    return _Pieces(path)


may_clear("id files", pieces.cache_clear)


def write(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Encode the texts, append ``end_id`` to each and write the id files in
    ascending doc_id order; returns the manifest, one row a file. ``folder``
    must be one that all executors share."""
    spark = docs.sparkSession
    find_package_on_workers(spark)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    end = np.asarray([end_id], "<u4")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), clean_text(text).alias("text"))
    # The hash lets a run of equal doc_ids be cut; the driver samples both numbers, no text.
    by = [F.col("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_others("id files")
        task, memo = TaskContext.get(), pieces(tokenizer)
        part, number, out, made = task.partitionId(), 0, None, []

        def close():
            name = f"part-{part:06d}-{number:06d}.ids"
            docs_ids = out.docs, out.ids
            made.append((part, number, *docs_ids, out.close(), f"{folder}/{name}"))

        for whole in batches:
            for lo, hi in _slices(whole.column(1)):
                batch = whole.slice(lo, hi - lo)
                encoded = memo.encode(batch.column(1))
                for key, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                    if out is None:
                        out = Writer(f"{folder}/part-{part:06d}-{number:06d}.ids", task.taskAttemptId())
                    out.add(key, np.concatenate([ids, end]))
                    if out.ids >= FILE_IDS:
                        close()
                        out, number = None, number + 1
        if out is not None:
            close()
        if made:
            cols = list(zip(*made, strict=True))
            types = [pa.int64()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=MANIFEST.fieldNames()
            )

    return ranged.mapInArrow(run, MANIFEST)


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of the files that ``manifest`` lists: doc_id, start (ids of
    all documents before it), n_tokens, ids, ids_crc32.

    The driver gathers the manifest only: a few numbers for each file of
    ``FILE_IDS`` ids or each task, never a document."""
    find_package_on_workers(spark)
    files = manifest.orderBy("part", "number").select("path", "ids").collect()
    starts = np.cumsum([0] + [f["ids"] for f in files]).tolist()
    rows = [(i, starts[i], f["path"]) for i, f in enumerate(files)]
    listed = spark.createDataFrame(rows, "file long, start long, path string")
    if rows:
        listed = listed.repartitionByRange(len(rows), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, out = row["start"], []
                for doc_id, ids in read_file(row["path"]):
                    out.append((doc_id, at, ids))
                    at += len(ids)
                    if len(out) == 512:
                        yield _documents(out)
                        out = []
                if out:
                    yield _documents(out)

    return listed.mapInArrow(run, DOCUMENTS)


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    ids = [r[2] for r in rows]
    n = [len(x) for x in ids]
    lists = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32))
    )
    sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array(n, pa.int64()),
            lists,
            pa.array(sums, pa.int64()),
        ],
        names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
    )
