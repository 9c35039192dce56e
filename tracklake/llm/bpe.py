"""Byte-level BPE encoding and decoding (operator 3).

Encoding keeps the symbols of a word in a doubly linked list and the ranks of
all mergeable neighbours in a priority queue; an entry that no longer matches
the list when it is popped is stale and skipped. Decoding concatenates the
vocabulary strings of the ids. The vocabulary file is a parameter and is read
once in each Python worker; pieces already met are kept in a bounded memo.

Results on odd input: a null text encodes as the empty text (no ids) and
decodes to the empty text; the string of an added token inside a text becomes
that token's id; null ids decode to the empty text; an id outside the
vocabulary is skipped; bytes that are no UTF-8 decode to U+FFFD. Rows are
independent, so repeated rows give repeated results and an empty table gives
an empty one. Existing columns named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import string
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracklake.llm.common import map_rows, may_clear

# Fixed value: the word pattern of byte-level BPE vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Two white-space characters in a row, or one at either end: what follows a
#: single blank inside such a run may belong with what stands before it.
RUNS = re.compile(r"\s\s|^\s|\s\Z")


class _RunFound(Exception):
    """A piece between blanks is empty or has a run of white space."""


#: ASCII signs: a run of them after a word is one word.
SIGNS = string.punctuation

#: Pieces remembered by one Python worker in each generation, and the longest.
MEMO_PIECES, MEMO_CHARS = 200_000, 64


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable bytes stand for
    themselves, the rest take the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Memo(dict):
    """Piece -> packed ids. When it is full, the pieces of the generation
    before are forgotten unless met again, which costs time only."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        if spec["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        if any(t.get(flag) for t in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: added tokens that take blanks, or whole words only, are not supported")
        vocab: dict[str, int] = spec["model"]["vocab"]
        chars = byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.first = [vocab[c] for c in chars]
        self.base = len(vocab)
        self.ranks: dict[int, int] = {}  # left id * base + right id -> rank
        self.made: list[int] = []  # rank -> id of the merged symbol
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a] * self.base + vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in token) if set(token) <= byte_of.keys() else token.encode()
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})") if self.added else None
        self.words = regex.compile(WORDS)
        self.word_ids = _Memo(self.encode_word)
        self.blank_ids = _Memo(self.encode_after_blank)

    def encode_word(self, word: str) -> bytes:
        """Merge the word's bytes, lowest rank first, leftmost first at ties."""
        ids = [*map(self.first.__getitem__, word.encode("utf-8", "replace"))]
        n, base, rank_of = len(ids), self.base, self.ranks.get
        # A queue entry is a rank and, in the low bits, a place; ``at`` has the
        # one that holds for each place, and any other there is stale.
        bits = n.bit_length()
        at = [-1 if (r := rank_of(a * base + b)) is None else r << bits | i for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))]
        queue = [e for e in at if e >= 0]
        if queue:
            made, low, pop, push = self.made, (1 << bits) - 1, heapq.heappop, heapq.heappush
            at.append(-1)
            before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
            heapq.heapify(queue)
            while queue:
                entry = pop(queue)
                i = entry & low
                if at[i] != entry:
                    continue
                j = after[i]
                new = ids[i] = made[entry >> bits]
                ids[j] = at[i] = at[j] = -1
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    if (r := rank_of(new * base + ids[k])) is not None:
                        at[i] = r << bits | i
                        push(queue, at[i])
                if (h := before[i]) >= 0:
                    if (r := rank_of(ids[h] * base + new)) is not None:
                        at[h] = r << bits | h
                        push(queue, at[h])
                    else:
                        at[h] = -1
            ids = [i for i in ids if i >= 0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_run(self, text: str) -> bytes:
        """Encode a text word by word; added tokens count as text."""
        return b"".join(map(self.word_ids.__getitem__, self.words.findall(text)))

    def encode_after_blank(self, piece: str) -> bytes:
        """Encode a blank and the piece after it, up to the next blank. A word
        with its blank is remembered once, as the piece without it."""
        word = piece.rstrip(SIGNS)
        if word.isalpha():
            return self.encode_word(" " + word) if len(word) == len(piece) else self.blank_ids[word] + self.word_ids[piece[len(word) :]]
        if not piece or RUNS.search(piece):
            raise _RunFound
        word, *rest = self.words.findall(" " + piece)
        if not rest:
            return self.encode_word(word)
        return self.blank_ids[word[1:]] + b"".join(map(self.word_ids.__getitem__, rest))

    def encode_plain(self, text: str) -> bytes:
        """As ``encode_run``. Between two other characters a single blank starts
        a word, so the text may be cut there and each piece remembered. A run of
        white space shows in a piece that is not remembered."""
        first, *rest = text.split(" ")
        if rest and (not first or RUNS.search(first)):
            return self.encode_run(text)
        try:
            return self.encode_run(first) + b"".join(map(self.blank_ids.__getitem__, rest))
        except _RunFound:
            return self.encode_run(text)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_added is None or not self.split_added.search(text):
            return self.encode_plain(text)
        parts = self.split_added.split(text)
        return b"".join(
            self.added[p].to_bytes(4, "little") if p in self.added else self.encode_plain(p) for p in parts if p
        )

    def decode(self, ids) -> str:
        known = self.strings
        return b"".join([known[i] for i in ids if i is not None and 0 <= i < len(known)]).decode("utf-8", "replace")

    def decode_packed(self, packed: bytes) -> str:
        """As ``decode``, of what ``encode`` made: no id is null or unknown."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


may_clear("bpe", codec.cache_clear)


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed])
    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", digest: str | None = None) -> DataFrame:
    """Add ``ids`` (array<int>) and, if named, ``digest``: the lowercase hex
    SHA-256 of the ids as little-endian unsigned 32-bit integers."""

    def make():
        c = codec(path)

        def apply(texts):
            packed = [c.encode(t) for t in texts]
            sums = ([hashlib.sha256(p).hexdigest() for p in packed],) if digest else ()
            return (_lists(packed), *sums)

        return apply

    outputs = [(ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))]
    if digest:
        outputs.append((digest, T.StringType(), pa.string()))
    return map_rows(df, [text], outputs, make, owner="bpe")


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``: the concatenated vocabulary strings of ``ids``."""

    def make():
        c = codec(path)
        return lambda lists: ([c.decode(x or ()) for x in lists],)

    return map_rows(df, [ids], [(text, T.StringType(), pa.string())], make, owner="bpe")


def round_trip(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", back: str = "decoded", digest: str | None = None
) -> DataFrame:
    """Add ``ids``, ``back`` (the text decoded from them) and, if named,
    ``digest``, as ``encode`` and then ``decode`` would, in one pass: the ids
    need not travel between two Python workers of a task, which would each
    hold the vocabulary and the pieces remembered."""

    def make():
        c = codec(path)

        def apply(texts):
            packed = [c.encode(t) for t in texts]
            decoded = [c.decode_packed(p) for p in packed]
            sums = ([hashlib.sha256(p).hexdigest() for p in packed],) if digest else ()
            return (_lists(packed), decoded, *sums)

        return apply

    outputs = [(ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), (back, T.StringType(), pa.string())]
    if digest:
        outputs.append((digest, T.StringType(), pa.string()))
    return map_rows(df, [text], outputs, make, owner="bpe")
