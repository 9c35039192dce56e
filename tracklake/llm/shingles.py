"""Word shingles of many texts at once, as 64-bit hashes.

Words are runs of bytes other than white space (space, tab to carriage return)
with A to Z lower-cased. A word's hash is a polynomial over random byte values,
read off prefix sums of the whole batch, so no word is touched by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(0x5EED)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_C1, _C2, _C3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes of text handled at a time (a longer text is handled alone).
BATCH_BYTES = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _C1
    h = (h ^ (h >> np.uint64(29))) * _C2
    return h ^ (h >> np.uint64(32))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _INVERSE)):
            table = np.full(max(n, BATCH_BYTES * 2), base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _unique(h: np.ndarray) -> np.ndarray:
    if len(h) < 2:
        return h
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of ``size`` words of each text; a text of
    fewer words has its whole sequence as one, a text without words none."""
    out: list[np.ndarray] = []
    group, total = [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        if group and total + len(raw) > BATCH_BYTES:
            out.extend(_sets(group, size))
            group, total = [], 0
        group.append(raw)
        total += len(raw) + 1
    out.extend(_sets(group, size))
    return out


def _sets(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not group:
        return
    whole = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
    n = len(whole)
    power, inverse = _powers_to(n + 1)
    inside = ~_SPACE[whole]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]  # the batch ends in white space
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[whole] * power[:n], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _C3)
    rolled = words
    for k in range(1, size):
        rolled = mixed(rolled[:-1] * _C3 + words[k:]) if len(words) > k else rolled[:0]
    text_starts = np.cumsum([0] + [len(g) + 1 for g in group])
    bounds = np.searchsorted(starts, text_starts).tolist()
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        if hi - lo >= size:
            yield _unique(rolled[lo : hi - size + 1])
        elif hi > lo:
            h = np.array([hi - lo], np.uint64)
            for w in words[lo:hi]:
                h = mixed(h * _C3 + w)
            yield h
        else:
            yield words[:0]
