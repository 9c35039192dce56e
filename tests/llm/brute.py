"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict


def components(n, edges):
    """Smallest index of each node's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset({tuple(words)}) if words else frozenset()


def jaccard_links(texts, k, num, den):
    sets = [shingles(t, k) for t in texts]
    holders, links = defaultdict(list), []
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += 1
            holders[x].append(i)
        links += [(j, i) for j, c in common.items() if den * c >= num * (len(s) + len(sets[j]) - c)]
    return sets, links


KINDS = ("email", "ip", "card", "phone", "term")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def personal_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    found = [
        (m.start(), kind, m.end()) for kind, (pattern, ok) in enumerate(tests) for m in re.finditer(pattern, text or "") if ok(m.group())
    ]
    return sorted(found)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in spans)
