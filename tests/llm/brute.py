"""Plain loops over small tables, independent of the package."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def jaccard_components(rows, percent=75):
    """``rows``: (doc_id, text); a list of (doc_id, n, component)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))
    same = {}
    for i, s in enumerate(sets):
        parent[i] = same.setdefault(frozenset(s), i) if s else i

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(set)
    once = sorted(same.values())
    for i in once:
        for x in sets[i]:
            index[x].add(i)
    for i in once:
        s = sets[i]
        shared = defaultdict(int)
        for x in s:
            if len(index[x]) > 1:
                for j in index[x]:
                    shared[j] += j < i
        for j, both in shared.items():
            if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return [(d, len(s), (min(ids[find(i)]) if ids[find(i)] else None) if s else d)
            for i, ((d, _), s) in enumerate(zip(rows, sets))]


def contamination(docs, items, span=10):
    """{doc_id: (n_words, n_hit, sorted item ids)} of unique ids."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out[doc] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def sha1(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def crc(data):
    return zlib.crc32(data)


def held_out(doc_id):
    return crc(str(doc_id).encode()) % 5 == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()
