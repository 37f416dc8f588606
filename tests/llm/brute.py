"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    found = SPACED.findall((text or "").translate(FOLD))
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))} if found else set()


def groups(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """For each id: the size of its set and the smallest linked id."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)), key=lambda k: docs[k][0])
                parent[y] = x
    return {key: (len(sets[i]), docs[root(i)][0]) for i, (key, _) in enumerate(docs)}


def contamination(docs, items, length: int = 13) -> dict[int, tuple]:
    """For each id: n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = defaultdict(set)
    for item, text in items:
        found = ITEM_WORD.findall((text or "").translate(FOLD))
        for i in range(max(1, len(found) - length + 1) if found else 0):
            windows[tuple(found[i : i + length])].add(str(item))
    out = {}
    for key, text in docs:
        found = ITEM_WORD.findall((text or "").translate(FOLD))
        hit, names = np.zeros(len(found), bool), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                own = windows.get(tuple(found[i : i + size]))
                if own:
                    hit[i : i + size] = True
                    names |= own
        n = int(hit.sum())
        bad = n > 0 and 20 * n >= len(found)
        out[key] = len(found), n, len(names), sha(",".join(sorted(names))), bad
    return out


def repeated(docs, split, length: int = 50) -> dict[int, tuple[list, np.ndarray]]:
    """For each id: its sequence and which places lie in a window that an earlier document has."""
    sequences = {key: split(text or "") for key, text in docs}
    first: dict = {}
    for key, s in sequences.items():
        for i in range(len(s) - length + 1):
            window = tuple(s[i : i + length])
            first[window] = min(first.get(window, key), key)
    out = {}
    for key, s in sequences.items():
        hit = np.zeros(len(s), bool)
        for i in range(len(s) - length + 1):
            if first[tuple(s[i : i + length])] < key:
                hit[i : i + length] = True
        out[key] = s, hit
    return out


def kept_words(docs) -> dict[int, tuple[int, int, str]]:
    return {
        key: (len(s), int(hit.sum()), " ".join(w for w, h in zip(s, hit) if not h))
        for key, (s, hit) in repeated(docs, SPACED.findall).items()
    }


def kept_bytes(docs) -> dict[int, tuple[int, int, int, bytes]]:
    out = {}
    for key, (s, hit) in repeated(docs, lambda t: list(t.encode())).items():
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out[key] = len(s), int(hit.sum()), runs, bytes(b for b, h in zip(s, hit) if not h)
    return out
