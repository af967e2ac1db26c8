"""Plain versions of the operators, to hold results against."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "ba ce di fo gu ha ke li mo nu pra ste tri vol wex yam".split()


def words(text):
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def bag(text, k=5):
    w = words(text)
    return Counter(tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)) if w else Counter()


def similarity(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def near_classes(rows):
    """doc_id -> least doc_id of its class, by comparing all pairs."""
    rows = [(i, t) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a is not None and b is not None and (a == b or similarity(a, b) >= 0.8):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}


def remove_repeats(rows, length=20):
    """doc_id -> (n_words, n_removed, kept words)."""
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            g = tuple(w[s : s + length])
            if seen.setdefault(g, (i, s)) != (i, s):
                gone[s : s + length] = [True] * length
        out[i] = (len(w), sum(gone), " ".join(x for x, y in zip(w, gone, strict=True) if not y))
    return out


def features(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    repeated = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def tiling(doc, item, k=5):
    """Greedy string tiling of two word lists: lengths of the tiles."""
    used_doc, used_item, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in used_doc and j + n not in used_item:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return out
        used_doc.update(range(i, i + n))
        used_item.update(range(j, j + n))
        out.append(n)


ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """The fixed patterns' spans as (start, kind, end)."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)
