"""Plain Python versions of the operators, one document at a time."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import string
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANKS = " \t\n\x0b\x0c\r"


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    w = words(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    repeated = {p for starts in at.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, again, len(repeated), failed


def class_base(docs):
    """{doc_id: (n_tokens, n_known, base_score)} and the number of training tokens."""
    tokens = {i: [*words(t, lower=True), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = collections.Counter(w for i, d in tokens.items() if not held[i] for w in d)
    n, v = sum(c.values()), len(c)
    one = lambda w: math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))
    return {i: (len(d), sum(c[w] > 0 for w in d), sum(map(one, d))) for i, d in tokens.items()}, n


def near_components(docs, size, percent):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = words(t, lower=True)
        sets[i] = frozenset(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if common and 100 * common >= percent * (len(x) + len(y) - common):
                    one, other = root(a), root(b)
                    up[max(one, other)] = min(one, other)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def cut_windows(docs, size=50):
    """{doc_id: (n_words, n_removed, sha256 of the rest)}."""
    split = {i: words(t) for i, t in docs}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - size + 1):
            first.setdefault(tuple(split[i][j : j + size]), i)
    out = {}
    for i, w in split.items():
        gone = {p for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] < i for p in range(j, j + size)}
        out[i] = len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def paragraphs(text, long=1000, every=48):
    """Lines; long ones are cut after each word whose hash is a multiple of ``every``."""
    out = []
    for line in text.split("\n"):
        if len(line) <= long:
            out.append(line)
            continue
        piece = []
        for word in line.split(" "):
            piece.append(word)
            h = xxhash.xxh64_intdigest(word.encode(), 42)
            if (h - (h >> 63 << 64)) % every == 0:  # signed, as in SQL
                out.append(" ".join(piece))
                piece = []
        if piece:
            out.append(" ".join(piece))
    return out


def likeness(a, b):
    x, y = set(paragraphs(a)), set(paragraphs(b))
    return len(x & y) / len(x | y)


def line_dedup(docs, least_chars=40, least_docs=5):
    """{doc_id: (n_lines, n_dropped, text)}."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = collections.defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    common = {k: max(h) for k, h in holders.items() if len(h) >= least_docs}
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if common.get(key(x), i) == i]
        out[i] = len(lines), len(lines) - len(stay), "\n".join(stay)
    return out
