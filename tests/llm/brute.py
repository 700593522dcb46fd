"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width=5):
    words = WORD.findall(ascii_lower(text or ""))
    if len(words) >= width:
        return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def groups(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = [i for i, s in sets.items() if s]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    part = groups(links, ids)
    return {i: (len(s), part.get(i, i)) for i, s in sets.items()}


ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    out.sort()
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in out)
    return (*(sum(k == j for _, k, _ in out) for j in range(3)), hashlib.sha256(listed.encode()).hexdigest())


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def _hash(text, seed=42):
    h = xxhash.xxh64_intdigest(text.encode(), seed=seed)
    return h - (1 << 64) if h >> 63 else h


def _hash_longs(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h)
    return h - (1 << 64) if h >> 63 else h


def line_chunks(text, mean_lines=3):
    lines = text.split("\n")
    hashes = [_hash(x) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (i and _hash_longs(hashes[i - 1 : i + 1]) % mean_lines == 0):
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def line_dedup(rows, mean_lines=3):
    """``rows``: (id, text); gives (text, removed lines) per row."""
    at = {}
    cut = [(i, None if t is None else line_chunks(t, mean_lines)) for i, t in rows]
    counts = lambda c: sum(bool(WORD.search(x)) for x in c) >= 2
    for i, cs in cut:
        for k, c in enumerate(cs or ()):
            if counts(c):
                at.setdefault("\n".join(c), set()).add((i, k))
    out = []
    for i, cs in cut:
        if cs is None:
            out.append((None, 0))
            continue
        kept = [c for k, c in enumerate(cs) if not counts(c) or min(at["\n".join(c)]) == (i, k)]
        out.append(("\n".join(x for c in kept for x in c) if len(kept) < len(cs) else "\n".join(x for c in cs for x in c), sum(map(len, cs)) - sum(map(len, kept))))
    return out


def chunk_lines(rows, mean_lines=3):
    """``rows``: (id, text); gives the numbers of the lines in removed chunks, by id."""
    at, cut, out = {}, {}, {}
    for i, t in rows:
        cut[i], start = [], 0
        for c in line_chunks(t, mean_lines):
            if sum(bool(WORD.search(x)) for x in c) >= 2:
                cut[i].append(("\n".join(c), start, len(c)))
                at.setdefault("\n".join(c), set()).add((i, start))
            start += len(c)
    for i, chunks in cut.items():
        out[i] = {k for body, a, n in chunks if min(at[body]) != (i, a) for k in range(a, a + n)}
    return out


def mix(rows, weights=(5, 2, 1), budget=1.5, repeat=2, seed="mix-1"):
    """``rows``: (id, source, size); gives taken words per row, in order."""
    totals = Counter()
    for _, s, n in rows:
        totals[s] += n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), budget * sum(totals.values())
    while True:
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / share > repeat * totals[s]]
        if not over:
            target |= {s: left * weight[s] / share for s in open_}
            break
        for s in over:
            target[s] = float(repeat * totals[s])
            open_.discard(s)
            left -= target[s]
        if not open_:
            break
    md5 = lambda x: hashlib.md5(f"{seed}|{x}".encode()).hexdigest()
    taken = [0] * len(rows)
    for s in order:
        mine = sorted((n, md5(i), i, k) for k, (i, t, n) in enumerate(rows) if t == s)
        step = int(target[s] / totals[s] * 2**24) if totals[s] else 0
        at = int(md5("<null>" if s is None else s)[:6], 16)
        for n, _, _, k in mine:
            taken[k] = n * ((at + step >> 24) - (at >> 24))
            at += step
    return target, taken


def cosine_groups(vectors, threshold=0.95):
    """``vectors``: id -> list or None; gives (links, component) by id."""
    unit = {}
    for i, v in vectors.items():
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v, float)
            unit[i] = x / np.linalg.norm(x)
    pairs = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    part = groups(pairs, list(vectors))
    degree = Counter(x for p in pairs for x in p)
    return {i: (degree[i], part[i]) for i in vectors}


def quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(8)}
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n)
