"""Plain versions of the operators, to compare with on small tables."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def secrets(text):
    """Base spans, straight from the contract's patterns."""
    spans = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    pattern = re.compile("(?i:" + assign + ")([A-Za-z0-9+/_.=-]+)", re.ASCII)
    spans += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    spans.sort()
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    counts = [sum(k == i for _, k, _ in spans) for i in range(3)]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest(), listed)


def removed(rows, length=50):
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` for rows ``(id, text)``; a null id is below all."""
    rows = sorted((-(2**63) if i is None else i, (t or "").encode(), i) for i, t in rows)
    first = {}
    for key, raw, _ in rows:
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p : p + length], key)
    out = []
    for key, raw, name in rows:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < key:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((name, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, shingle=4, seed=42):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    pieces = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = [0] * 64
    for piece in pieces:
        value = xxhash.xxh64_intdigest(piece.encode(), seed)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(pieces))


def roots(values, distance):
    """Least place of each value's component, by all pairs."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(values))]


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by source, excess shared again round by round; ``None`` last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / share > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else left * weight[s] / share for s in names}
        full |= over


def top(vectors, asks, k=5):
    """``query, rank, id, score`` from ``(id, vector)``."""
    whole = {}
    for name, vector in vectors:
        if vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole[name] = [int(np.floor(256.0 * float(x))) for x in vector]
    out = []
    for q in whole:
        if asks(q):
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), n) for n, v in whole.items() if n != q)
            out += [(q, rank, n, -score) for rank, (score, n) in enumerate(scored[:k], 1)]
    return out


def crc(text):
    return zlib.crc32((text or "").encode())
