"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def near(rows, width, num, den):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in groups[top(i)] if x is not None]
        least = min(ids) if ids else None
        out.append((d, len(sets[i]), least, d is not None and d == least))
    return out


def repeats(rows, least):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + least] for t in data for i in range(len(t) - least + 1))
    out = []
    for (d, _), t in zip(rows, data, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if seen[t[i:i + least]] > 1:
                gone[i:i + least] = b"\1" * least
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone, strict=True) if not g))))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    told = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
    return [sum(k == i for _, k, _ in found) for i in range(3)], sha(told)


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def packed(rows, ids_of):
    """Checks pieces against the documents' ids; returns padding and tokens."""
    docs = Counter((d, len(ids_of[d, t]), zlib.crc32(ids_of[d, t].tobytes())) for d, t in rows)
    return docs
