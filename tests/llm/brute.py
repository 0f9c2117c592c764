"""Plain answers to what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

KIND_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[0::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(KIND_PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def secrets(text: str | None) -> list[tuple[int, str, int]]:
    text, out = text or "", []
    assign = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, k, e) for a, _, k, e in sorted(out)]


def shingle_sets(texts: dict, size: int = 5) -> dict:
    out = {}
    for key, text in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
        out[key] = frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else \
            frozenset([tuple(w)] if w else [])
    return out


def components(texts: dict, percent: int = 80) -> dict:
    """key: (number of shingles, smallest key linked)."""
    sets = shingle_sets(texts)
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k)) for k in keys}


def passages(rows: list[tuple], window: int = 35) -> list[tuple]:
    """(key, words, removed, kept) of each row."""
    split = [(key, words(text)) for key, text in rows]
    count = Counter(tuple(w[i:i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def targets(sizes: dict) -> dict:
    """Shares by weight 5, 2, 1, capped at three times the size, the excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed, loose = sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(fixed.values())
        weights = sum(weight[s] for s in loose)
        share = {s: left * weight[s] / weights for s in loose}
        above = {s for s in loose if share[s] > 3 * sizes[s]}
        if not above:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in above})
        loose -= above


def edit_distance_inside(pattern: str, text: str) -> int:
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for char in text:
        new = [0]
        for i, other in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (char != other)))
        row = new
        best = min(best, row[-1])
    return best


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def planted_words(doc_id, found: list[str]) -> list[str]:
    n = len(found)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i if i < a else a + (i - a) % p] for i in range(n)]


def periodic_runs(found: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal stretches of six or more words and four or more periods."""
    n, out = len(found), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and found[j] == found[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                smaller = any(q % d == 0 and all(found[k] == found[k + d] for k in range(i, i + length - d)) for d in range(1, q))
                if not smaller:
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_row(doc_id, text: str | None) -> tuple:
    found = planted_words(doc_id, words(text))
    runs = periodic_runs(found)
    gone = {k for a, length, q in runs for k in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *most, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
            sha(" ".join(w for k, w in enumerate(found) if k not in gone)))
