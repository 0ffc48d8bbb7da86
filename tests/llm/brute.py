"""Plain single-process versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    toks = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not toks:
        return 0
    grams = [" ".join(toks[i : i + 4]) for i in range(max(1, len(toks) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(rows):
    """rows: (id, text) -> sorted (id, fingerprint, component)."""
    fps = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for (d, _), f in zip(rows, fps)]


def strip(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        end = 0
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                a = max(i, end)
                gone[a : i + length] = b"\1" * (i + length - a)
                end = i + length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PII = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (
        re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        lambda m: all(int(p) <= 255 for p in m.split(".")),
    ),
    "card": (
        re.compile(r"[0-9]([\x20-]?[0-9])+"),
        lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
    ),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def pii(text):
    """(counts per kind, list of the base spans)."""
    found = []
    counts = []
    for rank, (kind, (pattern, valid)) in enumerate(PII.items()):
        hits = [m for m in pattern.finditer(text or "") if valid(m[0])]
        counts.append(len(hits))
        found += [(m.start(), rank, kind, m.end()) for m in hits]
    return counts, [f"{k}:{s}:{e}" for s, _, k, e in sorted(found)]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """sizes: source -> words; the reshared targets."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = goal - sum(fixed.values())
        got = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        above = [s for s in rest if got[s] > most * sizes[s]]
        if not above:
            return fixed | got
        fixed |= {s: most * sizes[s] for s in above}


def base_scores(rows):
    """rows: (id, text) -> list of (held_out, n_tokens, n_known, train_tokens, base_score)."""
    split = [
        (zlib.crc32(str("" if d is None else d).encode()) % 7 == 2, words(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
        for d, t in rows
    ]
    end = object()
    counts = Counter(x for held, toks in split if not held for x in [*toks, end])
    n, v = sum(counts.values()), len(counts)
    return [
        (
            held,
            len(toks) + 1,
            sum(1 for x in [*toks, end] if counts[x]),
            n,
            sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*toks, end]),
        )
        for held, toks in split
    ]
