"""The contracts of the text operators over plain lists, by the plainest means."""

import collections
import hashlib
import itertools
import math
import re
import zlib

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def words(text):
    return [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOW))]


def tokens(text, lower=True):
    raw = (text or "").encode()
    return (raw.translate(LOW) if lower else raw).split()


def decontamination(docs, items, size=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        if w and i is not None:
            k = min(size, len(w))
            for s in range(len(w) - k + 1):
                windows[tuple(w[s : s + k])].add(str(i))
    sizes, out = {len(k) for k in windows}, []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if got := windows.get(tuple(w[s : s + k])):
                    found |= got
                    hit.update(range(s, s + k))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def substrings(docs, size=13):
    first = {}
    for d, t in docs:
        if d is not None:
            w = tokens(t, False)
            for s in range(len(w) - size + 1):
                g = tuple(w[s : s + size])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t in docs:
        w = tokens(t, False)
        gone = {p for s in range(len(w) - size + 1) for p in range(s, s + size) if d is not None and first[tuple(w[s : s + size])] < d}
        out.append((d, len(w), len(gone), sha(b" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def shingles(text, n):
    w = tokens(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_dups(docs, n=3, percent=85):
    sets, up = [(d, shingles(t, n)) for d, t in docs], {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return [(d, len(x), None if d is None else root(d) if x else d, True if d is None or not x else root(d) == d) for d, x in sets]


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, v):
    digits = re.sub(r"[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def personal(docs):
    out = []
    for d, t in docs:
        spans = [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, t or "") if valid(k, m.group(0))]
        n = collections.Counter(x[0] for x in spans)
        out.append((d, *(n[k] for k in KINDS), sha(",".join("%s:%d:%d" % x for x in spans))))
    return out


PHRASES = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}


def licenses(docs):
    out = []
    for d, t in docs:
        w = words(t)
        at = sorted((s, label) for p, label in PHRASES.items() for s in range(len(w)) if tuple(w[s : s + len(p)]) == p)
        out.append((d, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    return out


def bigram(docs, mu):
    """(held out, tokens, known, training tokens, base score, score) of each row."""
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    toks = [[*tokens(t), None] for _, t in docs]
    c, pairs, rows = collections.Counter(), collections.Counter(), 0
    for h, w in zip(held, toks):
        if not h:
            c.update(w)
            pairs.update(zip([0, *w[:-1]], w))
            rows += 1
    n, z = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    out = []
    for h, w in zip(held, toks):
        base = sum(math.log10((c[x] + 0.5) / z) for x in w)
        score = sum(math.log10((pairs[v, x] + mu * (c[x] + 0.5) / z) / ((rows if v == 0 else c[v]) + mu)) for v, x in zip([0, *w[:-1]], w))
        out.append((h, len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out
