"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(rb"[^\x20\x09-\x0d]+")
WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))


def fold(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def substring(rows, n=13):
    first = {}
    for d, t in ordered(rows):
        w = SPACED.findall((t or "").encode())
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i:i + n]), d)
    out = []
    for d, t in rows:
        w = SPACED.findall((t or "").encode())
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] != d:
                gone |= set(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(b" ".join(kept))))
    return Counter(out)


def suffix(rows, n=100):
    seen, out = set(), []
    for d, t in ordered(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if b[i:i + n] in seen:
                gone[i:i + n] = b"\1" * n
            seen.add(b[i:i + n])
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return Counter(out)


def leaks(rows, items, n=10):
    wins = defaultdict(set)
    for item, t in items:
        w = WORDS.findall(fold(t))
        for i in range(max(len(w) - n + 1, 1) if w else 0):
            wins[tuple(w[i:i + n])].add(str(item))
    out = []
    for d, t in rows:
        w = WORDS.findall(fold(t))
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                own = wins.get(tuple(w[i:i + size]))
                if own:
                    hit |= set(range(i, i + size))
                    found |= own
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return Counter(out)


def similar_classes(rows, threshold=0.8):
    """Classes by plain five-word shingle sets (equal texts always share one)."""
    def shingles(t):
        w = SPACED.findall((t or "").encode())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    texts = sorted({t or "" for _, t in rows})
    sets, root = {t: shingles(t) for t in texts}, {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    return {t: top(t) for t in texts}


def licenses(text):
    w = WORDS.findall(fold(text))
    starts, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.encode().split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))
