"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

GAP_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def groups(ids, pairs):
    """{id: smallest id reachable}"""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def repeated_bytes(texts, length=100, kept_texts=None):
    """Digests by id; the texts themselves go into ``kept_texts``."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        if kept_texts is not None:
            kept_texts[i] = None if texts[i] is None else kept.decode(errors="ignore")
        out[i] = (len(data), sum(gone), spans, sha(kept))
    return out


def repeated_words(texts, length=50):
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first, out = {}, {}
    for i in sorted(words):
        for p in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][p : p + length]), i)
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < i:
                gone[p : p + length] = [True] * length
        out[i] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def near_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    component = groups(ids, pairs)
    return {i: (len(sets[i]), component[i], component[i] == i) for i in ids}


def contamination(texts, items):
    grams = defaultdict(set)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words_of = lambda t: GAP_WORDS.findall((t or "").translate(lower))
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[p : p + n])].add(item)
    out = {}
    for i, text in texts.items():
        w = words_of(text)
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                owners = grams.get(tuple(w[p : p + n]))
                if owners:
                    hit |= set(range(p, p + n))
                    found |= owners
        names = ",".join(sorted(map(str, found)))
        out[i] = (len(w), len(hit), len(found), sha(names), bool(hit))
    return out
