"""The contracts in plain Python, to hold the operators against."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


class Sets:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard_components(rows, n, percent):
    """doc_id -> (set size, component); ids are distinct."""
    sets = {d: shingles(t, n) for d, t in rows}
    groups, holders = Sets(sets), defaultdict(list)
    for d in sorted(sets):
        shared = Counter(e for x in sets[d] for e in holders[x])
        for x in sets[d]:
            holders[x].append(d)
        for e, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                groups.join(d, e)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def without_repeats(rows, span):
    """doc_id -> (bytes, removed, spans, sha256 of the rest, the rest)."""
    first, out = {}, {}
    texts = {d: (t or "").encode() for d, t in rows}
    for d in sorted(texts):
        for i in range(len(texts[d]) - span + 1):
            first.setdefault(texts[d][i : i + span], d)
    for d, b in texts.items():
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if first[b[i : i + span]] < d:
                gone[i : i + span] = b"\1" * span
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest)
    return out


def cosine_links(rows, least):
    """vec_id -> (links, component) for valid vectors of equal labels."""
    def ok(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = {}
    for i, v, label in rows:
        if ok(v, label):
            norm = math.sqrt(sum(x * x for x in v))
            unit[i] = (label, [x / norm for x in v])
    groups, links = Sets([i for i, _, _ in rows]), Counter()
    ids = sorted(unit)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            (la, a), (lb, b) = unit[i], unit[j]
            if la == lb and len(a) == len(b) and sum(x * y for x, y in zip(a, b, strict=True)) >= least:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return {i: (links[i], groups.find(i)) for i, _, _ in rows}


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


PIECE = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def pieces(text):
    return PIECE.findall((text or "").translate(LOWER))


def ranked(rows, items, k):
    """Rows (item, rank, doc, score); ``rows`` (doc, text) may repeat, ``items`` (item, text) with one id are one."""
    terms = [(d, pieces(t)) for d, t in rows]
    n_docs, n_terms = sum(1 for _, ts in terms if ts), sum(len(ts) for _, ts in terms)
    holders = Counter(t for _, ts in terms for t in set(ts))
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(pieces(t))
    out = []
    for i, wanted in asked.items():
        found = []
        for d, ts in terms:
            times, score = Counter(ts), 0
            for t in wanted & set(ts):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                score += weight * (10**9 * times[t] // (1000 * times[t] + 20 * (50 + 50 * len(ts) * n_docs // n_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k], 1)]
    return out


def passages(rows, items, window=10, shingle=3, least=100):
    """Per row: (doc, words, spans, items)."""
    wanted = set()
    for i, t in items:
        ws = pieces(t)
        wanted.update((i, tuple(ws[o : o + window])) for o in range(max(1, len(ws) - window + 1)) if ws)
    out = []
    for d, t in rows:
        ws, hit, held = pieces(t), set(), set()
        for i, w in wanted:
            size = min(shingle, len(w))
            k = len(w) - size + 1
            for o in range(len(ws) - len(w) + 1):
                same = sum(tuple(ws[o + j : o + j + size]) == w[j : j + size] for j in range(k))
                if 100 * same >= least * k and same:
                    hit.update(range(o, o + len(w)))
                    held.add(i)
        spans = [p for p in sorted(hit) if p - 1 not in hit]
        ends = [p + 1 for p in sorted(hit) if p + 1 not in hit]
        out.append((d, len(ws), list(zip(spans, ends, strict=True)), held))
    return out


def coded(rows, parts, entries, rounds):
    """vec_id -> (code, error) and codebooks; ids are distinct, vectors valid and of one length."""
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    step = len(next(iter(whole.values()))) // parts
    cut = {i: [v[p * step : (p + 1) * step] for p in range(parts)] for i, v in whole.items()}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for i in cut:
                members[nearest(cut[i][p], book)[1]].append(cut[i][p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if members[e] else old for e, old in enumerate(book)]
    found = {i: [nearest(cut[i][p], books[p]) for p in range(parts)] for i in cut}
    return {i: ("".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for i, f in found.items()}, books
