"""What the operators must give, computed plainly on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def of(rows):
    """(id, text) with a NULL id in front of all others."""
    return sorted(((-(2**63) if d is None else d), (t or "").encode()) for d, t in rows)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def lines(rows):
    where = defaultdict(set)
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    for d, t in of(rows):
        for x in t.split(b"\n"):
            if len(key(x).decode()) >= 10:
                where[key(x)].add(d)
    out = Counter()
    for d, t in of(rows):
        all_ = t.split(b"\n")
        kept = [x for x in all_ if not (len(where.get(key(x), ())) > 1 and min(where[key(x)]) != d)]
        out[d, len(all_), len(all_) - len(kept), sha(b"\n".join(kept))] += 1
    return out


def _covered(tokens, n, first, d):
    gone = [False] * len(tokens)
    for i in range(len(tokens) - n + 1):
        if first[tokens[i:i + n]] != (d, i):
            gone[i:i + n] = [True] * n
    return gone


def _first(all_, n):
    first = {}
    for d, tokens in all_:
        for i in range(len(tokens) - n + 1):
            w = tokens[i:i + n]
            first[w] = min(first.get(w, (d, i)), (d, i))
    return first


def strings(rows, n=100):
    all_ = of(rows)
    first = _first(all_, n)
    out = Counter()
    for d, t in all_:
        gone = _covered(t, n, first, d)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d, len(t), sum(gone), runs, sha(bytes(b for b, g in zip(t, gone) if not g))] += 1
    return out


def passages(rows, n=20):
    all_ = [(d, tuple(t.split())) for d, t in of(rows)]
    first = _first(all_, n)
    out = Counter()
    for d, w in all_:
        gone = _covered(w, n, first, d)
        out[d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))] += 1
    return out


def components(rows, size=5, percent=75):
    sets, docs = [], of(rows)
    for _, t in docs:
        w = t.lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for own in holders.values() for i, b in enumerate(own) for a in own[:i])
    for (i, j), both in shared.items():
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(docs[i][0]), root(docs[j][0])))
            parent[b] = a
    return Counter((d, len(s), root(d)) for (d, _), s in zip(docs, sets))


WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def hits(text, items, n=10):
    w = WORD.findall((text or "").encode().lower())
    covered, found = set(), set()
    for item, t in items:
        own = WORD.findall((t or "").encode().lower())
        m = min(n, len(own))
        for i in range(len(own) - m + 1) if own else ():
            for j in range(len(w) - m + 1):
                if w[j:j + m] == own[i:i + m]:
                    covered.update(range(j, j + m))
                    found.add(item)
    return len(w), len(covered), sorted(found)


def repeats(text, n=8):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    seen = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    in_ = set()
    for i in range(len(w) - n + 1):
        if seen[tuple(w[i:i + n])] > 1:
            in_.update(range(i, i + n))
    return len(w), len(in_)


def tree_log10(train, text, depth):
    """Log10 probability of a byte stream under context-tree weighting, node by node."""
    end = b"\n"
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def nodes(stream):
        z = end * depth + stream
        for i in range(depth, len(z)):
            yield z[i - depth:i][::-1], [((1 << j) | (z[i] >> (8 - j)), (z[i] >> (7 - j)) & 1) for j in range(8)]

    for stream in train:
        for context, bits in nodes(stream):
            for node, bit in bits:
                for k in range(depth + 1):
                    counts[context[:k], node][bit] += 1
                    if k:
                        children[context[:k - 1], node].add(context[:k])
    lg, weight, share = math.lgamma, {}, {}
    for (context, node), (a, b) in sorted(counts.items(), key=lambda x: -len(x[0][0])):
        own = lg(a + .5) + lg(b + .5) - lg(a + b + 1) - math.log(math.pi)
        if len(context) == depth:
            weight[context, node] = own
        else:
            below = sum(weight[c, node] for c in children[context, node])
            top = max(own, below)
            weight[context, node] = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
            share[context, node] = 1 / (1 + math.exp(min(700, max(-700, below - own))))
    total = 0.0
    for context, bits in nodes(text):
        for node, bit in bits:
            p = None
            for k in range(depth, -1, -1):
                a, b = counts.get((context[:k], node), (0, 0))
                own = (b + .5) / (a + b + 1)
                s = share.get((context[:k], node), .5)
                p = own if p is None else s * own + (1 - s) * p
            total += math.log10(p if bit else 1 - p)
    return total
