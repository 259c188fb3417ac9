"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def kept_words(rows, n):
    """Op 1 over (doc_id, text) with distinct ids."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone[i : i + n] = [True] * n
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(rows):
    """doc_id -> (set size, smallest linked doc_id), by all pairs."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (len(x), find(d)) for d, x in sets}


def measures(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    t = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    found.sort()
    return [(k, a, b) for a, _, b, k in found]


def base_digest(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)).encode()).hexdigest()


def leaks(docs, items, least=0.8):
    """(doc_id, item_id) -> the best weighted Jaccard similarity of an item-sized window, over all windows of documents that share a
    shingle with the item."""
    out = {}
    where = defaultdict(set)
    bags = {}
    for i, t in items:
        w = words(t.lower())
        bags[i] = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        for g in bags[i]:
            where[g].add(i)
    for d, t in docs:
        w = words((t or "").lower())
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        for i in {i for g in grams for i in where.get(g, ())}:
            n = min(sum(bags[i].values()) + 4, len(w))
            best = 0
            for s in range(len(w) - n + 1):
                bag = Counter(grams[s : s + n - 4])
                best = max(best, sum((bag & bags[i]).values()) / sum((bag | bags[i]).values()))
            if best >= least:
                out[d, i] = best
    return out


def judge_url(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fits = []
    for verdict, name in rules:
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(name), name, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def audited(rows, good, toxic):
    """Op 11 over (doc_id, text, source) by applying the filters one after the other, for each order."""
    from itertools import permutations

    def fails(i, text):
        w = words(text)
        out = {"A"} if len(w) < 50 else set()
        out |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        out |= {"D"} if set(text) & set("#$%&*|") else set()
        return out | ({"E"} if any(e is not None and i is not None and e < i and (u or "") == text for e, u, _ in rows) else set())

    parts = defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append((i, fails(i, t or "")))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x for _, x in docs) - len(gone), sum(x == {f} for _, x in docs),
                    sum(i in good for i in gone), sum(i in toxic for i in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def simhash(text):
    import xxhash

    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(prints):
    """(id, fingerprint) -> (id, fingerprint, smallest id reachable), by all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, x) in enumerate(prints):
        for k in range(i):
            if (x ^ prints[k][1]).bit_count() <= 3:
                root[find(i)] = find(k)
    least = defaultdict(list)
    for i, (d, _) in enumerate(prints):
        least[find(i)] += [d] if d is not None else []
    return [(d, x, min(least[find(i)], default=None)) for i, (d, x) in enumerate(prints)]


def negatives(rows, anchor, n=5):
    """Op 13 over (id, label, integer vector), with unequal lengths filled up with zeros."""

    def score(x, y):
        return sum(a * b for a, b in zip(x, y))

    rows = {(i, la, tuple(v)) for i, la, v in rows if i is not None and la is not None and v is not None and None not in v}
    out = []
    for i, la, v in rows:
        if not anchor(i):
            continue
        others = sorted((-score(v, u), k, lb) for k, lb, u in rows)
        for p, k, _ in [o for o in others if o[2] == la and o[1] != i][:n]:
            fit = [o for o in others if o[2] != la and 80 * -p <= 100 * -o[0] <= 100 * -p][:n]
            out += [(i, k, r, o[1], -p, -o[0]) for r, o in enumerate(fit, 1)]
    return sorted(out)
