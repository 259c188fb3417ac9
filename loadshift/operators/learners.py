"""Small weighted learners for one household's model.

Spark shuffles the feature rows by household and calls one of these per training date, or one of ``TOGETHER`` for several,
inside a pandas function. A group holds at most the hours of one household's history. Each learner takes the rows
X with the weights ``pos`` and ``neg`` of the two classes and returns a function from rows to P(class 1).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Numbers held at once while distances are formed, so memory does not grow with a long history.
MAX_CELLS = 4_000_000
# Bits of drawn features that are looked up for one fit, one byte each.
MAX_CODES = 2**21
# Forests that are grown together.
FORESTS = 6
# Gains and weights nearer than this are compared by the sums over rows, far above what rounding may change.
CLOSE = 1e-8


def logit(X, pos, neg, max_iter=100, penalty=1.0, intercept=True):
    """Logistic regression by Newton steps; the intercept is not penalised."""
    ones = np.ones((len(X), 1))
    A = np.hstack([X, ones]) if intercept else X
    ridge = np.full(A.shape[1], penalty)
    if intercept:
        ridge[-1] = 0.0
    w = np.zeros(A.shape[1])
    n = pos + neg
    for _ in range(max_iter):
        p = 1 / (1 + np.exp(-np.clip(A @ w, -35, 35)))
        gradient = A.T @ (n * p - pos) + ridge * w
        hessian = (A * (n * p * (1 - p))[:, None]).T @ A + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break

    def score(Z):
        Z = np.hstack([Z, np.ones((len(Z), 1))]) if intercept else Z
        return 1 / (1 + np.exp(-np.clip(Z @ w, -35, 35)))

    return score


def logit_sm(X, pos, neg):
    return logit(X, pos, neg, max_iter=35, penalty=0.0, intercept=False)


def ebm(X, pos, neg):
    """Additive model: logistic regression on the one-hot bins of every feature."""
    f, t = _thresholds(X)
    edges = [t[f == j] for j in range(X.shape[1])]

    def bins(Z):
        hot = [np.eye(len(e) + 1)[np.searchsorted(e, Z[:, j], side="left")] for j, e in enumerate(edges)]
        return np.hstack(hot)

    inner = logit(bins(X), pos, neg)
    return lambda Z: inner(bins(Z))


def knn(X, pos, neg, n_neighbors=10):
    """Share of positives among the nearest rows (Euclidean); of equally far rows the latest ones count."""
    train, y = X[::-1], pos[::-1]
    batch = max(1, MAX_CELLS // train.size)

    def score(Z):
        out = np.empty(len(Z))
        for i in range(0, len(Z), batch):
            d = ((Z[i : i + batch, None, :] - train[None, :, :]) ** 2).sum(axis=2)
            nearest = np.argsort(d, axis=1, kind="stable")[:, :n_neighbors]
            out[i : i + batch] = y[nearest].mean(axis=1)
        return out

    return score


def _thresholds(X, bins=None):
    """Candidate splits (feature, threshold): all midpoints between distinct values, or quantiles of them into ``bins`` bins."""
    features, cuts = [], []
    for j in range(X.shape[1]):
        v = np.unique(X[:, j])
        mid = (v[:-1] + v[1:]) / 2
        if bins is not None and len(mid) >= bins:
            mid = np.unique(np.quantile(mid, np.linspace(0, 1, bins - 1), method="nearest"))
        features += [j] * len(mid)
        cuts += list(mid)
    return np.array(features, dtype=int), np.array(cuts)


def _grow(B, of_feature, g, h, depth, ridge=0.0, min_child=0.0, n_features=None, rng=None):
    """Trees in heap order, all grown level by level at once: g and h hold one row of weights per tree.

    Returns the split of each node (-1 = leaf) and its value g / (h + ridge). A split maximises the sum of
    g^2 / (h + ridge) over the children. With class weights as g and total weights as h that is the Gini
    criterion, with gradients and curvatures it is Newton boosting.
    """
    n_trees, n = g.shape
    size = 2 ** (depth + 1) - 1
    split, value = np.full(n_trees * size, -1), np.zeros(n_trees * size)
    used = np.flatnonzero(h.ravel() > 0)
    node, row, g, h = used // n * size, used % n, g.ravel()[used], h.ravel()[used]
    least = max(min_child, 1e-9)
    for level in range(depth + 1):
        if len(node) == 0:
            break
        order = np.argsort(node, kind="stable")
        node, row, g, h = node[order], row[order], g[order], h[order]
        ids, first = np.unique(node, return_index=True)
        G, H = np.add.reduceat(g, first), np.add.reduceat(h, first)
        value[ids] = G / (H + ridge)
        if level == depth or B.shape[1] == 0:
            break
        right = B[row]
        GR = np.add.reduceat(g[:, None] * right, first, axis=0)
        HR = np.add.reduceat(h[:, None] * right, first, axis=0)
        GL, HL = G[:, None] - GR, H[:, None] - HR
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = GL**2 / (HL + ridge) + GR**2 / (HR + ridge) - (G**2 / (H + ridge))[:, None]
        gain = np.where((HL >= least) & (HR >= least), gain, -1.0)
        if n_features is not None:
            rank = rng.random((len(ids), of_feature.max() + 1)).argsort(axis=1).argsort(axis=1)
            gain = np.where(rank[:, of_feature] < n_features, gain, np.minimum(gain, 1e-12))
        best = gain.argmax(axis=1)
        chosen = np.where(gain[np.arange(len(ids)), best] > 1e-9, best, -1)
        split[ids] = chosen
        chosen = np.repeat(chosen, np.diff(np.append(first, len(node))))
        live = chosen >= 0
        node, row, g, h, chosen = node[live], row[live], g[live], h[live], chosen[live]
        tree = node // size * size
        node = tree + 2 * (node - tree) + 1 + B[row, chosen].astype(int)
    return split.reshape(n_trees, size), value.reshape(n_trees, size)


def _ranked(n_cuts):
    """The features among which nodes draw: up to the last one that has a threshold."""
    return np.flatnonzero(n_cuts)[-1] + 1 if n_cuts.any() else 0


class _Draws(NamedTuple):
    """Fits whose forests ``_grow_forests`` grows, with the same number of features to draw from: their rows, one fit after the other."""

    n_cuts: np.ndarray  # thresholds, fits x features
    first: np.ndarray  # each fit's first row
    below: np.ndarray  # how many of its fit's thresholds lie below a value, features x rows
    wide: np.ndarray  # the features that have several thresholds in some fit
    together: int  # how many drawn features are looked up at once
    codes: np.ndarray  # for each choice of that many and each row the bits of those that are not wide


def _draws(below, n_cuts, n_features):
    """From the numbers of thresholds below each value and of all thresholds, for each fit."""
    n_cuts, n_ranked = np.array(n_cuts), _ranked(n_cuts[0])
    length = np.array([len(b) for b in below])
    below = np.ascontiguousarray(np.concatenate(below).T)
    wide = np.flatnonzero(n_cuts.max(axis=0) > 1)
    bit = below[:n_ranked].astype(np.uint8)
    bit[wide] = 0
    codes, together = bit, 1
    while together < min(n_features, n_ranked, 8) and codes.size // len(below[0]) * n_ranked * length.max() <= MAX_CODES:
        codes = codes[..., None, :] | (bit << together)
        together += 1
    return _Draws(n_cuts, np.cumsum(length) - length, below, wide, together, codes.reshape(-1))


def _grow_counts(draws, n_cuts, p, n, depth, n_features, rng):
    """``_grow_forests`` for one fit; the numbers of its thresholds stand for those that ``_grow`` takes."""
    return _grow_forests(draws, [(0, p, n, rng)], depth, n_features)[0]


def _grow_forests(draws, drawn_rows, depth, n_features):
    """``_grow`` for whole-numbered weights with ``n_features`` random features a node, without ridge: for each (fit, positives, rows,
    random numbers) its trees.

    Only the drawn features of a node are added up, by node and the bits of those with one threshold or, where a feature has many, by node
    and value. Rows and positives are one number (below 2^26 each) that is taken apart afterwards; sums of whole numbers do not depend on
    the order. The same keys find the child of each row. Nodes of one class are leaves.
    """
    size, n_ranked = 2 ** (depth + 1) - 1, _ranked(draws.n_cuts[0])
    n_trees = [len(n) for _, _, n, _ in drawn_rows]
    end = np.cumsum(n_trees)
    split, value = np.full(end[-1] * size, -1), np.zeros(end[-1] * size)
    offset = (np.cumsum(draws.n_cuts, axis=1) - draws.n_cuts)[np.repeat([f for f, _, _, _ in drawn_rows], n_trees)]
    V, n_rows, together, codes = draws.below, draws.below.shape[1], draws.together, draws.codes
    ids = np.arange(end[-1]) * size
    G, H = (np.concatenate([x[i].sum(axis=1) for x in drawn_rows]) for i in (1, 2))
    value[ids] = G / H

    def forests():
        return [(s.reshape(-1, size), v.reshape(-1, size)) for s, v in zip(np.split(split, end[:-1] * size), np.split(value, end[:-1] * size))]

    if not n_ranked:
        return forests()
    unit, m = 2.0**26, min(n_features, n_ranked)
    bits = (np.arange(2**together)[:, None] >> np.arange(together)) & 1

    def gains(G, H, gr, hr):
        gl, hl = G[:, None] - gr, H[:, None] - hr
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl**2 / hl + gr**2 / hr - (G**2 / H)[:, None]
        return np.where((hl > 0) & (hr > 0), gain, -1.0)

    def parts(sums):
        rows = np.floor(sums / unit)
        return sums - rows * unit, rows

    # Only nodes of both classes have a number, and rows.
    mixed = (G > 0) & (G < H)
    found = [np.nonzero(n) for _, _, n, _ in drawn_rows]
    weight = np.concatenate([n[at] * unit + p[at] for (_, p, n, _), at in zip(drawn_rows, found)])
    node = np.concatenate([at[0] + last - k for at, last, k in zip(found, end, n_trees)])
    row = np.concatenate([at[1] + draws.first[f] for (f, _, _, _), at in zip(drawn_rows, found)])
    kept = np.flatnonzero(mixed[node])
    node, row, weight = (np.cumsum(mixed) - 1)[node[kept]], row[kept], weight[kept]
    for level in range(depth):
        n_nodes = np.diff(np.searchsorted(ids, end * size), prepend=0)
        drawn = np.concatenate([rng.random((k, n_ranked)) for k, (_, _, _, rng) in zip(n_nodes, drawn_rows)])[mixed]
        if not len(drawn):
            break
        if n_ranked > m:
            chosen = np.flatnonzero(drawn <= np.sort(drawn, axis=1)[:, m - 1 : m])
            # Equal draws would choose too many.
            alike = len(chosen) > len(drawn) * m
            drawn = np.sort(np.argpartition(drawn, m - 1, axis=1)[:, :m], axis=1) if alike else (chosen % n_ranked).reshape(-1, m)
        else:
            drawn = np.broadcast_to(np.arange(n_ranked), drawn.shape)
        k, own, G, H = len(drawn), ids[mixed], G[mixed], H[mixed]
        keys, sums = [], []
        for first in range(0, m, together):
            chunk = drawn[:, np.minimum(np.arange(first, first + together), m - 1)]
            at = chunk[:, 0]
            for j in range(1, together):
                at = at * n_ranked + chunk[:, j]
            key = (at * n_rows).take(node)
            key += row
            key = codes.take(key) + (node << together)
            keys.append(key)
            sums.append(np.bincount(key, weight, k << together).reshape(k, -1) @ bits)
        GR, HR = parts(np.hstack(sums)[:, :m])
        gain, cut, wide = gains(G, H, GR, HR), np.zeros((k, m), dtype=int), []
        for feature in draws.wide:
            at, slot = np.nonzero(drawn == feature)
            if len(at):
                place, n_bins = np.full(k, -1), draws.n_cuts[:, feature].max() + 1
                place[at] = np.arange(len(at))
                key = place.take(node)
                mine = np.flatnonzero(key >= 0)
                key = key.take(mine) * n_bins + V[feature].take(row.take(mine))
                total = np.bincount(key, weight.take(mine), len(at) * n_bins).reshape(len(at), -1)
                gr, hr = parts(total[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:])
                by_cut = gains(G[at], H[at], gr, hr)
                best, i = by_cut.argmax(axis=1), np.arange(len(at))
                gain[at, slot], cut[at, slot], GR[at, slot], HR[at, slot] = by_cut[i, best], best, gr[i, best], hr[i, best]
                wide.append((at, slot, mine, key, n_bins))
        slot = gain.argmax(axis=1)
        at = np.arange(k)
        open_ = np.flatnonzero(gain[at, slot] > 1e-9)
        feature, cut, GR, HR = (x[at, slot][open_] for x in (drawn, cut, GR, HR))
        tree = own[open_] // size
        split[own[open_]] = offset[tree, feature] + cut
        tree = tree * size
        ids = np.column_stack([tree + 2 * (own[open_] - tree) + 1, tree + 2 * (own[open_] - tree) + 2]).ravel()
        G = np.column_stack([G[open_] - GR, GR]).ravel()
        H = np.column_stack([H[open_] - HR, HR]).ravel()
        value[ids] = G / H
        if level + 1 == depth:
            break
        mixed = (G > 0) & (G < H)
        child, cut_of = np.full((k, 2), -1), np.zeros(k, dtype=int)
        child[open_] = np.where(mixed, np.cumsum(mixed) - 1, -1).reshape(-1, 2)
        cut_of[open_] = cut
        binary = ~np.isin(drawn[at, slot], draws.wide)
        for i, key in enumerate(keys):
            here = binary & (slot // together == i)
            found = np.where(here[:, None], np.where(bits.T[slot % together], child[:, 1:], child[:, :1]), -1).take(key)
            target = found if not i else np.maximum(target, found)
        for at, its_slot, mine, key, n_bins in wide:
            found = np.where(np.arange(n_bins) > cut_of[at][:, None], child[at, 1:], child[at, :1])
            found = np.where((slot[at] == its_slot)[:, None], found, -1).take(key)
            target[mine] = np.maximum(target[mine], found)
        kept = np.flatnonzero(target >= 0)
        node, row, weight = target.take(kept), row.take(kept), weight.take(kept)
    return forests()


class _Lot(NamedTuple):
    """Fits that ``_grow_lot`` grows a tree each for: the rows of all of them, one fit after the other."""

    of: np.ndarray  # the fit of each row
    n_cuts: np.ndarray  # thresholds, fits x features
    below: np.ndarray  # how many of its fit's thresholds lie below a value, features x rows
    wide: np.ndarray  # the features that have several thresholds in some fit
    order: np.ndarray  # for each of these features the rows by value, fit after fit
    binary: np.ndarray  # the other features that have a threshold
    sides: np.ndarray  # for each distinct pattern of those, which thresholds it lies above, and below
    pattern: np.ndarray  # of each row


def _lot(below, n_cuts):
    """From the numbers of thresholds below each value and of all thresholds, for each fit."""
    of = np.repeat(np.arange(len(below)), [len(b) for b in below])
    n_cuts, below = np.array(n_cuts), np.ascontiguousarray(np.concatenate(below).T.astype(np.int32))
    most = n_cuts.max(axis=0)
    wide, binary = np.flatnonzero(most > 1), np.flatnonzero(most == 1)
    order = np.array([np.lexsort((below[f], of)) for f in wide], dtype=int).reshape(len(wide), len(of))
    bits, pattern = np.unique(below[binary].T, axis=0, return_inverse=True)
    return _Lot(of, n_cuts, below, wide, order, binary, np.hstack([bits, 1 - bits]).astype(float), pattern.reshape(-1))


def _grow_lot(lot, g, h, depth, ridge, min_child):
    """``_grow`` for one tree of each fit, each node added up in the order of the values that occur in it instead of over all thresholds;
    also the value of each row's leaf.

    A node is the same stretch of the rows in every order, and its children are again; the fits' roots are the first nodes. Sums by value
    are rounded in another order than sums over rows, so of splits that come within ``CLOSE`` of a node's best one (or of a limit) the sums
    over rows decide, as in ``_grow``: the trees are the same.
    """
    n_fits, size = len(lot.n_cuts), 2 ** (depth + 1) - 1
    split, value, leaf = np.full(n_fits * size, -1), np.zeros(n_fits * size), np.zeros(len(g))
    wide, binary, order = lot.wide, lot.binary, lot.order
    offset, shift = np.cumsum(lot.n_cuts, axis=1) - lot.n_cuts, wide[:, None] * len(g)
    least = max(min_child, 1e-9)
    rows = np.flatnonzero(h > 0)
    count = np.bincount(lot.of[rows], minlength=n_fits)
    ids, count = np.flatnonzero(count) * size, count[count > 0]
    n_left = len(rows)

    def gains(left_g, left_h, right_g, right_h, possible):
        gain, other = left_g**2, right_g**2
        gain /= left_h + ridge
        other /= right_h + ridge
        gain += other
        return np.where(possible, gain, -np.inf)

    for level in range(depth + 1):
        if not len(rows):
            break
        first = np.cumsum(count) - count
        G, H = np.add.reduceat(g[rows], first), np.add.reduceat(h[rows], first)
        value[ids] = G / (H + ridge)
        leaf[rows] = np.repeat(value[ids], count)
        # Nodes too light for two children are leaves.
        open_ = H >= 2 * least - CLOSE
        if level == depth or not open_.any() or not len(wide) + len(binary):
            break
        if len(wide) and (level or len(rows) < len(g) or not open_.all()):
            # The stretches of left children, then of right ones, as in the rows.
            side = np.zeros(len(g), dtype=np.int8)
            side[rows] = np.where(np.repeat(open_, count), np.where(np.arange(len(rows)) < n_left, 1, 2), 0)
            side = side.take(order)
            order = np.hstack([order.take(np.flatnonzero(side == s)).reshape(len(wide), -1) for s in (1, 2)])
        if not open_.all():
            rows = rows[np.repeat(open_, count)]
            ids, count, G, H = ids[open_], count[open_], G[open_], H[open_]
            first = np.cumsum(count) - count
        node = np.repeat(np.arange(len(ids)), count)
        before, best, near = G**2 / (H + ridge), np.full(len(ids), 1e-9), []
        if len(wide):
            left = np.empty((2, *order.shape))
            for w, total, x in zip((g, h), (G, H), left):
                w = w.take(order)
                # Sums start again with each node.
                w[:, first[1:]] -= total[:-1]
                np.cumsum(w, axis=1, out=x)
            right = np.repeat(np.stack([G, H]), count, axis=1)[:, None] - left
            lighter = np.minimum(left[1], right[1])
            bins = lot.below.take(order + shift)
            possible = lighter >= least - CLOSE
            possible[:, :-1] &= bins[:, 1:] != bins[:, :-1]
            possible[:, first + count - 1] = False
            gain = gains(left[0], left[1], right[0], right[1], possible)
            sure = lighter >= least + CLOSE
            of_sure = gain if not (possible > sure).any() else np.where(sure, gain, -np.inf)
            np.maximum(best, np.maximum.reduceat(of_sure, first, axis=1).max(axis=0) - before, out=best)
        if len(binary):
            key, n_keys = node * len(lot.sides) + lot.pattern[rows], len(ids) * len(lot.sides)
            sums = [np.bincount(key, w[rows], n_keys).reshape(len(ids), -1) @ lot.sides for w in (g, h)]
            (right_g, left_g), (right_h, left_h) = ((x[:, : len(binary)], x[:, len(binary) :]) for x in sums)
            lighter = np.minimum(left_h, right_h)
            gain_b = gains(left_g, left_h, right_g, right_h, (lighter > 0) & (lighter >= least - CLOSE))
            sure_b = lighter >= least + CLOSE
            np.maximum(best, np.where(sure_b, gain_b, -np.inf).max(axis=1) - before, out=best)
        limit = best - CLOSE * (1 + np.abs(best)) + before
        if len(wide):
            at = np.flatnonzero(gain >= np.repeat(limit, count))
            feature, place = np.divmod(at, len(rows))
            near.append((node[place], wide[feature], bins.take(at), gain.take(at), sure.take(at)))
        if len(binary):
            at, feature = np.nonzero(gain_b >= limit[:, None])
            near.append((at, binary[feature], np.zeros_like(at), gain_b[at, feature], sure_b[at, feature]))
        of, feature, cut, gain, sure = (np.concatenate(x) for x in zip(*near))
        chosen, chosen_cut = np.full(len(ids), -1), np.zeros(len(ids), dtype=int)
        clear = (np.bincount(of, minlength=len(ids))[of] == 1) & sure & (gain - before[of] > 2 * CLOSE)
        chosen[of[clear]], chosen_cut[of[clear]] = feature[clear], cut[clear]
        if not clear.all():
            turn = np.flatnonzero(~clear)
            turn = turn[np.lexsort((cut[turn], feature[turn], of[turn]))]
            of, feature, cut = of[turn], feature[turn], cut[turn]
            GR, HR = _right_sums(lot.below, g, h, rows, first[of], count[of], feature, cut)
            Go, Ho = G[of], H[of]
            GL, HL = Go - GR, Ho - HR
            with np.errstate(divide="ignore", invalid="ignore"):
                exact = GL**2 / (HL + ridge) + GR**2 / (HR + ridge) - Go**2 / (Ho + ridge)
            exact = np.where((HL >= least) & (HR >= least), exact, -1.0)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            top = np.repeat(np.maximum.reduceat(exact, starts), np.diff(np.append(starts, len(of))))
            # The first of equal ones is written last.
            won = np.flatnonzero((exact == top) & (exact > 1e-9))[::-1]
            chosen[of[won]], chosen_cut[of[won]] = feature[won], cut[won]
        going = chosen >= 0
        if not going.any():
            break
        if not going.all():
            rows = rows[going[node]]
            ids, count, chosen, chosen_cut = ids[going], count[going], chosen[going], chosen_cut[going]
            node = np.repeat(np.arange(len(ids)), count)
        tree = ids // size
        split[ids] = offset[tree, chosen] + chosen_cut
        beyond = lot.below.take(np.repeat(chosen * len(g), count) + rows) > np.repeat(chosen_cut, count)
        n_right = np.bincount(node[beyond], minlength=len(ids))
        rows, n_left = np.concatenate([rows[~beyond], rows[beyond]]), len(rows) - n_right.sum()
        count = np.concatenate([count - n_right, n_right])
        ids = 2 * ids - tree * size
        ids = np.concatenate([ids + 1, ids + 2])
    return split.reshape(n_fits, size), value.reshape(n_fits, size), leaf


def _right_sums(below, g, h, rows, first, count, feature, cut):
    """Sums of g and h over the stretches ``rows[first:first + count]`` beyond a threshold, in the order in which ``_grow`` adds up a node."""
    GR, HR = np.zeros(len(first)), np.zeros(len(first))
    batch = np.cumsum(count) // MAX_CELLS
    for part in (np.flatnonzero(batch == b) for b in np.unique(batch)):
        start = np.cumsum(count[part]) - count[part]
        row = rows[np.arange(count[part].sum()) + np.repeat(first[part] - start, count[part])]
        right = below.take(np.repeat(feature[part] * len(g), count[part]) + row) > np.repeat(cut[part], count[part])
        GR[part], HR[part] = np.add.reduceat(g[row] * right, start), np.add.reduceat(h[row] * right, start)
    return GR, HR


def _grow_bins(lot, n_cuts, B, g, h, depth, ridge, min_child):
    """``_grow_lot`` for one fit; the numbers of its thresholds and its B stand for those that ``_grow`` takes."""
    return _grow_lot(lot, g, h, depth, ridge, min_child)[:2]


def _leaf_values(B, split, value):
    """One row of leaf values per tree."""
    n_trees, size = split.shape
    base = np.arange(n_trees)[:, None] * size
    node = np.repeat(base, len(B), axis=1)
    at = np.arange(len(B))[None, :]
    while True:
        s = split.take(node)
        live = s >= 0
        if not live.any():
            return value.take(node)
        right = B[at, np.maximum(s, 0)].astype(int)
        node = np.where(live, 2 * node - base + 1 + right, node)


def _design(X):
    f, t = _thresholds(X)
    return f, lambda Z: (Z[:, f] > t).astype(float)


def _drawn_rows(X, pos, neg, max_features, n_estimators, seed):
    """Numbers of thresholds, how many lie below each value, the features that a node draws, the rows that each tree draws (positives, all)
    in blocks of trees, and the random numbers after that."""
    rng = np.random.default_rng(seed)
    f, _ = _thresholds(X)
    below = np.column_stack([np.searchsorted(np.unique(x), x) for x in X.T])
    m = max(1, int(np.sqrt(X.shape[1]))) if max_features == "sqrt" else max_features
    weights = np.concatenate([pos, neg])
    draw = rng.multinomial(int(round(weights.sum())), weights / weights.sum(), n_estimators).astype(float)
    p, n = draw[:, : len(X)], draw[:, : len(X)] + draw[:, len(X) :]
    block = max(1, 20_000 // len(X))
    blocks = [(p[i : i + block], n[i : i + block]) for i in range(0, n_estimators, block)]
    return np.bincount(f, minlength=X.shape[1]), below, m, blocks, rng


def _forest(X, trees, n_estimators):
    """From the trees of each block."""
    _, design = _design(X)
    split, value = (np.concatenate(x) for x in zip(*trees))
    ends = np.cumsum([len(s) for s, _ in trees])[:-1]

    def score(Z):
        return sum(leaf.sum(axis=0) for leaf in np.split(_leaf_values(design(Z), split, value), ends)) / n_estimators

    return score


def random_forest(X, pos, neg, max_depth=10, n_estimators=500, max_features="sqrt", seed=0):
    n_cuts, below, m, blocks, rng = _drawn_rows(X, pos, neg, max_features, n_estimators, seed)
    draws = _draws([below], [n_cuts], m)
    return _forest(X, [_grow_counts(draws, n_cuts, p, n, max_depth, m, rng) for p, n in blocks], n_estimators)


def random_forest_together(fits, max_depth=10, n_estimators=500, max_features="sqrt", seed=0):
    """``random_forest`` for several (X, pos, neg) of the same features, one after the other: blocks of trees of ``FORESTS`` fits are grown
    at once, among fits that draw from as many features. No more forests are held."""
    for start in range(0, len(fits), FORESTS):
        some = fits[start : start + FORESTS]
        out = [None] * len(some)
        ranked = np.array([_ranked(np.array([len(np.unique(x)) > 1 for x in X.T])) for X, _, _ in some])
        for these in (np.flatnonzero(ranked == r) for r in np.unique(ranked)):
            ready = [_drawn_rows(*some[i], max_features, n_estimators, seed) for i in these]
            m, trees = ready[0][2], [[] for _ in these]
            draws = _draws([below for _, below, _, _, _ in ready], [n_cuts for n_cuts, _, _, _, _ in ready], m)
            for turn in range(max(len(blocks) for _, _, _, blocks, _ in ready)):
                rows = [(k, *blocks[turn], rng) for k, (_, _, _, blocks, rng) in enumerate(ready) if turn < len(blocks)]
                for (k, _, _, _), grown in zip(rows, _grow_forests(draws, rows, max_depth, m)):
                    trees[k].append(grown)
            for i, grown in zip(these, trees):
                out[i] = _forest(some[i][0], grown, n_estimators)
        yield from out


def ada(X, pos, neg, learning_rate=0.1, n_estimators=100):
    """Boosted stumps on class probabilities (SAMME.R with two classes)."""
    f, design = _design(X)
    B = design(X)
    wp, wn = pos / (pos + neg).sum(), neg / (pos + neg).sum()
    stumps = []
    tiny = np.finfo(float).eps

    def half_odds(p):
        p = np.clip(p, tiny, 1 - tiny)
        return np.log(p) - np.log(1 - p)

    for _ in range(n_estimators):
        stump = _grow(B, f, wp[None], (wp + wn)[None], 1)
        stumps.append(stump)
        p = _leaf_values(B, *stump)[0]
        error = wp[p <= 0.5].sum() + wn[p > 0.5].sum()
        if error <= 0:
            break
        odds = half_odds(p)
        wp, wn = wp * np.exp(-0.5 * learning_rate * odds), wn * np.exp(0.5 * learning_rate * odds)
        total = (wp + wn).sum()
        wp, wn = wp / total, wn / total
    split, value = (np.concatenate(x) for x in zip(*stumps))

    def score(Z):
        return 1 / (1 + np.exp(-half_odds(_leaf_values(design(Z), split, value)).mean(axis=0)))

    return score


def _bins(X, max_bin):
    """The features and thresholds of at most ``max_bin`` bins, their number for each feature, and how many lie below each value."""
    f, cuts = _thresholds(X, max_bin)
    below = np.column_stack([np.searchsorted(cuts[f == j], X[:, j]) for j in range(X.shape[1])])
    return f, cuts, np.bincount(f, minlength=X.shape[1]), below


def _boosted(f, cuts, trees):
    split, value = (np.concatenate(x) for x in zip(*trees))

    def score(Z):
        return 1 / (1 + np.exp(-_leaf_values((Z[:, f] > cuts).astype(float), split, value).sum(axis=0)))

    return score


def xgboost(X, pos, neg, learning_rate=0.1, max_depth=6, reg_lambda=1.0, reg_alpha=0.0, n_estimators=100, max_bin=256):
    """Newton-boosted trees from a start of 0.5, at least one unit of curvature per leaf. ``max_bin`` is a parameter of the model."""
    if reg_alpha:
        raise ValueError("reg_alpha other than 0 is not available")
    f, cuts, n_cuts, below = _bins(X, max_bin)
    B = (X[:, f] > cuts).astype(float)
    lot = _lot([below], [n_cuts])
    n = pos + neg
    margin = np.zeros(len(X))
    trees = []
    for _ in range(n_estimators):
        p = 1 / (1 + np.exp(-margin))
        split, value = _grow_bins(lot, n_cuts, B, pos - n * p, n * p * (1 - p), max_depth, reg_lambda, 1.0)
        trees.append((split, learning_rate * value))
        margin = margin + _leaf_values(B, *trees[-1])[0]
    return _boosted(f, cuts, trees)


def xgboost_together(fits, learning_rate=0.1, max_depth=6, reg_lambda=1.0, reg_alpha=0.0, n_estimators=100, max_bin=256):
    """``xgboost`` for several (X, pos, neg) of the same features: the trees of all of them are grown at once."""
    if reg_alpha:
        raise ValueError("reg_alpha other than 0 is not available")
    bins = [_bins(X, max_bin) for X, _, _ in fits]
    lot = _lot([below for _, _, _, below in bins], [n_cuts for _, _, n_cuts, _ in bins])
    pos = np.concatenate([p for _, p, _ in fits])
    n = pos + np.concatenate([q for _, _, q in fits])
    margin = np.zeros(len(n))
    trees = []
    for _ in range(n_estimators):
        p = 1 / (1 + np.exp(-margin))
        split, value, leaf = _grow_lot(lot, pos - n * p, n * p * (1 - p), max_depth, reg_lambda, 1.0)
        trees.append((split, learning_rate * value))
        margin = margin + learning_rate * leaf
    return [_boosted(f, cuts, [(split[[i]], value[[i]]) for split, value in trees]) for i, (f, cuts, _, _) in enumerate(bins)]


LEARNERS = {
    "logit": logit,
    "ada": ada,
    "knn": knn,
    "random forest": random_forest,
    "xgboost": xgboost,
    "ebm": ebm,
    "logit_sm": logit_sm,
}


# Fits that several (X, pos, neg) share steps of; they give what one fit after the other gives.
TOGETHER = {"random forest": random_forest_together, "xgboost": xgboost_together}


def fit_many(fits, model_type, **args):
    """One by one a score function for each of the (X, pos, neg), whose rows are merged and whose features are the same."""
    if fits and model_type in TOGETHER:
        yield from TOGETHER[model_type](fits, **args)
    else:
        yield from (LEARNERS[model_type](*one, **args) for one in fits)


def merge_rows(X, model_type):
    """Distinct rows and each row's number among them; knn keeps all rows, since its ties go by time."""
    if model_type == "knn":
        return X, np.arange(len(X))
    cells, at = np.unique(X, axis=0, return_inverse=True)
    return cells, at.reshape(-1)


def fit(X, pos, neg, model_type, **args):
    """Fit by model name, with equal rows merged."""
    if model_type not in LEARNERS:
        raise ValueError(f"unknown model type {model_type!r}")
    cells, at = merge_rows(X, model_type)
    return LEARNERS[model_type](cells, np.bincount(at, pos, len(cells)), np.bincount(at, neg, len(cells)), **args)
