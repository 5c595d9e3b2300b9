"""Weighted Jaccard signatures of multisets by BagMinHash, vectorised.

The weight of an element is cut into levels [0,1), [1,2), [2,4), [4,8), ...
Every (element, level) owns a Poisson process in time whose rate is the
level's width; each of its points falls on one of M signature slots and at
one place of the level.  An element of weight w owns the points of the levels
below w and, of the level that w cuts, those whose place is below w.  A slot
keeps its earliest point.  Two multisets agree in a slot with probability
equal to their weighted Jaccard similarity.

Points are made in order of time and only until every slot is surely filled,
so a large multiset costs little more than one number per element.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.words import mix

SLOTS = 120
U = np.uint64
_STEP = U(0x9E3779B97F4A7C55)


def _draw(seed: np.ndarray, j: np.ndarray | int, salt: int) -> np.ndarray:
    return mix(seed + (np.atleast_1d(np.asarray(j, np.uint64)) * U(3) + U(salt)) * _STEP)


def _gap(bits: np.ndarray) -> np.ndarray:
    """Exponential of rate one."""
    return -np.log1p(-((bits >> U(11)).astype(np.float64) * 2.0**-53))


def _levels(owner: np.ndarray, element: np.ndarray, weight: np.ndarray):
    """(owner, seed, rate, share of the level that counts) of every (element, level)."""
    out_o, out_s = [owner], [mix(element)]
    out_r, out_f = [np.ones(len(owner))], [np.ones(len(owner))]
    low, level = 1, 1
    more = np.flatnonzero(weight > 1)
    while len(more):
        out_o.append(owner[more])
        out_s.append(mix(element[more] + U((level * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF)))
        out_r.append(np.full(len(more), float(low)))
        out_f.append(np.minimum(1.0, (weight[more] - low) / low))
        low, level = 2 * low, level + 1
        more = more[weight[more] > low]
    return (np.concatenate(x) for x in (out_o, out_s, out_r, out_f))


def _points(owner, seed, rate, share, until):
    """(owner, slot, time, name) of all points up to until[owner]."""
    found: list[tuple] = []

    def keep(o, s, j, t, f):
        bits = _draw(s, j, 1)
        place = (_draw(s, j, 2) >> U(11)).astype(np.float64) * 2.0**-53
        use = place < f
        found.append((o[use], ((bits >> U(32)) % U(SLOTS)).astype(np.int64)[use], t[use], bits[use]))

    expected = rate * until[owner]
    many = expected > 16
    o, s, r, f, e = (x[many] for x in (owner, seed, rate, share, expected))
    if len(o):  # all points of an element in one stretch; the stretch is longer than it needs to be
        n = np.ceil(e + 8 * np.sqrt(e) + 8).astype(np.int64)
        first = np.cumsum(n) - n
        which = np.repeat(np.arange(len(o)), n)
        j = np.arange(len(which)) - first[which] + 1
        t = np.cumsum(_gap(_draw(s[which], j, 0)))
        base = np.concatenate([[0.0], t])[first]
        t = (t - base[which]) / r[which]
        ok = t <= until[o[which]]
        which, j, t = which[ok], j[ok], t[ok]
        keep(o[which], s[which], j, t, f[which])
    o, s, r, f = (x[~many] for x in (owner, seed, rate, share))
    t, j = np.zeros(len(o)), 0
    while len(o):
        j += 1
        t = t + _gap(_draw(s, j, 0)) / r
        ok = t <= until[o]
        o, s, r, f, t = o[ok], s[ok], r[ok], f[ok], t[ok]
        keep(o, s, np.full(len(o), j), t, f)
    return tuple(np.concatenate(x) for x in zip(*found))


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, SLOTS) signatures of n multisets given as (owner, element, weight) rows; all zero for an empty one."""
    out = np.zeros((n, SLOTS), np.uint64)
    total = np.bincount(owner, weight, n)
    left = total > 0
    need = SLOTS * (np.log(SLOTS) + 2.0)
    until = np.divide(need, total, out=np.zeros(n), where=left)
    o, s, r, f = _levels(owner, element, weight)
    while len(o):
        po, slot, t, name = _points(o, s, r, f, until)
        at = po * SLOTS + slot
        best = np.full(n * SLOTS, np.inf)
        np.minimum.at(best, at, t)
        win = t == best[at]
        filled = np.isfinite(best.reshape(n, SLOTS)).all(1) & left
        got = np.zeros(n * SLOTS, np.uint64)
        got[at[win]] = name[win]
        out[filled] = got.reshape(n, SLOTS)[filled]
        left &= ~filled
        until *= 2  # those with an empty slot look further
        again = left[o]
        o, s, r, f = o[again], s[again], r[again], f[again]
    return out
