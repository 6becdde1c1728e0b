"""Suffix arrays by induced sorting, and permuted longest common prefixes, for one shard of bytes.

Suffixes are S-type if they are smaller than their successor, else L-type. Behind an L-type suffix its symbols run on as L-type ones up to the
next leftmost-smaller position, so the order of those induces the order of all L-type suffixes, and that the order of the S-type
ones. A first pass with equal ranks names the leftmost-smaller substrings; if names repeat, the string of names is sorted by the
same method. All suffixes of a type are ordered together with numpy: by one more symbol of their runs at a time, and only where
they are still equal.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """Whether a suffix is S-type, i.e. smaller than its successor; the last one is."""
    n = len(t)
    later = np.r_[t[:-1] != t[1:], True]
    # the next position at which the symbol changes decides
    change = np.flatnonzero(later)
    at = change[np.searchsorted(change, np.arange(n))]
    s = np.ones(n, bool)
    inner = at < n - 1
    s[inner] = t[at[inner]] < t[at[inner] + 1]
    return s


def _order(t: np.ndarray, members: np.ndarray, ends: np.ndarray, kind: int, last: np.ndarray) -> np.ndarray:
    """Ranks of suffixes of one type (0: L, 1: S), equal ones of equal suffixes: by their symbols up to the place where their run of that type
    ends, then by the rank in ``last`` of that place. A rank is the number of smaller members."""
    runs = ends - members
    _, group = np.unique(t[members], return_inverse=True)
    sizes = np.bincount(group)
    rank = (np.cumsum(sizes) - sizes)[group]
    active = np.flatnonzero(sizes[group] > 1)
    k = 1
    while len(active):
        # members of one rank have had the same symbols and types so far, so their runs end together
        r = runs[active]
        symbol = t[np.minimum(members[active] + k, len(t) - 1)]
        value = np.where(k > r, last[ends[active]], 2 * symbol + np.where(k < r, kind, 1 - kind))
        order = np.lexsort((value, rank[active]))
        active, value = active[order], value[order]
        before = rank[active]
        head = np.r_[True, before[1:] != before[:-1]]
        new = head | np.r_[True, value[1:] != value[:-1]]
        at = np.arange(len(active))
        rank[active] = before + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        alone = new & np.r_[new[1:], True]
        active = active[~alone]
        active = active[runs[active] >= k]
        k += 1
    return rank


def _induce(t: np.ndarray, s: np.ndarray, rho: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes within their type, from ranks ``rho`` of the leftmost-smaller ones. The sentinel has rank 0."""
    n = len(t)
    place = np.arange(n)
    next_s = np.minimum.accumulate(np.where(s, place, n)[::-1])[::-1]
    next_l = np.minimum.accumulate(np.where(s, n, place)[::-1])[::-1]
    rank = np.zeros(n, np.int64)
    larger, smaller = np.flatnonzero(~s), np.flatnonzero(s[:-1])
    rank[larger] = _order(t, larger, next_s[larger], 0, rho)
    rank[smaller] = _order(t, smaller, next_l[smaller], 1, rank) + 1
    return rank


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of a string of non-negative numbers that ends in its only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    s = _types(t)
    lms = np.flatnonzero(s & np.r_[False, ~s[:-1]])
    rho = np.zeros(n, np.int64)
    different, names = np.unique(_induce(t, s, rho)[lms], return_inverse=True)
    order = suffix_array(names.astype(np.int64)) if len(different) < len(lms) else np.argsort(names)
    rho[lms[order]] = np.arange(len(lms))
    rank = _induce(t, s, rho)
    larger, smaller = np.flatnonzero(~s), np.flatnonzero(s)
    # of one symbol the L-type suffixes come first
    both = np.r_[larger[np.argsort(rank[larger], kind="stable")], smaller[np.argsort(rank[smaller], kind="stable")]]
    return both[np.argsort(t[both], kind="stable")]


def permuted_lcp(
    t: np.ndarray, sa: np.ndarray, most: int, restart: np.ndarray, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp): for every position its predecessor in suffix order and their common prefix, up to ``most``.

    Only irreducible positions (and those in ``restart``) are compared; behind them a value falls by one per position. With a mask
    ``wanted``, whose positions follow each ``restart`` without a gap, values are right where a position and its predecessor are in it, and
    not above the right ones elsewhere."""
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    fresh = np.ones(n, bool)
    fresh[1:] = (phi[1:] < 1) | (phi[:-1] != phi[1:] - 1) | (t[np.maximum(phi[1:] - 1, 0)] != t[:-1])
    fresh[restart] = True
    compared = fresh & (phi >= 0)
    if wanted is not None:
        compared &= wanted & wanted[np.maximum(phi, 0)]
    at = np.flatnonzero(compared)
    value = np.zeros(n, np.int64)
    padded = np.r_[t, np.arange(-1, -65, -1)]  # symbols behind the end equal nothing
    open_, off = at, 0
    while len(open_) and off < most:
        i, j = np.minimum(open_ + off, n), np.minimum(phi[open_] + off, n)
        step = np.arange(64)
        same = padded[np.minimum(i[:, None] + step, n + 63)] == padded[np.minimum(j[:, None] + step, n + 63)]
        run = np.where(same.all(axis=1), 64, same.argmin(axis=1))
        value[open_] += run
        open_ = open_[run == 64]
        off += 64
    source = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return phi, np.maximum(value[source] - (np.arange(n) - source), 0)
