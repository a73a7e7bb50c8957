"""Suffix arrays of byte strings by induced sorting, in whole-array steps, and common prefixes.

Suffixes are classed as larger or smaller than the one that follows. The leftmost smaller ones
(LMS) are sorted by sorting the substrings between them, naming equal ones alike and sorting the
string of names in turn; all others follow from them by induction, bucket by bucket. A bucket is
gone through in blocks: what is in it already, then what that has added to it.
"""

from __future__ import annotations

import numpy as np


def _put(sa, at, positions, symbols, step):
    """Place ``positions`` in their buckets, in order, at the heads (step 1) or tails (-1) ``at``."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    counts = np.bincount(ranked, minlength=len(at))
    before = np.cumsum(counts) - counts
    within = np.arange(len(ranked)) - before[ranked]
    sa[at[ranked] + step * within] = positions[order]
    at += step * counts


def _induce(text, smaller, lms, bounds):
    """Suffix array of ``text`` given the sorted LMS suffixes; -1 where nothing is induced."""
    n, sigma = len(text), len(bounds) - 1
    sa = np.full(n, -1, np.int64)
    tails = bounds[1:] - 1
    _put(sa, tails, lms[::-1], text[lms[::-1]], -1)
    heads = bounds[:-1].copy()
    # The larger ones, from the front. The suffix before the end comes first.
    if not smaller[n - 1]:
        _put(sa, heads, np.array([n - 1]), text[n - 1 : n], 1)
    first_lms = tails + 1
    for c in range(sigma):
        done = bounds[c]
        while done < heads[c]:
            block = sa[done : heads[c]] - 1
            done = heads[c]
            block = block[block >= 0]
            block = block[~smaller[block]]
            if len(block):
                _put(sa, heads, block, text[block], 1)
        block = sa[first_lms[c] : bounds[c + 1]] - 1
        block = block[block >= 0]
        block = block[~smaller[block]]
        if len(block):
            _put(sa, heads, block, text[block], 1)
    # The smaller ones, from the back; LMS suffixes are placed anew.
    tails = bounds[1:] - 1
    for c in range(sigma - 1, -1, -1):
        sa[heads[c] : bounds[c + 1]] = -1
    for c in range(sigma - 1, -1, -1):
        done = bounds[c + 1] - 1
        while done > tails[c]:
            block = sa[tails[c] + 1 : done + 1][::-1] - 1
            done = tails[c]
            block = block[block >= 0]
            block = block[smaller[block]]
            if len(block):
                _put(sa, tails, block, text[block], -1)
        block = sa[bounds[c] : heads[c]][::-1] - 1
        block = block[block >= 0]
        block = block[smaller[block]]
        if len(block):
            _put(sa, tails, block, text[block], -1)
    return sa


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: names of pairs, of pairs of pairs, and so on."""
    rank, width = names.astype(np.int64), 1
    while True:
        follow = np.zeros(len(rank), np.int64)
        follow[:-width] = rank[width:] + 1
        both = rank * (len(rank) + 2) + follow
        order = np.argsort(both, kind="stable")
        new = np.ones(len(order), np.int64)
        new[0] = 0
        new[1:] = both[order][1:] != both[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == len(order) - 1:
            return order
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a byte string (uint8)."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    symbols = text.astype(np.int64)
    # A suffix is smaller than the next if its byte is, or is equal and the next is smaller.
    change = np.flatnonzero(symbols[1:] != symbols[:-1])
    upto = np.append(change, n - 1)
    run = np.searchsorted(upto, np.arange(n))
    rises = np.zeros(len(upto), bool)
    rises[:-1] = symbols[upto[:-1]] < symbols[upto[:-1] + 1]
    smaller = rises[run]
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=256))])
    if len(lms) > 1:
        rough = _induce(symbols, smaller, lms, bounds)
        rough = rough[rough >= 0]
        rough = rough[is_lms[rough]]
        # LMS substrings are equal if they have one length and all their bytes.
        ends = np.append(lms[1:], n - 1)
        length = np.zeros(n, np.int64)
        length[lms] = ends - lms + 1
        one, two = rough[:-1], rough[1:]
        differ = (length[one] != length[two]) | (one == lms[-1]) | (two == lms[-1])
        open_pairs = np.flatnonzero(~differ)
        offset = 0
        while len(open_pairs):
            unlike = symbols[one[open_pairs] + offset] != symbols[two[open_pairs] + offset]
            differ[open_pairs[unlike]] = True
            offset += 1
            open_pairs = open_pairs[~unlike]
            open_pairs = open_pairs[length[one[open_pairs]] > offset]
        names = np.empty(n, np.int64)
        names[rough] = np.concatenate([[0], np.cumsum(differ)])
        lms = lms[_sort_names(names[lms])]
    return _induce(symbols, smaller, lms, bounds)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``sa``, in that order.

    In text order these lengths fall by one from place to place, except where the byte before
    differs; only there are bytes compared.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    anew = (place == 0) | (before <= 0)
    anew[1:] |= (before[1:] > 0) & (text[place[1:] - 1] != text[before[1:] - 1])
    # A place whose predecessor had no suffix before it starts anew as well.
    anew[1:] |= before[:-1] < 0
    start = np.flatnonzero(anew)
    other = before[start]
    length = np.zeros(len(start), np.int64)
    active = np.flatnonzero(other >= 0)
    wide = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(wide, 8)
    while len(active):
        a, b = start[active] + length[active], other[active] + length[active]
        inside = np.minimum(n - a, n - b)
        fits = inside >= 8
        same = np.zeros(len(active), bool)
        same[fits] = (words[a[fits]] == words[b[fits]]).all(axis=1)
        rest = active[~same]
        if len(rest):
            a, b = start[rest] + length[rest], other[rest] + length[rest]
            left = np.minimum(n - np.maximum(a, b), 8)
            equal = words[a] == words[b]
            equal &= np.arange(8)[None, :] < left[:, None]
            length[rest] += np.where(equal.all(axis=1), 8, equal.argmin(axis=1))
        active = active[same]
        length[active] += 8
    last = np.maximum.accumulate(np.where(anew, place, -1))
    which = np.searchsorted(start, last)
    permuted = np.maximum(length[which] - (place - last), 0)
    permuted[before < 0] = 0
    return permuted[sa]
