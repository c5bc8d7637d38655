"""Suffix arrays by induced sorting (Nong, Zhang, Chan 2009) and permuted common prefixes, over numpy arrays.

The substrings between leftmost S suffixes are named in one induction. Where names repeat, the string of names is sorted
by prefix doubling instead of by recursion: an induction moves a whole bucket at once, and names have too many buckets.
"""

import numpy as np

CHARACTERS = 1024  # an alphabet of fewer is induced by buckets


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last character is a unique least one."""
    n = len(s)
    rises = np.ones(n, dtype=np.int8)
    rises[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    decided = np.where(rises != 0, np.arange(n), n)  # an equal neighbour has the type of the next unequal one
    return rises[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``, numbers from 0, whose last is a unique least one."""
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    if int(s.max()) >= CHARACTERS:
        return _by_doubling(s)
    s = s.astype(np.int16)  # which numpy sorts by radix
    small = suffix_types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    # Any order of the leftmost S suffixes induces the order of the substrings between them.
    order = _induce_by_bucket(s, small, lms)
    ranked = order[is_lms[order]]
    names, distinct = _names(s, lms, ranked)
    if distinct < len(lms):
        ranked = lms[_by_doubling(names)]
    return _induce_by_bucket(s, small, ranked)


def _names(s: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each substring between leftmost S positions, equal ones sharing it, in order of position."""
    n = len(s)
    place = np.zeros(n, dtype=np.int64)
    place[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], n - 1)
    lengths = ends[place[ranked]] - ranked + 1
    new = np.ones(len(ranked), dtype=bool)
    pairs = np.flatnonzero(lengths[1:] == lengths[:-1])
    if len(pairs):
        size = lengths[pairs]
        first = np.repeat(np.cumsum(size) - size, size)
        step = np.arange(size.sum()) - first
        differs = s[np.repeat(ranked[pairs], size) + step] != s[np.repeat(ranked[pairs + 1], size) + step]
        new[pairs + 1] = np.logical_or.reduceat(differs, np.cumsum(size) - size)
    rank = np.cumsum(new) - 1
    names = np.empty(len(lms), dtype=np.int64)
    names[place[ranked]] = rank
    return names, int(rank[-1]) + 1


def _induce_by_bucket(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Induce the order of all suffixes, a bucket at a time.

    What a bucket's suffixes induce goes to the same bucket, whose new part is then the next to be read, or to one
    that is read later; so whole runs are moved at once.
    """
    n = len(s)
    order = np.full(n, -1, dtype=np.int64)
    counts = np.bincount(s)
    heads, tails = np.cumsum(counts) - counts, np.cumsum(counts)
    chars = np.flatnonzero(counts)
    # Leftmost S suffixes at the ends of their buckets, in the given order.
    by_char = lms[np.argsort(s[lms], kind="stable")]
    held = np.bincount(s[lms], minlength=len(counts))
    offset = np.cumsum(held) - held
    free = heads.copy()

    def place(found, down):
        into = s[found]
        by = np.argsort(into, kind="stable")
        into, found = into[by], found[by]
        starts = np.flatnonzero(np.diff(into, prepend=-1))
        sizes = np.diff(np.append(starts, len(into)))
        nth = np.arange(len(into)) - np.repeat(starts, sizes)
        if down:
            order[free[into] - 1 - nth] = found
            free[into[starts]] -= sizes
        else:
            order[free[into] + nth] = found
            free[into[starts]] += sizes

    for c in chars:
        read = heads[c]
        while read < free[c]:  # L suffixes of the bucket, those just induced included
            block = order[read:free[c]]
            read = free[c]
            before = block[block > 0] - 1
            before = before[~small[before]]
            if len(before):
                place(before, False)
        before = by_char[offset[c]:offset[c] + held[c]] - 1
        before = before[before >= 0]
        if len(before):
            place(before, False)
    large_end = free.copy()
    free = tails.copy()
    for c in chars[::-1]:
        read = tails[c]
        while read > free[c]:
            block = order[free[c]:read][::-1]
            read = free[c]
            before = block[block > 0] - 1
            before = before[small[before]]
            if len(before):
                place(before, True)
        block = order[heads[c]:large_end[c]][::-1]
        before = block[block > 0] - 1
        before = before[small[before]]
        if len(before):
            place(before, True)
        if c == s[-1] and tails[c] - heads[c] == 1:
            order[heads[c]] = n - 1  # the least suffix, which nothing induces
            if n > 1 and small[n - 2]:
                place(np.array([n - 2]), True)
    return order


def _by_doubling(s: np.ndarray) -> np.ndarray:
    """The order of the suffixes by twice as many characters each round (Larsson, Sadakane 2007), for any alphabet.

    A rank is the place of the first suffix with the same characters so far. Only suffixes that share theirs go on.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    new = np.diff(s[order], prepend=-1) != 0
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    places = np.flatnonzero(~(new & np.append(new[1:], True)))
    length = 1
    while len(places):
        tied = order[places]
        # The last character is unique, so that suffixes with equal characters do not end with them.
        key = rank[tied] * n + rank[tied + length]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[places] = tied
        new = np.diff(key, prepend=-1) != 0
        rank[tied] = places[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        places = places[~(new & np.append(new[1:], True))]
        length *= 2
    return order


def permuted_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the length of the common prefix of its suffix and the one before it in ``order``.

    By position the length drops by one at most. It is compared character by character only where the two suffixes are
    preceded by different characters; elsewhere it is one less than at the position before (Kärkkäinen, Manzini,
    Puglisi 2009).
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    own = np.ones(n, dtype=bool)
    inner = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    own[inner] = s[inner - 1] != s[before[inner] - 1]
    start = np.flatnonzero(own & (before >= 0))
    length = np.zeros(n, dtype=np.int64)
    active, other, at = start, before[start], 0
    while len(active):  # both end at the unique last character, at different lengths
        same = s[active + at] == s[other + at]
        length[active[~same]] = at
        active, other, at = active[same], other[same], at + 1
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return np.where(own, length, length[last] - (np.arange(n) - last))
