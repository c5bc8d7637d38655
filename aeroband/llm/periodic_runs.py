"""Periodic runs of words, found with string synchronising sets (Kempa and Kociumaka 2019).

A run is a stretch of words with smallest period q, at least ``MOST_REPEATED`` times q and ``LEAST_WORDS`` long, that
neither neighbour extends. At each dyadic scale t, the synchronising set holds the positions i for which the least hash
of the t-word windows that begin in [i, i + t] is that of the first or the last; windows with a period of t / 3 at most
do not compete, as their hashes recur too densely. Membership depends on the 2t words from i on alone, so in a run of
period q the set and the words around its members recur at distance q: two neighbouring members with the same ``context``
words after them propose their distance as a period, which is then extended both ways to all of the run and verified.

What the windows left out omit is supplied separately: runs of period up to ``DIRECT`` come from comparing words that
far apart, and inside highly periodic regions, which the runs of smaller scales make up, the members of the scale below
are kept. So each stretch of t positions holds a member whatever the text, and a run of period q is proposed wherever
a context c has q <= c and c + t <= 2q + 1: contexts of 4t and 6t words serve all q between 2.5t and 6t.

Hashes are 64 bits, built for windows of twice the length from those of their halves; a run they propose is compared
word by word. Documents of about the same length are laid end to end, with separators that occur once, and handled
together in O(words log words) time and memory; a task holds one batch of texts. Nothing is shuffled.

Defined results: null and empty texts have no words and no runs; rows repeated in full are judged row by row; an empty
table gives an empty result; other columns are carried along in the order they came, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.texts import col

LEAST_WORDS = 24
MOST_REPEATED = 3
DIRECT = 9
GROUP_BYTES = 1 << 22
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)
_NOT = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hashed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes; not linear, so that sums of periodic texts do not cancel out."""
    made = first * _ODD[0]
    made ^= made >> np.uint64(32)
    made += second
    made *= _ODD[1]
    made ^= made >> np.uint64(29)
    made *= _ODD[0]
    made ^= made >> np.uint64(32)
    return made


class Windows:
    """Hashes of all windows of 1, 2, 4, ... words, up to the longest document's length."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.codes, self.levels = codes, [_hashed(codes.astype(np.uint64), np.uint64(len(codes)))]
        while 2 << len(self.levels) - 1 <= longest:
            half, size = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(_hashed(half[:-size], half[size:]))

    def at(self, length: int) -> np.ndarray:
        return self.levels[length.bit_length() - 1]

    def shared(self, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from each pair of places on, to the right (``step`` 1) or left of them (-1)."""
        total = np.zeros(len(left), dtype=np.int64)
        for level in reversed(range(len(self.levels))):
            hashes, size = self.levels[level], 1 << level
            while True:  # the highest level may fit several times
                a, b = (left + total, right + total) if step > 0 else (left - total - size, right - total - size)
                inside = (a >= 0) & (b < len(hashes))
                more = inside & (hashes[np.where(inside, a, 0)] == hashes[np.where(inside, b, 0)])
                if not more.any():
                    break
                total[more] += size
        return total


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` + 1 values in a row, ``size`` a power of two."""
    span = 1
    while span < size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:-1], values[1:])


def _direct(codes: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of three periods at least, from comparing words ``period`` apart."""
    same = np.flatnonzero(codes[period:] == codes[:-period])
    if not len(same):
        return same, same
    edges = np.flatnonzero(np.diff(same) > 1)
    first, last = same[np.append(0, edges + 1)], same[np.append(edges, len(same) - 1)]
    long = last - first + 1 >= (MOST_REPEATED - 1) * period
    return first[long], last[long] + 1 + period


def _verified(codes: np.ndarray, place: int, begin: int, end: int, period: int) -> tuple[int, int]:
    """The stretch around ``place`` in which words ``period`` apart agree: all of it, unless hashes collided."""
    wrong = begin + np.flatnonzero(codes[begin:end - period] != codes[begin + period:end])
    before, after = wrong[wrong < place], wrong[wrong >= place]
    return int(before[-1] + 1 if len(before) else begin), int(after[0] + period if len(after) else end)


def runs_of(codes: np.ndarray, longest: int, least: int = LEAST_WORDS) -> np.ndarray:
    """All runs in ``codes`` as rows (begin, end, period) in order of begin, then period.

    ``longest`` bounds the length of a run; codes that occur once bound runs too.
    """
    found: dict[tuple[int, int], int] = {}
    regions = []  # begin, end and period of all stretches known so far

    def add(begins, ends, period):
        regions.append(np.stack([begins, ends, np.full(len(begins), period)], axis=1))
        for run in zip(begins.tolist(), ends.tolist()):
            if run[1] - run[0] >= least:
                found[run] = min(period, found.get(run, period))

    for period in range(1, min(DIRECT, len(codes) - 1) + 1):
        add(*_direct(codes, period), period)
    windows, scale, members = Windows(codes, longest), 4, None
    # Contexts at a scale serve periods from 2.5 times the scale on, and a period is a third of a run at most.
    while 5 * scale * MOST_REPEATED <= 2 * longest and 4 * scale <= len(codes):
        hashes = windows.at(scale)
        known = np.concatenate(regions)
        known = known[(known[:, 2] * 3 <= scale) & (known[:, 1] - known[:, 0] >= scale)]
        edges = np.zeros(len(hashes) + 1, dtype=np.int32)
        np.add.at(edges, known[:, 0], 1)
        np.add.at(edges, known[:, 1] - scale + 1, -1)
        periodic = np.cumsum(edges[:-1]) > 0
        competing = np.where(periodic, _NOT, hashes)
        lowest = _least(competing, scale)
        n = len(lowest)
        chosen = (lowest != _NOT) & ((lowest == competing[:n]) | (lowest == competing[scale:]))
        members = chosen | (periodic[:n] if members is None else periodic[:n] & members[:n])
        places = np.flatnonzero(members)
        pairs = []
        for context in (4 * scale, 6 * scale):
            after = windows.at(4 * scale)
            if context > 4 * scale:
                wider = windows.at(2 * scale)[4 * scale:]
                after = _hashed(after[:len(wider)], wider)
            here = places[:np.searchsorted(places, len(after))]
            order = np.argsort(after[here], kind="stable")
            sorted_places, sorted_hashes = here[order], after[here][order]
            distance = np.diff(sorted_places)
            equal = (sorted_hashes[1:] == sorted_hashes[:-1]) & (distance > DIRECT) & (distance <= context)
            pairs.append(np.stack([sorted_places[:-1][equal], distance[equal]], axis=1))
        place, period = np.concatenate(pairs).T
        begin = place - windows.shared(place, place + period, -1)
        end = place + period + windows.shared(place, place + period, 1)
        long = end - begin >= np.maximum(least, MOST_REPEATED * period)
        proposed = np.stack([begin, end, period, place], axis=1)[long]
        if len(proposed):
            _, one_each = np.unique(proposed[:, :3], axis=0, return_index=True)
            for begin, end, period, place in proposed[one_each].tolist():
                begin, end = _verified(codes, place, begin, end, period)
                if end - begin >= max(least, MOST_REPEATED * period):
                    add(np.array([begin]), np.array([end]), period)
        scale *= 2
    runs = [(begin, end, period) for (begin, end), period in found.items()]
    return np.array(sorted(runs, key=lambda run: (run[0], run[2])), dtype=np.int64).reshape(-1, 3)


def _listed(flat: pa.Array, keep: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Lists that ``offsets`` cut from ``flat``, without the values not to keep."""
    kept = np.append(0, np.cumsum(keep))[offsets]
    return pa.ListArray.from_arrays(pa.array(kept, type=pa.int32()), flat.filter(pa.array(keep)))


def found_in(texts: pa.Array) -> tuple[np.ndarray, list[list[dict]], pa.Array]:
    """Words, runs and collapsed text of each text, its words divided by white space of the control codes and space."""
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    words = _listed(flat, pc.not_equal(flat, "").to_numpy(zero_copy_only=False), split.offsets.to_numpy() - split.offsets[0].as_py())
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    sizes, n = np.diff(offsets), len(texts)
    # One separator after each text.
    codes = np.empty(len(flat) + n, dtype=np.int64)
    separators = offsets[1:] + np.arange(n)
    of_words = np.ones(len(codes), dtype=bool)
    of_words[separators] = False
    codes[separators] = -1 - np.arange(n)
    codes[of_words] = flat.dictionary_encode().indices.to_numpy()
    longest = int(sizes.max(initial=0))
    runs = runs_of(codes, longest) if longest >= LEAST_WORDS else np.empty((0, 3), dtype=np.int64)
    lists: list[list[dict]] = [[] for _ in range(n)]
    edges = np.zeros(len(codes) + 1, dtype=np.int32)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = np.cumsum(edges[:-1])[of_words] == 0
    owners = np.searchsorted(separators, runs[:, 0])
    for owner, (begin, end, period) in zip(owners.tolist(), runs.tolist()):
        start = begin - int(offsets[owner]) - owner
        lists[owner].append({"start": start, "length": end - begin, "period": period})
    return sizes, lists, pc.binary_join(_listed(flat, kept, offsets), " ")


def grouped(texts: pa.Array) -> Iterator[np.ndarray]:
    """Places of texts of about the same length, ``GROUP_BYTES`` together or one text."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    upto, start = np.cumsum(lengths[order]), 0
    while start < len(order):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + GROUP_BYTES, side="right")))
        yield order[start:end]
        start = end


def runs(docs: DataFrame, carried: list[str], text: str = "text") -> DataFrame:
    """The columns ``carried``, as struct ``row``, and ``n_words``, ``runs`` by start and period (starts count words from
    0), and ``collapsed``: the words joined by one space, without those that a run holds after its first period."""
    rows = docs.select(
        F.struct(*[col(name) for name in carried]).alias("row"), F.coalesce(col(text), F.lit("")).alias("text")
    )

    def find(batches):
        for batch in batches:
            texts = batch.column("text")
            for places in grouped(texts):
                taken = pa.array(places)
                sizes, lists, collapsed = found_in(texts.take(taken))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(taken), pa.array(sizes), pa.array(lists, type=_RUNS), collapsed],
                    names=["row", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(find, T.StructType([rows.schema["row"], *T.StructType.fromDDL(FOUND).fields]))
