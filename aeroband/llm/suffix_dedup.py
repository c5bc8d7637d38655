"""Removal of every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere in the corpus.

One suffix array of the corpus cannot be shared out, so texts are cut into pieces whose strings can only equal strings
of pieces with the same key, and suffix arrays are built of shards of such pieces:

1. Pieces. Of each string of ``LENGTH`` bytes (a window) the 64-byte gram with the least hash, the last of equal ones,
   is the anchor. Equal windows have equal anchors at the same place. Consecutive windows with the same anchor are a
   piece; its key is the hash of the gram. Only places and hashes are exchanged, some 2 pieces per 340 bytes.
2. Equal pieces (digest of all their bytes) found twice or more are repeated as a whole, whatever their number; one of
   each goes on, if other pieces have its key. Pieces with a key of their own are not repeated.
3. Different pieces of one key are fetched, once each, and gathered in shards of about ``SHARD`` bytes. In a shard the
   suffixes are sorted by induced sorting, the permuted common prefixes computed, and a window is repeated if it has
   ``LENGTH`` bytes in common with a neighbour in the order.
4. A key with more than ``CROWD`` different pieces is split before that: windows at the first half of the distances
   from the anchor, and those at the second, all contain a common core of bytes, by whose hash they are keyed anew. The
   cores grow with each split until they are whole windows, so that the split ends, and nothing is capped.

Digests are 64-bit hashes beside a 64-bit key; texts are told apart by 128 bits.

Defined results: null and empty texts, and those under ``LENGTH`` bytes, lose nothing; equal texts, rows repeated in
full included, repeat each other; an empty table gives an empty result; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.llm import spans
from aeroband.llm.suffix_array import permuted_prefixes, suffix_array
from aeroband.llm.texts import col
from aeroband.session import written_once

LENGTH = 400
GRAM = 64
SHARD = 1 << 20
CROWD = 1000
BLOCK = 1 << 19  # bytes that anchors are found in at a time
PLACE_BITS = 20
BASE = np.uint64(0x9E3779B97F4A7C15)
TEXT = ["t1", "t2"]
PIECE = ["key", "digest"]


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, np.uint64(base), dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Anchors:
    """Finds the pieces of texts, for windows of ``length`` bytes."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.width = length - gram + 1  # grams in a window
        self._up = _powers(int(BASE), BLOCK + length)
        self._down = _powers(pow(int(BASE), -1, 1 << 64), BLOCK + length)

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """A rolling polynomial hash of each gram, mixed."""
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self._up[:len(codes)], out=sums[1:])
        hashes = (sums[self.gram:] - sums[:-self.gram]) * self._down[:len(codes) - self.gram + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        return hashes

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least of each ``width`` consecutive values, from running minima within blocks of that many."""
        width, n = self.width, len(values)
        padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:n] = values
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        return np.minimum(behind[:n - width + 1], ahead[width - 1:n])

    def pieces(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows, place of the anchor, and key of every piece."""
        codes = np.frombuffer(data, dtype=np.uint8)
        found = []
        for at in range(0, len(codes) - self.length + 1, BLOCK):
            hashes = self.grams(codes[at:at + BLOCK + self.length - 1])
            places = np.arange(len(hashes), dtype=np.uint64)
            mask = np.uint64((1 << PLACE_BITS) - 1)
            anchors = mask - (self.least((hashes & ~mask) | (mask - places)) & mask)
            starts = np.flatnonzero(np.diff(anchors, prepend=mask))
            sizes = np.diff(np.append(starts, len(anchors)))
            own = anchors[starts].astype(np.int64)
            found.append((starts + at, sizes, own + at, hashes[own].view(np.int64)))
        if not found:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
        return tuple(np.concatenate(parts) for parts in zip(*found))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pieces(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``t1``, ``t2``, ``key``, ``digest``, ``start``, ``size`` (windows) and ``anchor`` (from the start) of all pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, gram)
        for batch in batches:
            for t1, t2, text in zip(*(batch.column(c) for c in TEXT), batch.column("text").cast(pa.binary())):
                data = text.as_py()
                if not data or len(data) < length:
                    continue
                starts, sizes, anchors, keys = find.pieces(data)
                digest = xxhash.xxh3_64_digest
                ends = (starts + sizes + (length - 1)).tolist()
                digests = b"".join([digest(data[a:b]) for a, b in zip(starts.tolist(), ends)])
                n = len(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([t1.as_py()] * n, type=pa.int64()), pa.array([t2.as_py()] * n, type=pa.int64()),
                    pa.array(keys), pa.array(np.frombuffer(digests, dtype=np.int64)), pa.array(starts),
                    pa.array(sizes.astype(np.int32)), pa.array((anchors - starts).astype(np.int32)),
                ], names=[*TEXT, *PIECE, "start", "size", "anchor"])

    return texts.mapInArrow(run, "t1 long, t2 long, key long, digest long, start long, size int, anchor int")


def _contents(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of each wanted piece, out of the one copy of its text that is kept for that."""
    fields = ["start", "size", "anchor", "n", *PIECE]
    lists = wanted.groupBy(*TEXT).agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    once = texts.groupBy(*TEXT).agg(F.first("text").alias("text"))

    def run(batches):
        schema = ["key", "digest", "n", "anchor", "size", "content"]
        for batch in batches:
            for text, items in zip(batch.column("text").cast(pa.binary()), batch.column("wanted")):
                data = text.as_py()
                rows = [(i["key"], i["digest"], i["n"], i["anchor"], i["size"],
                         data[i["start"]:i["start"] + i["size"] + length - 1]) for i in items.as_py()]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=schema)

    return lists.join(once, TEXT).select("wanted", "text").mapInArrow(
        run, "key long, digest long, n long, anchor int, size int, content binary"
    )


def _repeated_in_shard(contents: list[bytes], sizes: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """(number of the piece, first and last window) of each run of repeated windows in a shard of different pieces."""
    lengths = np.array([len(c) for c in contents])
    starts = np.cumsum(lengths + 1) - lengths - 1
    # Bytes become 2 to 257; 1 follows each piece, 0 ends the shard.
    text = np.ones(int(lengths.sum()) + len(contents) + 1, dtype=np.int16)
    inside = np.ones(len(text), dtype=bool)
    inside[starts + lengths] = False
    inside[-1] = False
    text[inside] = np.frombuffer(b"".join(contents), dtype=np.uint8).astype(np.int16) + 2
    text[-1] = 0
    order = suffix_array(text)
    long = permuted_prefixes(text, order) >= length
    repeated = long.copy()
    repeated[order[:-1]] |= long[order[1:]]
    # Between the windows of two pieces are the other bytes of the first one's last window, so no run holds both.
    window = np.zeros(len(text), dtype=np.int8)
    window[starts], window[starts + np.array(sizes)] = 1, -1
    edges = np.flatnonzero(np.diff((repeated & (np.cumsum(window) > 0)).astype(np.int8), prepend=0, append=0))
    firsts, after = edges[::2], edges[1::2]
    numbers = np.searchsorted(starts, firsts, side="right") - 1
    own = starts[numbers]
    yield from zip(numbers.tolist(), (firsts - own).tolist(), (after - 1 - own).tolist())


def _sorted_shards(members: DataFrame, length: int, shard: int) -> DataFrame:
    """Repeated windows (``key``, ``digest``, ``first``, ``last``) of pieces whose keys have few enough of them."""

    def run(batches):
        def done():
            rows = [(*ids[i], first, last) for i, first, last in _repeated_in_shard(contents, sizes, length)]
            columns = zip(*rows) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.int32()])],
                names=["key", "digest", "first", "last"],
            )

        ids, contents, sizes, total, group = [], [], [], 0, None
        for batch in batches:
            groups = batch.column("group").to_pylist()
            keys, digests = batch.column("key").to_pylist(), batch.column("digest").to_pylist()
            for i, (own, size, content) in enumerate(zip(groups, batch.column("size").to_pylist(), batch.column("content"))):
                if total >= shard and own != group:
                    yield done()
                    ids, contents, sizes, total = [], [], [], 0
                group = own
                ids.append((keys[i], digests[i]))
                contents.append(content.as_py())
                sizes.append(size)
                total += len(contents[-1])
        if contents:
            yield done()

    ordered = members.select("group", *PIECE, "size", "content").repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(run, "key long, digest long, first int, last int")


def _halves(crowded: DataFrame, level: int, length: int, gram: int) -> DataFrame:
    """The pieces of crowded groups, split where the distance of a window from its anchor crosses a half.

    ``low`` and ``high`` are those distances; ``content`` and ``anchor`` go with the windows that are left. The new
    group is the hash of the core that all windows of the half of that level contain, and of the half.
    """
    most = length - gram
    width = max(1, 1 << (most.bit_length() - level))

    def run(batches):
        names = ["group", "member", "key", "digest", "n", "low", "high", "anchor", "content", "offset"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
        for batch in batches:
            rows = []
            for item in batch.to_pylist():
                anchor, content = item["anchor"], item["content"]
                for half in range(item["low"] // width, item["high"] // width + 1):
                    low, high = max(item["low"], half * width), min(item["high"], (half + 1) * width - 1)
                    top = min((half + 1) * width - 1, most)
                    core = content[anchor - half * width:anchor - top + length]
                    part = content[anchor - high:anchor - low + length]
                    group = _signed(xxhash.xxh3_64_intdigest(core, seed=half << 8 | level))
                    member = _signed(xxhash.xxh3_64_intdigest(part))
                    rows.append((group, member, item["key"], item["digest"], item["n"], low, high, high, part,
                                 item["offset"] + anchor - high))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

    return crowded.select(*PIECE, "n", "low", "high", "anchor", "content", "offset").mapInArrow(
        run, "group long, member long, key long, digest long, n long, low int, high int, anchor int, content binary, offset int"
    )


def _of_crowds(crowded: DataFrame, length: int, gram: int, shard: int, crowd: int) -> DataFrame:
    """Repeated windows of the pieces of crowded keys, by splitting them until no group is crowded.

    A round per level, at most the logarithm of the distances; each is written, with its size read from one row.
    """
    found, level = [], 0
    owned = crowded.select(
        *PIECE, "n", (F.col("anchor") - F.col("size") + 1).alias("low"), F.col("anchor").alias("high"), "anchor", "content",
        F.lit(0).alias("offset"),
    )
    while True:
        level += 1
        halves = written_once(_halves(owned, level, length, gram))
        members = halves.groupBy("group", "member").agg(F.sum("n").alias("total"))
        groups = members.groupBy("group").agg(F.count("*").alias("members"))
        marked = halves.join(members, ["group", "member"]).join(groups, "group")
        offset, size = F.col("offset"), F.col("high") - F.col("low") + 1
        found.append(marked.filter("total > 1").select(
            *PIECE, offset.alias("first"), (offset + size - 1).alias("last")
        ))
        few = marked.filter((F.col("members") > 1) & (F.col("members") <= crowd))
        once = few.groupBy("group", "member").agg(F.first("content").alias("content"), F.first(size).alias("size"))
        sorted_ = _sorted_shards(
            once.select("group", F.col("group").alias("key"), F.col("member").alias("digest"), "size", "content"), length, shard
        ).select(F.col("key").alias("group"), F.col("digest").alias("member"), "first", "last")
        found.append(few.join(sorted_, ["group", "member"]).select(
            *PIECE, (offset + F.col("first")).alias("first"), (offset + F.col("last")).alias("last")
        ))
        many = marked.filter(F.col("members") > crowd)
        if many.limit(1).count() == 0:
            break
        owned = many.select(*PIECE, "n", "low", "high", "anchor", "content", "offset")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """``t1``, ``t2``, ``start`` and ``end`` of the strings of at least ``length`` bytes that also start elsewhere.

    ``texts`` has ``t1`` and ``t2``, which tell texts apart, and ``text``, once for every document with it.
    """
    found = written_once(pieces(texts, length, gram))
    place = F.struct(*TEXT, "start", "size", "anchor")
    kinds = found.groupBy(*PIECE).agg(F.count("*").alias("n"), F.min(place).alias("one"))
    keys = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    shared = written_once(kinds.join(keys, "key").select(*PIECE, "n", "kinds", "one.*"))
    whole = shared.filter("n > 1").select(*PIECE, F.lit(0).alias("first"), (F.col("size") - 1).alias("last"))
    contents = written_once(
        _contents(shared.filter("kinds > 1"), texts, length).join(shared.select(*PIECE, "kinds"), PIECE)
    )
    few = contents.filter(F.col("kinds") <= crowd).withColumn("group", F.col("key"))
    windows = whole.unionByName(_sorted_shards(few, length, shard))
    crowded = contents.filter(F.col("kinds") > crowd)
    if crowded.limit(1).count():
        windows = windows.unionByName(_of_crowds(crowded, length, gram, shard, crowd))
    return found.join(windows, PIECE).select(
        *TEXT, (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + length).alias("end")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, **sizes) -> DataFrame:
    """A row per document: size, removed bytes and runs, hash of the rest (and the rest)."""
    text = F.coalesce(col("text"), F.lit(""))
    rows = docs.select(
        col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"),
    )
    found = repeated_spans(rows.select(*TEXT, "text"), length, **sizes)
    return spans.cut(rows, found, TEXT, with_text=with_text)
