"""Alignment of two tokenizers: how often their ids end together, counted over the corpus.

Side A is a byte-level BPE, side B a BPE with byte fallback. Both cut the bytes of a space and the text; where tokens of
both end, groups end, and the two tokens that end there are linked. A link weighs what its pair of ids counts over the
corpus, and is best if no other partner of its B id counts more.

The pairs are counted by external spilling. Each task aligns its texts once, in blocks of about four million links,
and writes a block's pair-document records as zstd runs: one for each radix, the low bits of the B id, sorted by B id,
A id and document, with the links of each pair beside. A radix is then counted by a k-way heap merge of the pairs of its
runs, a bounded number at a time. As the order is B id first, the pairs of an id are through, and their maximum known, before
the next one begins. The counts stream back to the runs they came from, pair by pair, and from there to the documents
of each block.

A pair reaches the merge once for each block however many documents hold it, so an id that is in every text is no load,
and the documents of a block never leave it. Memory is that of a block, of the runs merged at a time, and of the pairs of a radix,
which the two vocabularies bound. The aligned table is written to the shared folder, which cuts the lineage.

Defined results: null and empty texts, and those that a tokenizer does not give back byte for byte, have no tokens, and
their figures are 0, their groups empty; special tokens' strings are plain text; rows repeated in full count row by row;
an empty table gives an empty result; other columns are carried along or ignored, whatever their names.
"""

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.texts import col
from aeroband.llm.token_files import groups as text_groups
from aeroband.session import written_once

RADIX_BITS = 8
GROUP_BYTES = 1 << 20  # texts aligned at a time
# Fixed value: how the byte-level tokenizer cuts texts into the pieces that it encodes by themselves.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = (
    "block long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "radix int, keys binary, counts binary, docs binary"
)


@dataclass(frozen=True)
class Limits:
    """What bounds memory; the results do not depend on it."""

    block_links: int = 1 << 22  # a block is closed at the first group of texts that reaches this
    block_docs: int = 1 << 16  # places in a block have 16 bits
    fan_in: int = 64
    runs_per_salt: int = 1024


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself if it is printable Latin-1,
    else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteSide:
    """Ids of a byte-level BPE from its ``tokenizer.json``. A token's id is its rank there, so that the faster encoder
    gives the same ids; ``tests/llm`` compares it on every character."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {token["id"] for token in described["added_tokens"] if token["special"]}
        letters = byte_alphabet()
        entries = {bytes(letters[c] for c in t): i for t, i in described["model"]["vocab"].items() if i not in special}
        self._encoding = tiktoken.Encoding("side", pat_str=PIECES, mergeable_ranks=entries, special_tokens={})
        self.entries = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            self.entries[i] = token

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64) for text in texts]


class PieceSide:
    """Ids of a sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [self._bytes(i) for i in range(self._model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64) for ids in self._model.encode(texts, num_threads=1)]


class Joined:
    """Byte strings looked up and laid end to end, many at once."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(entry) for entry in entries], dtype=np.int64)
        self._entries = pa.array(entries, type=pa.large_binary())

    def __call__(self, ids: np.ndarray) -> memoryview:
        if not len(ids):
            return memoryview(b"")
        taken = self._entries.take(pa.array(ids))
        offsets = taken.buffers()[1]
        first, last = np.frombuffer(offsets, dtype=np.int64)[[0, len(ids)]]
        return memoryview(taken.buffers()[2])[first:last]


class Aligner:
    """Tokens, groups and links of texts."""

    def __init__(self, a: str, b: str):
        self._sides = ByteSide(a), PieceSide(b)
        self._bytes = [Joined(side.entries) for side in self._sides]
        # A token in the text of its groups, by side, id, and whether it is its group's last.
        ends = ("|", ";")
        self._printed = Joined([
            f"{i}{mark}".encode() for side, end in zip(self._sides, ends) for i in range(len(side.entries)) for mark in (",", end)
        ])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text its figures and the hash of its groups; per link its text, A id and B id."""
        wanted = [b" " + text.encode() for text in texts]
        encoded, right = [], np.array([len(data) > 1 for data in wanted])
        for side, joined in zip(self._sides, self._bytes):
            ids = side(texts)
            data, start = joined(np.concatenate(ids)) if ids else memoryview(b""), 0
            for i, own in enumerate(ids):
                end = start + int(joined.sizes[own].sum())
                right[i] &= bytes(data[start:end]) == wanted[i]
                start = end
            encoded.append(ids)
        kept = np.flatnonzero(right).tolist()
        figures, hashes = np.zeros((len(texts), len(FIGURES)), dtype=np.int64), [""] * len(texts)
        if not kept:
            none = np.empty(0, dtype=np.int64)
            return figures, hashes, none, none, none
        a, b = (np.concatenate([ids[i] for i in kept]) for ids in encoded)
        n_a, n_b = (np.array([len(ids[i]) for i in kept]) for ids in encoded)
        # All texts end to end: both sides have the same bytes.
        ends_a, ends_b = (np.cumsum(joined.sizes[ids]) for joined, ids in zip(self._bytes, (a, b)))
        near = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[near] == ends_a)
        last_b = near[last_a]
        first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
        # The tokens of both sides in the order of groups, A before B.
        order = np.empty(len(a) + len(b), dtype=np.int64)
        closing_a, closing_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        closing_a[last_a], closing_b[last_b] = 1, 1
        order[np.arange(len(a)) + np.repeat(first_b, last_a - first_a + 1)] = 2 * a + closing_a
        order[np.arange(len(b)) + np.repeat(last_a + 1, last_b - first_b + 1)] = 2 * (len(self._sides[0].entries) + b) + closing_b
        printed, sizes = self._printed(order), self._printed.sizes[order]
        texts_end = np.cumsum(n_a + n_b)
        cuts = np.append(0, np.cumsum(sizes))[np.append(0, texts_end)].tolist()
        owner = np.searchsorted(np.cumsum(n_a), last_a, side="right")
        links = np.bincount(owner, minlength=len(kept))
        for k, i in enumerate(kept):
            hashes[i] = hashlib.sha256(printed[cuts[k]:cuts[k + 1] - 1]).hexdigest()
        figures[kept] = np.stack([n_a, n_b, links, links], axis=1)
        return figures, hashes, np.array(kept)[owner], a[last_a], b[last_b]


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """48 bits that order pairs by radix, B id and A id, each id below 2^24."""
    radixes = 1 << RADIX_BITS
    side = (b & (radixes - 1)) << (24 - RADIX_BITS) | b >> RADIX_BITS
    return (side << 24 | a).astype(np.uint64)


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values, dtype=kind).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)), "<u8")


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<u8"), dtype=np.uint64)


def _runs(links: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """A block's links (key and place of the document in one number) as a run for each radix: the distinct pairs, how
    often each is linked, and the records: documents per pair, the documents, and their links."""
    records, times = np.unique(np.concatenate(links), return_counts=True)
    keys, places = records >> np.uint64(16), (records & np.uint64(0xFFFF)).astype("<u2")
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    pairs, totals = keys[starts], np.add.reduceat(times, starts)
    edges = np.append(starts, len(records))
    radixes = (pairs >> np.uint64(48 - RADIX_BITS)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, radixes[1:] != radixes[:-1])).tolist() + [len(pairs)]
    for first, last in zip(cuts, cuts[1:]):
        own = slice(int(edges[first]), int(edges[last]))
        parts = [
            _packed(np.diff(edges[first:last + 1]), "<u4"), _packed(places[own], "<u2"), _packed(times[own], "<u4"),
        ]
        sizes = np.array([len(part) for part in parts], dtype="<u4").tobytes()
        docs = sizes + b"".join(parts)
        yield int(radixes[first]), _packed_keys(pairs[first:last]), _packed(totals[first:last], "<u8"), docs


def _records(docs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = 12 + np.cumsum(np.frombuffer(docs[:12], dtype="<u4"))
    parts = zip([12, *ends[:-1].tolist()], ends.tolist(), ("<u4", "<u2", "<u4"))
    per_pair, places, times = (_unpacked(docs[start:end], kind) for start, end, kind in parts)
    return per_pair, places, times


def aligned(
    docs: DataFrame, carried: list[str], a: str, b: str, text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """Two kinds of rows: of documents (``row`` with the columns carried, ``block``, ``place``, figures and the hash of the
    groups), and of runs (``block``, ``radix``, ``keys``, ``counts``, ``docs``), each with nulls for the other's columns."""
    rows = docs.select(
        F.struct(*[col(name) for name in carried]).alias("row"), F.coalesce(col(text), F.lit("")).alias("text")
    )
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *T.StructType.fromDDL(ALIGNED).fields])
    kinds = {"block": pa.int64(), "place": pa.int32(), "radix": pa.int32(), "groups_sha256": pa.string()}
    kinds |= dict.fromkeys(FIGURES, pa.int64()) | dict.fromkeys(["keys", "counts", "docs"], pa.binary())

    def align(batches):
        align_texts, number = Aligner(a, b), TaskContext.get().partitionId() << 32
        waiting, links, n_docs, n_links, row_type = [], [], 0, 0, None

        def batch_of(size, row, **columns):
            made = [row] + [
                pa.array(columns[name], type=kinds[name]) if name in columns else pa.nulls(size, kinds[name])
                for name in schema.names[1:]
            ]
            return pa.RecordBatch.from_arrays(made, names=schema.names)

        def closed():
            for row, columns in waiting:
                yield batch_of(len(row), row, block=np.full(len(row), number), **columns)
            if n_links:
                for radix, keys, counts, records in _runs(links):
                    yield batch_of(
                        1, pa.nulls(1, row_type), block=[number], radix=[radix], keys=[keys], counts=[counts], docs=[records]
                    )

        for batch in batches:
            row_type = batch.column("row").type
            for group in text_groups(batch.column("text"), GROUP_BYTES):
                figures, hashes, owner, ids_a, ids_b = align_texts(batch.column("text")[group].to_pylist())
                for start in range(0, len(hashes), limits.block_docs):
                    part = slice(start, min(start + limits.block_docs, len(hashes)))
                    size = part.stop - start
                    if n_docs + size > limits.block_docs or n_links >= limits.block_links:
                        yield from closed()
                        waiting, links, n_docs, n_links, number = [], [], 0, 0, number + 1
                    own = slice(*np.searchsorted(owner, [start, part.stop]))
                    columns = dict(zip(FIGURES, figures[part].T)) | {"groups_sha256": hashes[part]}
                    waiting.append((batch.column("row")[group][part], columns | {"place": np.arange(n_docs, n_docs + size)}))
                    places = (owner[own] - start + n_docs).astype(np.uint64)
                    links.append(pair_key(ids_a[own], ids_b[own]) << np.uint64(16) | places)
                    n_docs, n_links = n_docs + size, n_links + len(places)
        yield from closed()

    return rows.mapInArrow(align, schema)


def _merged(runs: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int]]:
    """The pairs of all runs in order, each with its links in all of them."""
    streams = [zip(_unpacked_keys(keys).tolist(), _unpacked(counts, "<u8").tolist()) for keys, counts in runs]
    for key, same in groupby(heapq.merge(*streams), itemgetter(0)):
        yield key, sum(n for _, n in same)


def _counted(runs: Iterator[tuple[bytes, bytes]], fan_in: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a radix, how often each is linked, and whether its B id has no better partner."""
    waiting: list[tuple[bytes, bytes]] = []
    for run in runs:
        waiting.append(run)
        if len(waiting) == fan_in:
            keys, counts = np.array(list(_merged(waiting)), dtype="<u8").T
            waiting = [(_packed_keys(keys), _packed(counts, "<u8"))]
    keys, counts, best = [], [], []
    for _, pairs in groupby(_merged(waiting), lambda pair: pair[0] >> 24):
        own, linked = zip(*pairs)
        most = max(linked)
        keys += own
        counts += linked
        best += [n == most for n in linked]
    return np.array(keys, dtype="<u8"), np.array(counts, dtype="<u8"), np.array(best, dtype=bool)


def _blobs(batches, *names) -> Iterator[tuple]:
    """The rows of batches, one at a time."""
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in names])


def pair_counts(runs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per radix: the packed ``keys`` of all its pairs in order, and the packed ``counts``, twice the number of links of
    each, and one more if it is the best of its B id."""
    def count(batches):
        for radix, rows in groupby(_blobs(batches, "radix", "keys", "counts"), itemgetter(0)):
            keys, counts, best = _counted(((keys, counts) for _, keys, counts in rows), limits.fan_in)
            made = [[radix], [_packed_keys(keys)], [_packed(counts * np.uint64(2) + best, "<u8")]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=t) for v, t in zip(made, (pa.int32(), pa.binary(), pa.binary()))],
                names=["radix", "keys", "counts"],
            )

    # A stated number: the merge is dense in time, not in bytes, by which Spark would join small partitions.
    tasks = min(1 << RADIX_BITS, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = runs.select("radix", "keys", "counts").repartition(tasks, "radix").sortWithinPartitions("radix")
    return spread.mapInArrow(count, "radix int, keys binary, counts binary")


def _answers(runs: DataFrame, totals: DataFrame, limits: Limits) -> DataFrame:
    """Per run its ``weights``: the counts, as ``pair_counts`` packs them, of its pairs.

    The runs of a radix are spread over as many salts as their number asks for, each with a copy of the counts.
    """
    most = runs.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
    salts = 1 + most // limits.runs_per_salt
    none = F.lit(None).cast("binary")
    asked = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), "block", "keys", none.alias("counts"))
    known = totals.select(
        "radix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("long").alias("block"),
        "keys", "counts",
    )

    def answer(batches):
        keys = weights = None
        for radix, block, packed, counts in _blobs(batches, "radix", "block", "keys", "counts"):
            if block is None:
                keys, weights = _unpacked_keys(packed), _unpacked(counts, "<u8")
                continue
            found = weights[np.searchsorted(keys, _unpacked_keys(packed))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([radix], type=pa.int32()), pa.array([_packed(found, "<u8")], type=pa.binary())],
                names=["block", "radix", "weights"],
            )

    # Nulls come first: the counts of a radix precede the runs that ask for them.
    both = asked.union(known).repartition("radix", "salt").sortWithinPartitions("radix", "salt", "block")
    return both.mapInArrow(answer, "block long, radix int, weights binary")


def _contributions(runs: DataFrame, answers: DataFrame, limits: Limits) -> DataFrame:
    """Per document with links, ``block`` and ``place``: ``n_best`` and ``count_sum``."""
    none = F.lit(None).cast("binary")
    both = runs.select("block", "radix", "docs", none.alias("weights")).union(
        answers.select("block", "radix", none.alias("docs"), "weights")
    )

    def gather(batches):
        rows = _blobs(batches, "block", "radix", "docs", "weights")
        for block, of_block in groupby(rows, itemgetter(0)):
            best, sums = np.zeros(limits.block_docs, dtype=np.int64), np.zeros(limits.block_docs, dtype=np.int64)
            linked, weights = np.zeros(limits.block_docs, dtype=bool), None
            for _, _, docs, counts in of_block:
                if docs is None:
                    weights = _unpacked(counts, "<u8").astype(np.int64)
                    continue
                per_pair, places, times = _records(docs)
                each = np.repeat(weights, per_pair)
                np.add.at(sums, places, (each >> 1) * times)
                np.add.at(best, places, (each & 1) * times)
                linked[places] = True
            places = np.flatnonzero(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(places), block)), pa.array(places, type=pa.int32()), pa.array(best[places]), pa.array(sums[places])],
                names=["block", "place", "n_best", "count_sum"],
            )

    ordered = both.repartition("block").sortWithinPartitions("block", "radix", F.col("docs").isNotNull())
    return ordered.mapInArrow(gather, "block long, place int, n_best long, count_sum long")


class Alignment:
    """The alignment of a table of documents, written once; ``a`` and ``b`` are the paths of the tokenizers."""

    def __init__(
        self, docs: DataFrame, carried: list[str], a: str, b: str, text: str = "text", limits: Limits = Limits()
    ):
        table = written_once(aligned(docs, carried, a, b, text, limits))
        self._limits = limits
        self._docs = table.filter("place is not null").select("row", "block", "place", *FIGURES, "groups_sha256")
        self._runs = table.filter("radix is not null").select("block", "radix", "keys", "counts", "docs")
        self._totals = written_once(pair_counts(self._runs, limits))

    def documents(self) -> DataFrame:
        """Per document: ``row``, the figures, ``n_best`` links whose pair is the best of its B id, ``count_sum``, the
        counts of all its links' pairs together, and ``groups_sha256``."""
        found = _contributions(self._runs, _answers(self._runs, self._totals, self._limits), self._limits)
        columns = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_best", "count_sum")]
        return self._docs.join(found, ["block", "place"], "left").select("row", *FIGURES, *columns, "groups_sha256")

    def pairs(self) -> DataFrame:
        """Every pair of ids that is linked: ``a``, ``b``, ``count``, and ``best``, whether no other ``a`` counts more."""
        def unpack(batches):
            for keys, counts in _blobs(batches, "keys", "counts"):
                keys, counts = _unpacked_keys(keys).astype(np.int64), _unpacked(counts, "<u8").astype(np.int64)
                side = keys >> 24
                b = (side & ((1 << 24 - RADIX_BITS) - 1)) << RADIX_BITS | side >> (24 - RADIX_BITS)
                made = [keys & 0xFFFFFF, b, counts >> 1, (counts & 1).astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in made], names=["a", "b", "count", "best"])

        return self._totals.mapInArrow(unpack, "a long, b long, count long, best boolean")
