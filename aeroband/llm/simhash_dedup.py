"""Near-duplicates by SimHash, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The binary Golay code puts every 23-bit word within
three bits of exactly one codeword; the codewords that the word and its one-bit neighbours decode to (one or six of
them) are its keys, and two words within two bits share a neighbour and so a key. Of two differing bits at least one
segment has none (pigeonhole), so fingerprints within two bits agree on one whole segment and on a Golay key of the
next: three kinds of keys, joined and verified.

Keys shared by more than ``BUCKET`` distinct fingerprints are not paired. Their fingerprints list their 65 words
within one bit instead: two fingerprints share such a word exactly if they are within two bits, and no word has more
than 65 of them. Nothing is capped.

Defined results: null and empty texts have fingerprint zero and are linked like others; repeated rows each get their
row; a null id never is a component's least id unless all are null; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.components import connected_components
from aeroband.llm.texts import add_columns, col, packed, row_hash, unpacked
from aeroband.session import written_once

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BUCKET = 64
SEGMENTS = [(0, 23), (23, 23), (46, 18)]  # lowest bit, width
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the code of length 23
BLOCK = 1 << 15


def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the XXH64 of the text's shingles; a signed 64-bit number."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    if len(words) <= shingle:
        digests = [xxhash.xxh64_digest(joined, SEED)]
    else:
        last = ends[shingle - 1:].tolist()
        first = [0, *(ends[:len(words) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_digest
        digests = [digest(joined[a:b], SEED) for a, b in zip(first, last)]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(digests), BLOCK):
        part = np.frombuffer(b"".join(digests[at:at + BLOCK]), dtype=np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > len(digests)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, carried: list[str], shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``carried`` and ``fp``."""
    rows = docs.select(*[col(name) for name in carried], col("text").alias("__text"))
    field = T.StructType([T.StructField("fp", T.LongType())])
    return add_columns(rows, "__text", field, lambda data: (fingerprint(data, shingle),))


def _remainders() -> np.ndarray:
    """Remainder of every 23-bit power sum: a row per bit, to be combined by exclusive or."""
    out = []
    for bit in range(23):
        value = 1 << bit
        for high in range(bit, 10, -1):
            if value >> high & 1:
                value ^= GENERATOR << (high - 11)
        out.append(value)
    return np.array(out, dtype=np.int64)


class Golay:
    """Decoder of the perfect (23, 12) code: the index of the codeword within three bits."""

    def __init__(self):
        rests = _remainders()
        self._low, self._high = self._table(rests[:12]), self._table(rests[12:])
        self._errors = np.zeros(1 << 11, dtype=np.int64)
        bits = [0, *(1 << i for i in range(23))]
        patterns = np.unique([a | b | c for a in bits for b in bits for c in bits])
        self._errors[self.syndrome(patterns)] = patterns

    @staticmethod
    def _table(rests: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << len(rests), dtype=np.int64)
        for bit, rest in enumerate(rests):
            table[1 << bit:2 << bit] = table[:1 << bit] ^ rest
        return table

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self._low[words & 0xFFF] ^ self._high[words >> 12]

    def decode(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self._errors[self.syndrome(words)]) >> 11

    def keys(self, words: np.ndarray, width: int) -> np.ndarray:
        """A row per word: the codewords of the word and its neighbours in the first ``width`` bits, sorted."""
        flips = np.array([0, *(1 << i for i in range(width))], dtype=np.int64)
        return np.sort(self.decode(words[:, None] ^ flips[None, :]), axis=1)


def golay_keys(fps: DataFrame) -> DataFrame:
    """``fp`` and ``key``: kind, one whole segment, and each Golay key of the next segment."""

    def run(batches):
        code = Golay()
        for batch in batches:
            values = batch.column("fp").to_numpy().astype(np.uint64)
            parts = [
                ((values >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS
            ]
            for kind in range(3):
                near = (kind + 1) % 3
                found = code.keys(parts[near], SEGMENTS[near][1])
                new = np.ones(found.shape, dtype=bool)
                new[:, 1:] = found[:, 1:] != found[:, :-1]
                row, _ = np.nonzero(new)
                key = (np.int64(kind) << 60) | (parts[kind][row] << 12) | found[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[row].astype(np.int64)), pa.array(key)], names=["fp", "key"]
                )

    return fps.select("fp").mapInArrow(run, "fp long, key long")


def _pairs_of_buckets(buckets: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs of the fingerprints of one bucket, at most ``BUCKET`` of them."""

    def run(batches):
        for batch in batches:
            us, vs = [], []
            for fps in batch.column("fps").to_pylist():
                words = np.array(sorted(fps), dtype=np.int64)
                apart = np.bitwise_count((words[:, None] ^ words[None, :]).view(np.uint64))
                u, v = np.nonzero(np.triu(apart <= max_bits, 1))
                us.append(words[u])
                vs.append(words[v])
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
                )

    return buckets.select("fps").mapInArrow(run, "u long, v long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (``u``, ``v``) between distinct fingerprints with the components of all pairs within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("Golay keys find fingerprints within two bits")
    keys = golay_keys(fps)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written_once(keys.join(sizes, "key"))
    small = shared.filter(F.col("n") <= bucket).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(64)])
    hot = shared.filter(F.col("n") > bucket).select("fp").distinct()
    # Within one bit of a shared word: two fingerprints are within two bits. For a smaller bound they are verified.
    words = hot.withColumn("flip", F.explode(flips)).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    balls = words.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    if max_bits == 2:
        stars = balls.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).filter("u <> v")
    else:
        stars = _pairs_of_buckets(balls, max_bits)
    return _pairs_of_buckets(small, max_bits).union(stars)


def components(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp`` and ``component_id``, the least ``doc_id`` its fingerprint is linked to, over (``doc_id``, ``fp``)."""
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(nodes, max_bits))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(ids, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``fingerprint`` in hex, and ``component_id``."""
    marked = written_once(fingerprints(docs.select(col("doc_id"), col("text")), ["doc_id"], shingle))
    return marked.join(components(marked, max_bits), "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the least id (null last), with the columns it came with.

    Only ids and hashes go through the search; the texts are exchanged once, to meet the chosen ids.
    """
    rows = docs.select(
        col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row"), packed(docs).alias("packed"),
        col("text").alias("text"),
    )
    marked = written_once(fingerprints(rows.select("doc_id", "row", "text"), ["doc_id", "row"], shingle))
    chosen = (
        marked.join(components(marked, max_bits).select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
        .select(F.col("first.doc_id").alias("chosen_id"), F.col("first.row").alias("row"))
    )
    met = rows.drop("text").join(chosen, "row").filter(F.col("doc_id").eqNullSafe(F.col("chosen_id")))
    nth = F.row_number().over(Window.partitionBy("row", "chosen_id").orderBy("row"))  # of rows repeated in full
    return unpacked(met.withColumn("nth", nth).filter("nth = 1"), "packed", docs)
