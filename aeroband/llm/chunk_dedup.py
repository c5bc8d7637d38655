"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where its high bits are zero, so an insertion moves the chunks around it
and no others. Chunks are compared by a 128-bit digest. The first one in order of document id and place stays, later
ones go, however short.

Only digests and places are exchanged, combined per task first: a chunk that most documents share sends one row per
task. Texts are exchanged once, to meet their spans.

Defined results: null and empty texts have no chunk; a null id comes before others; rows repeated in full count as one
document and are cut alike; an empty table gives an empty result; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.llm import spans
from aeroband.llm.texts import col

ENDS = 5  # zero bits at an end: chunks of some 32 bytes after the least
LEAST, MOST = 16, 256  # with 32, one in 80 passages of 300 bytes holds no whole chunk
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 7) for i in range(256)], dtype=np.uint32)
BLOCK = 1 << 20


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, a sum of the last 32 gears shifted by their distance, by doubling."""
    hashes = GEAR[data]
    step = 1
    while step < 32:
        hashes[step:] += hashes[:-step] << np.uint32(step)
        step *= 2
    return hashes


def chunk_ends(data: bytes) -> list[int]:
    """The ends of the chunks of a text, the last being its length."""
    codes = np.frombuffer(data, dtype=np.uint8)
    found = []
    for at in range(0, len(codes), BLOCK):  # 31 bytes before a block reach into it
        before = min(at, 31)
        hashes = gear_hashes(codes[at - before:at + BLOCK])[before:]
        found.append(np.flatnonzero(hashes >> np.uint32(32 - ENDS) == 0) + at + 1)
    ends, last = [], 0
    for end in (np.concatenate(found).tolist() if found else []) + [len(data)]:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST or end == len(data) > last:
            ends.append(end)
            last = end
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """``a``, ``b`` (the digest), ``doc_id``, ``doc``, ``start`` and ``end`` of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, doc, text in zip(batch.column("doc_id"), batch.column("doc"), batch.column("text").cast(pa.binary())):
                data = text.as_py()
                if not data:
                    continue
                ends = chunk_ends(data)
                starts = [0, *ends[:-1]]
                digests = b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts, ends)])
                halves = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
                n = len(ends)
                yield pa.RecordBatch.from_arrays([
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array([doc_id.as_py()] * n, type=pa.int64()),
                    pa.array([doc.as_py()] * n, type=pa.int64()), pa.array(starts, type=pa.int32()),
                    pa.array(ends, type=pa.int32()),
                ], names=["a", "b", "doc_id", "doc", "start", "end"])

    return docs.select("doc_id", "doc", "text").mapInArrow(run, "a long, b long, doc_id long, doc long, start int, end int")


def repeated_chunks(found: DataFrame) -> DataFrame:
    """The chunks that are not the first of their digest."""
    place = F.struct("doc_id", "doc", "start")
    first = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    again = found.join(first, ["a", "b"])
    return again.filter(place != F.col("first")).select("doc", "start", "end")


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """A row per document: size, removed bytes and runs, hash of the rest (and the rest)."""
    rows = docs.select(
        col("doc_id").cast("long").alias("doc_id"), F.xxhash64(col("doc_id"), col("text")).alias("doc"),
        col("text").alias("text"),
    )
    return spans.cut(rows, repeated_chunks(chunks(rows)), ["doc"], with_text=with_text)
