"""Token ids in binary files: frequency-ranked ids in a byte-aligned code of variable length.

Within a block, ids are replaced by their rank by frequency, so that the commonest 256 take one byte, all others two.
A rank takes one to four bytes; the lengths, two bits each, are control bytes apart from the data bytes, so that a
decoder looks four lengths up at once and never branches on data. The ids in order of rank precede the block, in the
same code. Ranking per block makes one pass over the texts enough: the tokenizer is by far the largest cost.

A file set is a Parquet table, which any store that Spark writes to can hold and whose commit leaves nothing of lost
tasks behind. Its rows are blocks. A block belongs to a shard (the documents of one task, which are a range of ids in
order), knows how many ids of the shard precede it, and holds the ids and lengths of its documents, control bytes and
data bytes. Blocks can be read in any order, each by itself.

Defined results: null and empty texts have only the end id; documents come in ascending order of id, null first, those
with equal ids in the order of a hash of their text, rows repeated in full in any; an empty table gives an empty file
set; other columns are ignored.
"""

import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.texts import col

END_ID = 2
BLOCK_IDS = 1 << 20  # a block is closed at the first document that reaches this
CACHED_WORDS = 800_000
BLOCKS = (
    "shard int, block int, before long, doc_ids array<long>, lengths array<long>, n_ranks long, rank_control binary, "
    "rank_data binary, control binary, data binary"
)
BLOCK_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("n_ranks", pa.int64()), ("rank_control", pa.binary()), ("rank_data", pa.binary()),
    ("control", pa.binary()), ("data", pa.binary()),
])

# The code: lengths[c] are the byte lengths of the four ranks that control byte c stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    used = np.arange(4) < lengths[:, None]
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[:len(ranks)] = lengths - 1
    fours = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)
    return np.bitwise_or.reduce(fours, axis=1).astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8)
    ranks = np.zeros(count, dtype=np.uint32)
    for k in range(4):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


class WordEncoder:
    """Ids of a text by a tokenizer that treats words between spaces and line ends separately, remembering words.

    The tokenizer must normalize to NFC, drop white space and never join across it, put letters in lower case one by one,
    and keep letters apart from ``MARKS`` after them; then a word is looked up in lower case, its marks by themselves. ``CACHED_WORDS``
    bounds the memory, not the result.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # Whether plain letters reach the model as they are, and in one word.
        self._direct = all(self._by_model(word) == self._encoded([word])[0].ids for word in (LETTERS, LETTERS[::-1]))
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {"": 0}  # the places of words in the next two
        self._sizes, self._ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")

    def _encoded(self, texts: list[str]) -> list:
        return self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # without places in the text

    def _by_model(self, word: str) -> list[int]:
        return [token.id for token in self._model.tokenize(word)]

    def _learn(self, words: list[str]) -> None:
        """Plain letters in lower case go to the tokenizer's model, which spares them its steps before. Other words of
        letters are encoded together, as each ends in an id that marks the end of a word; the rest, or all if
        that does not hold, one by one."""
        plain, letters, others = [], [], []
        for word in words:
            if not word.isalpha():
                others.append(word)
            elif self._direct and word.isascii() and word.islower():
                plain.append(word)
            else:
                letters.append(word)
        found = list(map(self._by_model, plain))
        learnt, ids = plain, [np.fromiter(chain.from_iterable(found), dtype="<u4")]
        sizes = [np.fromiter(map(len, found), dtype=np.int64, count=len(found))]
        for at in range(0, len(letters), TOGETHER):
            some = letters[at:at + TOGETHER]
            joined = np.array(self._encoded([" ".join(some)])[0].ids, dtype="<u4")
            ends = np.flatnonzero(self._ends[joined]) + 1
            if len(ends) == len(some) and ends[-1] == len(joined):
                learnt += some
                ids.append(joined)
                sizes.append(np.diff(ends, prepend=0))
            else:
                others += some
        found = [one.ids for one in self._encoded(others)]
        learnt += others
        ids.append(np.fromiter(chain.from_iterable(found), dtype="<u4"))
        sizes.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
        self._known.update(zip(learnt, range(len(self._known), len(self._known) + len(learnt))))
        self._ids, self._sizes = np.concatenate([self._ids, *ids]), np.concatenate([self._sizes, *sizes])

    @staticmethod
    def _odd_parts(words: list[str]) -> tuple[list[str], list[str]]:
        """The same of words that are not plain letters and marks."""
        bases, marks = [], []
        for word in words:
            base = word.rstrip(MARKS)
            # Lower case of the odd letters depends on context or is two characters. A letter that the tokenizer's normal
            # form takes apart ends in a sign, which is not a letter and stays with the marks.
            if base.isalpha() and ODD_LETTERS.isdisjoint(base) and is_normalized("NFC", base):
                bases.append(base.lower())
                marks.append(word[len(base):])
            else:
                bases.append(word)
                marks.append("")
        return bases, marks

    @classmethod
    def _parts(cls, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """What is looked up for words: letters in lower case, and the marks after them; or the word, and nothing."""
        bases = pc.ascii_rtrim(words, MARKS)
        plain = pc.ascii_is_alpha(bases)
        odd = pc.invert(plain)
        bases, marks = pc.ascii_lower(bases), pc.ascii_ltrim(words, LETTERS + LETTERS.upper())
        found = cls._odd_parts(listed(words.filter(odd)))
        return tuple(
            pc.replace_with_mask(some, odd, pa.array(others, type=words.type)) for some, others in zip((bases, marks), found)
        )

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (null: none). Words are told apart by Arrow; each different part is looked up once."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        bases, marks = self._parts(coded.dictionary)
        parts = pa.concat_arrays([bases, marks]).dictionary_encode()
        names = listed(parts.dictionary)
        new = [name for name in names if name not in self._known]
        if len(self._known) + len(new) > CACHED_WORDS:
            self._forget()
            new = [name for name in names if name]
        self._learn(new)
        known = np.fromiter(map(self._known.__getitem__, names), dtype=np.int64, count=len(names))
        pairs = known[parts.indices.to_numpy()].reshape(2, -1).T  # the base and the marks of each word
        entries, _ = laid_out(self._ids, self._sizes, pairs.reshape(-1))
        ids, ends = laid_out(entries, self._sizes[pairs].sum(axis=1), coded.indices.to_numpy())
        last_words = np.cumsum(pc.list_value_length(split).to_numpy()) - 1  # a text has one word at least, if an empty one
        return np.split(ids, ends[last_words][:-1])


def listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def laid_out(values: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen ones of the runs of these sizes that ``values`` consists of, in a row, and where each of them ends."""
    lengths = sizes[chosen]
    ends = np.cumsum(lengths)
    starts = (np.cumsum(sizes) - sizes)[chosen]
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(lengths.sum())], ends


WORD_END = "</w>"
TOGETHER = 5000
MARKS = ".,!?;:#*$%&"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
TEXT_BYTES = 1 << 22  # texts are encoded in groups that end at the first one to reach this
ODD_LETTERS = {"\u0130", "\u03a3"}


def groups(texts: pa.Array, size: int = TEXT_BYTES) -> Iterator[slice]:
    """Runs of texts of about ``size`` bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(upto):
        before = upto[start - 1] if start else 0
        end = min(int(np.searchsorted(upto, before + size)) + 1, len(upto))
        yield slice(start, end)
        start = end


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block: int = BLOCK_IDS) -> None:
    """Write the ids of all documents, in ascending order of ``doc_id``, to a new file set."""
    def pack(batches):
        shard, encode = TaskContext.get().partitionId(), WordEncoder(tokenizer)
        number, before, ids, lengths, found = 0, 0, [], [], []

        def closed():
            values = np.concatenate(found)
            counts = np.bincount(values)
            by_rank = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
            ranks = np.zeros(len(counts), dtype="<u4")
            ranks[by_rank] = np.arange(len(by_rank), dtype="<u4")
            codes = [[part] for part in (*encode_ranks(by_rank), *encode_ranks(ranks[values]))]
            row = [[shard], [number], [before], [ids], [lengths], [len(by_rank)], *codes]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)

        end, size = np.array([end_id], dtype="<u4"), 0
        for batch in batches:
            for run in groups(batch.column("text")):
                for doc_id, encoded in zip(batch.column("doc_id")[run].to_pylist(), encode(batch.column("text")[run])):
                    own = np.append(encoded, end)
                    ids.append(doc_id)
                    lengths.append(len(own))
                    found.append(own)
                    size += len(own)
                    if size >= block:
                        yield closed()
                        number, before, size, ids, lengths, found = number + 1, before + size, 0, [], [], []
        if ids:
            yield closed()

    rows = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(pack, BLOCKS).write.option("compression", "none").parquet(folder)


def read_documents(
    spark: SparkSession, folder: str, fields: T.StructType, of_ids: Callable[[np.ndarray], tuple]
) -> DataFrame:
    """Per document of a file set: ``doc_id``, ``start`` (ids before it), ``n_tokens``, and what ``of_ids`` makes of
    its ids as an array of unsigned 32-bit numbers.

    The starts of shards are broadcast: there is one row per task of the write.
    """
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("before"))
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), *fields.fields,
    ])

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                by_rank = decode_ranks(
                    batch.column("rank_control")[i].as_py(), batch.column("rank_data")[i].as_py(),
                    batch.column("n_ranks")[i].as_py(),
                )
                ranks = decode_ranks(batch.column("control")[i].as_py(), batch.column("data")[i].as_py(), int(ends[-1]))
                ids, starts = by_rank[ranks], ends - lengths
                made = [of_ids(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [batch.column("doc_ids")[i].values, pa.array(batch.column("start")[i].as_py() + starts), pa.array(lengths)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(v) for v in zip(*made)], names=schema.names)

    return placed.drop("shard", "block", "before").mapInArrow(unpack, schema)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a file set with their ``ids``."""
    fields = T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))])
    return read_documents(spark, folder, fields, lambda ids: (ids.astype(np.int64).tolist(),))


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a file set with ``ids_crc32``, the checksum of their ids as little-endian 32-bit numbers."""
    fields = T.StructType([T.StructField("ids_crc32", T.LongType())])
    return read_documents(spark, folder, fields, lambda ids: (zlib.crc32(ids.tobytes()),))
