"""Shards by jump consistent hashing (Lamping and Veach 2014).

A stable key and the number of shards alone decide the shard; there is no ring or table of shards. The key is hashed to
64 bits (the first half of its MD5), which seed a linear congruential sequence. Each of its values says how many shards
there must be before the key moves next, and the shard is the last such number below the number of shards. So a shard
that is appended takes a fair fraction of the keys of all others, and no key moves between those.

Columns hold the 64-bit numbers of the sequence as two halves, as products of whole ones overflow. Everything is column
arithmetic without a shuffle, but for ``slot``: rows are ordered by key over tasks of equal size, and counts per task
and shard say where each task begins.

Defined results: a null key is hashed like an empty one; a null text has no bytes, so size 8 and checksum 0; rows of one
key share a shard, and equal rows have slots in any order; an empty table gives an empty result; other columns are
carried along or ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroband.llm.texts import col, packed, unpacked
from aeroband.session import written_once

SHARDS = 24
LAW = "key"
# The sequence's factor and summand.
FACTOR, SUMMAND = 2862933555777941757, 1
STEPS = 40
HALF, ROW_BYTES = (1 << 32) - 1, 8


def _low_product(x: Column, factor: int) -> Column:
    """``x`` times ``factor``, both below 2^32, as a sum whose lowest 32 bits are the product's."""
    upper = F.shiftleft((x * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return x * F.lit(factor & 0xFFFF) + upper


def affine(high: Column, low: Column) -> tuple[Column, Column]:
    """The halves of FACTOR * (high, low) + SUMMAND, modulo 2^64; no part of it exceeds 2^63."""
    middle = low * F.lit((FACTOR & HALF) >> 16)
    below = low * F.lit(FACTOR & 0xFFFF) + F.lit(SUMMAND) + F.shiftleft(middle.bitwiseAND(F.lit(0xFFFF)), 16)
    above = F.shiftright(below, 32) + F.shiftright(middle, 16)
    above = above + _low_product(low, FACTOR >> 32) + _low_product(high, FACTOR & HALF)
    return above.bitwiseAND(F.lit(HALF)), below.bitwiseAND(F.lit(HALF))


def _step(state: Column, numbers: list[int]) -> Column:
    """The state after one value of the sequence; ``next`` is the number of shards before the key moves next, and
    ``at``, for each number of shards, the last such number below it."""
    high, low = affine(state["high"], state["low"])
    scale = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
    after = F.floor((state["next"] + 1).cast("double") * scale)
    here = [F.when(state["next"] < n, state["next"]).otherwise(state[f"at{n}"]).alias(f"at{n}") for n in numbers]
    moved = F.struct(high.alias("high"), low.alias("low"), after.alias("next"), *here)
    return F.when(state["next"] < max(numbers), moved).otherwise(state)


def with_shards(df: DataFrame, key: Column, shards: dict[str, int]) -> DataFrame:
    """``df`` with a column for each entry of ``shards``: the shard of ``key`` among that many.

    One sequence serves all numbers of shards. A key needs some log(shards) steps and at most as many as there are
    shards: the steps beyond ``STEPS`` are only taken for keys that are not through by then. The sequence is a fold,
    so a filter that Spark moves below it holds each step once; columns nested in one another would triple with each.
    The working column is named ``_jump``.
    """
    numbers = sorted(set(shards.values()))
    digits = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    high, low = (F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9))
    zero, most = F.lit(0).cast("long"), numbers[-1]
    start = F.struct(high.alias("high"), low.alias("low"), zero.alias("next"), *[zero.alias(f"at{n}") for n in numbers])

    def folded(state, first, last):
        return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, lambda state, _: _step(state, numbers))

    through = folded(start, 1, min(most, STEPS))
    if most > STEPS:
        late = F.transform(F.array(through), lambda s: F.when(s["next"] < most, folded(s, STEPS + 1, most)).otherwise(s))
        through = late[0]
    df = df.withColumn("_jump", through)
    return df.withColumns({name: F.col("_jump")[f"at{n}"].cast("int") for name, n in shards.items()}).drop("_jump")


def with_slots(rows: DataFrame, order: list[str], shard: str = "shard") -> DataFrame:
    """``rows`` with ``slot``, their place in the shard by ``order``, from 0 without gaps.

    Rows are dealt by ranges of the order, rows alike in all of it by their place in the input, so neither a shard nor
    a key has to fit in a task. Windows are over a task's rows of a shard, and over a row per task for each shard.
    """
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*order, "_place").withColumn("_part", F.spark_partition_id())
    dealt = written_once(dealt)
    counts = dealt.groupBy("_part", shard).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", shard, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part", shard).orderBy(*order, "_place")) - 1
    return dealt.join(starts, ["_part", shard]).withColumn("slot", F.col("_start") + inside).drop(
        "_place", "_part", "_start"
    )


def placed(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id`` (the key), ``size`` in bytes, ``text_crc32``, ``law``, ``shard``, ``slot``, and
    ``grown_shard``, its shard if one more is appended."""
    rows = docs.select(
        col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(col("text")), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = with_shards(rows, F.col("doc_id"), {"shard": shards, "grown_shard": shards + 1})
    return with_slots(dealt, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """The documents, columns as they came, as Parquet in ``folder/shard=<n>``. Each shard's rows are brought together;
    a shard too large for one file becomes several."""
    rows = with_shards(docs.select(packed(docs).alias("row")), F.col("row").getField(key), {"shard": shards})
    spread = rows.hint("rebalance", "shard")
    spread.write.partitionBy("shard").parquet(folder)


def read_shard(docs: DataFrame, like: DataFrame) -> DataFrame:
    """What ``write_shards`` wrote, read from the folder or some of its shards, with the columns of ``like``."""
    return unpacked(docs, "row", like)


def moved(docs: DataFrame, before: int, after: int, key: str = "doc_id") -> DataFrame:
    """The documents that change shards when ``before`` shards become ``after``, with ``shard`` and ``grown_shard``:
    all that has to be written again; columns are in the struct ``row``."""
    rows = docs.select(packed(docs).alias("row"))
    both = with_shards(rows, F.col("row").getField(key), {"shard": before, "grown_shard": after})
    return both.filter("shard <> grown_shard")
