"""Benchmark decontamination: windows of a document, as long as a benchmark item, that are nearly that item.

A window and an item are compared by their shingles of five words, each weighted by how often it occurs: the sum of
the lesser weights over the sum of the greater is at least 0.8. The search has three steps, all of them DataFrame
functions:

1. Windows worth a fingerprint. A window of m shingles that is similar to an item of m shingles shares at least 0.8 m
   with it, and starting it at its first shared shingle instead loses none of them. So only windows that start at a
   shingle of some item of that size, with 0.8 m such shingles ahead, are formed. No similar window is lost by that.
2. SimHash of windows and items (majority of the shingles' XXH64). Fingerprints within ``MAX_BITS`` bits agree on at
   least one of ``MAX_BITS`` + 1 blocks (multi-index), whose values, with the size, are joined; the distance is checked.
3. The exact weighted similarity of the pairs that remain.

Similarity 0.8 makes some 10 of 64 bits differ, with a standard deviation of 3; 16 bits leave about one in 70 such
windows out, and fewer at higher similarity, and a passage usually has several.

Equal windows are searched once. The benchmark is a query set: its shingles are broadcast if they are few (counted),
else exchanged.

Defined results: letters count as lower case; null, empty and shorter texts have no window, items of fewer than five
words no shingle, so neither is found; a window may end with the document, being shorter; repeated rows and documents
that share an id are told apart by their text, rows repeated in full give one result; extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroband.llm.texts import col, words_of
from aeroband.session import written_once

SHINGLE_WORDS = 5
MAX_BITS = 16
PER_CENT = 80  # least similarity
BROADCAST_SHINGLES = 1_000_000  # some 50 MB


def _fives(words: Column) -> Column:
    several = F.sequence(F.lit(0), F.size(words) - SHINGLE_WORDS)
    each = F.transform(several, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(F.size(words) >= SHINGLE_WORDS, each).otherwise(F.array().cast("array<bigint>"))


def shingle_hashes(text: Column) -> Column:
    """XXH64 of each word's XXH64, five at a time, in order.

    The word hashes are bound by a lambda: written as a column, Catalyst may compute them anew for every shingle.
    """
    hashes = F.transform(words_of(text), lambda word: F.xxhash64(word))
    return F.element_at(F.transform(F.array(hashes), _fives), 1)


def simhash(shingles: Column) -> Column:
    """Bit i is set if it is set in over half of the hashes."""
    def bit(i):
        votes = F.aggregate(
            shingles, F.lit(0).cast("long"),
            lambda n, h: n + F.call_function("shiftright", h, i).bitwiseAND(F.lit(1).cast("long")),
        )
        value = F.call_function("shiftleft", F.lit(1).cast("long"), i)
        return F.when(2 * votes > F.size(shingles), value).otherwise(F.lit(0).cast("long"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda all_bits, b: all_bits.bitwiseOR(b))


def block_keys(fp: Column, max_bits: int = MAX_BITS) -> Column:
    """Number and value of each of ``max_bits`` + 1 blocks of a fingerprint, packed into one number each."""
    edges = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    return F.array(*[
        (F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) * 64 + F.lit(i)).cast("long")
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ])


def shared_shingles(a: Column, b: Column) -> Column:
    """The sum over distinct shingles of the lesser of their two counts."""
    def count(array, x):
        return F.size(F.filter(array, lambda y: y == x))

    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    both = F.array_intersect(a, b)
    counted = F.aggregate(both, F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    return F.when(once, F.size(both)).otherwise(counted)


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``shingles``, their number ``m`` and fingerprint, for items of five words and more."""
    texts = benchmark.select(col("item_id").alias("item_id"), col("text").alias("text"))
    items = texts.select("item_id", shingle_hashes(F.col("text")).alias("shingles")).filter(F.size("shingles") > 0)
    return items.withColumn("m", F.size("shingles")).withColumn("fp", simhash(F.col("shingles")))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        col("doc_id").alias("doc_id"), F.xxhash64(col("doc_id"), col("text")).alias("doc"), col("text").alias("text")
    )


def window_starts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document with any: ``starts``, the (``m``, ``start``) of the windows worth a fingerprint."""
    known = items.select(F.explode("shingles").alias("shingle"), "m").distinct()
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    # Outer, as Catalyst would else compute the shingles twice, to drop documents without any first.
    each = docs.select("doc", F.posexplode_outer(shingle_hashes(F.col("text"))).alias("at", "shingle"))
    found = each.join(known, "shingle").groupBy("doc", "m").agg(F.array_sort(F.collect_set("at")).alias("places"))
    least = F.ceil(F.col("m") * PER_CENT / 100).cast("int")
    # places[j] starts a window if the place that many further on still lies in it.
    starts = F.filter("places", lambda place, j: F.get(F.col("places"), j + F.col("least") - 1) < place + F.col("m"))
    windows = found.withColumn("least", least).withColumn("good", starts).filter(F.size("good") > 0)
    each_size = windows.select(
        "doc", F.transform("good", lambda at: F.struct(F.col("m").alias("m"), at.alias("start"))).alias("good")
    )
    return each_size.groupBy("doc").agg(F.flatten(F.collect_list("good")).alias("starts"))


def contaminated(docs: DataFrame, benchmark: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """A row per document and item with a similar window: ``doc_id``, ``doc``, ``item_id``, the number of such windows,
    the first word of the first of them, and the greatest similarity."""
    items = written_once(items_of(benchmark))
    texts = keyed(docs)
    starts = written_once(window_starts(texts, items))
    # The only exchange of texts: to those documents with a window.
    met = texts.join(starts, "doc").withColumn("shingles", shingle_hashes(F.col("text")))
    spans = met.select("doc_id", "doc", "shingles", F.explode("starts").alias("w")).select(
        "doc_id", "doc", F.col("w.m").alias("m"), F.col("w.start").alias("start"),
        F.slice("shingles", F.col("w.start") + 1, F.col("w.m")).alias("shingles"),
    )
    windows = written_once(spans.withColumn("window", F.xxhash64("shingles", "m")))
    distinct = written_once(
        windows.groupBy("window", "m").agg(F.first("shingles").alias("shingles"))
        .withColumn("fp", simhash(F.col("shingles")))
    )
    keys = distinct.select("window", "m", "fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("key"))
    item_keys = items.select(
        "item_id", "m", F.col("fp").alias("item_fp"), F.explode(block_keys(F.col("fp"), max_bits)).alias("key")
    )
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= max_bits
    pairs = keys.join(item_keys, ["m", "key"]).filter(close).select("window", "m", "item_id").distinct()
    sides = pairs.join(distinct.select("window", "m", "shingles"), ["window", "m"]).join(
        items.select("item_id", "m", F.col("shingles").alias("item_shingles")), ["item_id", "m"]
    )
    shared = sides.withColumn("shared", shared_shingles(F.col("shingles"), F.col("item_shingles")))
    union = F.size("shingles") + F.col("m") - F.col("shared")
    alike = shared.filter(100 * F.col("shared") >= PER_CENT * union).select(
        "window", "m", "item_id", (F.col("shared") / union).alias("similarity")
    )
    return windows.select("doc_id", "doc", "start", "window", "m").join(alike, ["window", "m"]).groupBy(
        "doc_id", "doc", "item_id"
    ).agg(
        F.countDistinct("start").alias("n_windows"), F.min("start").alias("first_word"),
        F.max("similarity").alias("similarity"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a window similar to a benchmark item, with the columns they came with."""
    found = contaminated(docs, benchmark).select("doc").distinct()
    key = F.xxhash64(col("doc_id"), col("text"))
    return docs.join(found.withColumnRenamed("doc", "__contaminated"), key == F.col("__contaminated"), "left_anti")
