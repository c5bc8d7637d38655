"""Mixing sources to target weights, by blocks of a fixed number of tokens (here: words).

The documents of a source are laid end to end in a pseudorandom order and the line is cut into blocks of ``block``
words. The mix is a sequence of slots of one block each, ``shard`` slots to an output shard. All slots of all sources
together, as many per source as its target needs, pass through one keyed permutation of the slot numbers, so that each
shard gets a random number of slots of each source: multinomial counts, conditioned on the totals of the mix, without
whose condition a source would miss its target by the square root of its slots. The slots of a source map to its
blocks through permutations of its own, one per pass over the source, and slots and blocks meet by index.

A permutation is a swap-or-not network (Hoang, Morris, Rogaway 2012) in column arithmetic: a bijection of [0, n) for
any n, computed for each index by itself. Everything is DataFrame functions; nothing is drawn at run time, so a rerun
gives the same mix.

Defined results: null and empty texts have no words and are never taken; a null source is a source, the last one; rows
repeated in full are rows of their own, and of documents with equal id and words it does not matter which is which;
without words all targets are zero; other columns are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroband.llm.texts import WORD, col, packed, row_hash, word_count
from aeroband.session import written_once

BLOCK_WORDS = 32
SHARD_SLOTS = 1024
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 20240131
ROUNDS = 12
PARTS = 4096  # of a source, for offsets: a part is laid out in one task
CHUNK = 1024  # slots made from one row
SOURCE = ["no_source", "name"]
SPACE, SPACES = r"[\x20\x09-\x0D]", " \t\n\x0b\x0c\r"


def permuted(df: DataFrame, into: str, index: Column, size: Column, key: Column, seed: int) -> DataFrame:
    """Adds ``into``, the place of ``index`` in a pseudorandom permutation of [0, ``size``), one for each ``key``.

    In each round an index and its mirror image, at a distance the round's key fixes, swap places or do not. Each step
    is a column of its own: nested in one another they would double with each round, and a fold over the rounds is
    not compiled but interpreted.
    """
    df, place, mirror = df.withColumn(into, index), F.col(into), F.col("mirror")
    for r in range(ROUNDS):
        turn = F.pmod(F.xxhash64(F.lit(seed), F.lit(r), key), size)
        swap = F.xxhash64(F.lit(seed + 1), F.lit(r), F.greatest(mirror, place), key).bitwiseAND(F.lit(1)) == 1
        df = df.withColumn("turned", turn)
        back = F.col("turned") - place
        df = df.withColumn("mirror", F.when(back < 0, back + size).otherwise(back)).drop("turned")
        df = df.withColumn(into, F.when(swap, mirror).otherwise(place))
    return df.drop("mirror")


def sized(docs: DataFrame) -> DataFrame:
    """A narrow table of the documents: id, source, words, and the number that fixes their order."""
    return written_once(docs.select(
        col("doc_id").alias("doc_id"),
        col("source").isNull().alias("no_source"),
        F.coalesce(col("source").cast("string"), F.lit("")).alias("name"),
        word_count(col("text")).alias("size"),
        row_hash(docs).alias("row"),
    ))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source its size and target: shares by weight, stopped at ``most`` times the size, the rest shared again.

    The sources that stop are those with the least size for their weight; the last share is what remains after them.
    One row per source, so the windows over all sources are small however many documents there are.
    """
    sources = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(*SOURCE))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("long"))
    exact = "decimal(38,0)"
    before = Window.orderBy(F.col("source_size") / F.col("weight"), *SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    stops = (
        ranked.withColumn("cap", (most * F.col("source_size")).cast(exact))
        .withColumn("total", F.sum("source_size").over(everything).cast(exact))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(exact))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stopped", F.expr(
            f"cap * cast(all_weight - weight_before as {exact}) <= cast(weight as {exact}) * (total - cap_before)"
        ))
    )
    left = F.col("total") - F.sum(F.when(F.col("stopped"), F.col("cap")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(~F.col("stopped"), F.col("weight")).otherwise(0)).over(everything)
    share = left.cast("double") / F.nullif(open_weight.cast("double"), F.lit(0.0))
    target = F.when(F.col("stopped"), F.col("cap").cast("double")).otherwise(share * F.col("weight"))
    return stops.withColumn("target", target).select(*SOURCE, "source_size", "target")


def slot_counts(targets: DataFrame, block: int) -> DataFrame:
    """Adds, for sources with words: blocks, slots, the place of its first slot, and the number of all slots.

    Whole passes over a source take every block; the last pass takes the number of blocks nearest to what is left.
    """
    passes = F.floor(F.col("target") / F.col("source_size"))
    left = F.col("target") - F.col("passes") * F.col("source_size")
    last = F.round(left * F.col("blocks") / F.col("source_size")).cast("long")
    upto = Window.orderBy(*SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        targets.filter("source_size > 0")
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("passes", passes)
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.least(last, F.col("blocks")))
        .withColumn("first_slot", F.coalesce(F.sum("slots").over(upto), F.lit(0)).cast("long"))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
    )


def slots(counts: DataFrame, seed: int = SEED) -> DataFrame:
    """Source and ``block`` of every slot of the mix, its place ``at`` in the order of sources, and ``all_slots``.

    The chunks are few small rows that each become ``CHUNK`` slots. Spark would gather them in one task by their size
    before that, so their number of partitions is stated. The slots are written: filters that a join puts on ``block``
    would be moved below the rounds of the permutation otherwise, and double in size with each.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = counts.filter("slots > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK}")))
    ).repartition(tasks, *SOURCE, "chunk")
    numbered = chunks.withColumn("n", F.explode(F.sequence(
        F.col("chunk") * CHUNK, F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK) - 1
    )))
    turned = numbered.select(
        *SOURCE, F.coalesce("blocks", F.lit(1)).alias("blocks"), "all_slots", (F.col("first_slot") + F.col("n")).alias("at"),
        F.coalesce(F.col("n") % F.col("blocks"), F.lit(0)).alias("turn"),
        F.xxhash64(*SOURCE, F.expr("n div blocks")).alias("pass"),
    )
    placed = permuted(turned, "block", F.col("turn"), F.col("blocks"), F.col("pass"), seed + 2)
    return written_once(placed.select(*SOURCE, "block", "at", "all_slots"))


def sharded(slots: DataFrame, shard: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The slots with ``slot``, their place in the mix, and its output ``shard``."""
    known = slots.withColumns({name: F.coalesce(name, F.lit(1).cast("long")) for name in ("at", "all_slots")})
    placed = permuted(known, "slot", F.col("at"), F.col("all_slots"), F.lit(0), seed)
    return placed.withColumn("shard", F.expr(f"slot div {shard}"))


def laid_out(sizes: DataFrame) -> DataFrame:
    """The place of every document with words on the line of its source: ``begin`` and ``end``, in words.

    Offsets are those of the document's part of the source (one row per part) plus those within the part, so a source
    that holds most documents is spread over all its parts.
    """
    parts = sizes.filter("size > 0").withColumn("part", F.pmod("row", F.lit(PARTS)))
    totals = parts.groupBy(*SOURCE, "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy(*SOURCE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*SOURCE, "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy(*SOURCE, "part").orderBy("row", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        parts.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, [*SOURCE, "part"])
        .withColumn("begin", F.col("start") + F.col("inside"))
        .select("doc_id", "row", *SOURCE, "size", "begin", (F.col("begin") + F.col("size")).alias("end"))
    )


def blocks_of(line: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``block``, ``from`` and ``to`` of every piece of a document that lies in one block."""
    return line.withColumn(
        "block", F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}")))
    ).withColumns({
        "from": F.greatest(F.col("begin"), F.col("block") * block),
        "to": F.least(F.col("end"), (F.col("block") + 1) * block),
    })


class Mix:
    """The mix of a table of documents; its tables are plans over one narrow copy of the documents and the slots."""

    def __init__(self, docs: DataFrame, block: int = BLOCK_WORDS, shard: int = SHARD_SLOTS, seed: int = SEED):
        self.sizes = sized(docs)
        self.targets = source_targets(self.sizes)
        self.line = laid_out(self.sizes)
        self.block, self.shard, self.seed = block, shard, seed
        self.counts = slot_counts(self.targets, block)
        self.slots = slots(self.counts, seed)

    def pieces(self) -> DataFrame:
        """The mix: ``shard``, ``slot``, and the piece of a document there: ``doc_id``, first word, number of words."""
        # Both sides grow with the corpus, so neither is broadcast, whatever the size of the files.
        return sharded(self.slots, self.shard, self.seed).hint("merge").join(blocks_of(self.line, self.block), [*SOURCE, "block"]).select(
            "shard", "slot", "doc_id", (F.col("from") - F.col("begin")).alias("first_word"),
            (F.col("to") - F.col("from")).alias("n_words"), *SOURCE, "begin",
        )

    def taken(self) -> DataFrame:
        """Per document: ``doc_id``, ``size``, ``source_size``, ``target`` of its source, and ``taken`` words."""
        words = self.pieces().groupBy(*SOURCE, "begin").agg(F.sum("n_words").alias("taken"))
        placed = self.line.join(words, [*SOURCE, "begin"], "left").select("doc_id", *SOURCE, "size", "taken")
        empty = self.sizes.filter("size = 0").select("doc_id", *SOURCE, "size", F.lit(None).cast("long").alias("taken"))
        return placed.union(empty).join(self.targets, SOURCE).select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )

    def copies(self) -> DataFrame:
        """Per document with words in the mix: ``row``, ``size``, ``whole`` (how often all of it enters), and ``runs``.

        Whole passes over a source take all of each document. The last pass takes the blocks that are used once more
        than that; ``runs`` are the words (``first``, ``last``) of the document that lie in such blocks, adjacent ones
        as one run. Together these are the words that ``taken`` counts.
        """
        passes = self.counts.select(*SOURCE, F.col("passes").cast("long").alias("whole"))
        uses = self.slots.groupBy(*SOURCE, "block").agg(F.count("*").alias("uses"))
        extra = uses.join(passes, SOURCE).filter("uses > whole").select(*SOURCE, "block")
        pieces = extra.hint("merge").join(blocks_of(self.line, self.block), [*SOURCE, "block"])
        edges = pieces.groupBy(*SOURCE, "begin").agg(
            F.collect_list(F.col("from") - F.col("begin")).alias("froms"),
            F.collect_list(F.col("to") - F.col("begin")).alias("tos"),
        )
        first, last = F.array_except("froms", "tos"), F.array_except("tos", "froms")
        runs = edges.select(
            *SOURCE, "begin", F.arrays_zip(F.array_sort(first).alias("first"), F.array_sort(last).alias("last")).alias("runs")
        )
        return (
            self.line.join(passes, SOURCE).join(runs, [*SOURCE, "begin"], "left")
            .filter((F.col("whole") > 0) | F.col("runs").isNotNull()).select("row", "size", "whole", "runs")
        )


def cut_to(text: Column, runs: Column) -> Column:
    """The text of each run of words, from its first word to its last, as it stands; the words are found once."""
    words = F.regexp_extract_all(text, F.lit(f"{WORD}{SPACE}*"), 0)
    found = F.transform(F.array(words), lambda w: F.transform(runs, lambda r: F.rtrim(
        F.array_join(F.slice(w, (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int")), ""), F.lit(SPACES)
    )))
    return found[0]


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as rows with the columns they came with: the words that ``Mix.taken`` counts, of each document.

    A document enters whole as often as the mix passes over all of its source, and with the words of the blocks that
    the last pass draws: a row for each run of adjacent blocks, its text cut there and ``n_chars`` that of the cut text;
    a document all of whose blocks are drawn stays as it is.
    """
    copies = Mix(docs, block, seed=seed).copies()
    texts = docs.select(row_hash(docs).alias("row"), packed(docs).alias("packed")).dropDuplicates(["row"])
    words = F.element_at("runs", 1)["last"] - F.element_at("runs", 1)["first"]
    all_drawn = F.coalesce((F.size("runs") == 1) & (words == F.col("size")), F.lit(False))
    split = copies.select(
        "row", (F.col("whole") + all_drawn.cast("long")).cast("int").alias("whole"),
        F.when(~all_drawn, F.col("runs")).alias("runs"),
    )
    text = F.col("packed").getField("text")
    whole = F.array_repeat(F.struct(F.lit(False).alias("is_cut"), text.alias("text")), F.col("whole"))
    cut = F.transform(cut_to(text, F.col("runs")), lambda t: F.struct(F.lit(True).alias("is_cut"), t.alias("text")))
    parts = F.when(F.col("runs").isNull(), whole).otherwise(F.concat(whole, cut))
    each = texts.join(split, "row").select("packed", F.explode(parts).alias("part"))
    kinds = dict(docs.dtypes)
    made = {"text": F.col("part.text"), "n_chars": F.char_length("part.text")}
    kept = {name: F.col("packed").getField(name) for name in docs.columns}
    return each.select([
        (F.when(F.col("part.is_cut"), made[name].cast(kinds[name])).otherwise(field) if name in made else field).alias(name)
        for name, field in kept.items()
    ])
