"""Line deduplication: lines within ``MOST_EDITS`` edits of an earlier line of the corpus are removed.

A segment-partition join (as in PASS-JOIN, Li et al. 2011). A line is cut into one segment more than the edits allowed,
so that of two lines within that distance one contains a segment of the other unchanged, at a place that differs by no
more than the edits before and after it allow. Each line lists its own segments (index) and, for each length that a
partner may have, the substrings that could be a segment of it (probes), as hashes with length and number. Both come
from one table of the distinct lines, in one exchange by key; keys that only one line has end there. Where lines meet,
their distance is verified by a bit-parallel automaton in a band around the diagonal.

Lines that meet at a key are compared in blocks of ``CROWD`` index lines and about ``PROBES`` probing lines. A block
gives no pairs but a row per line: how many links it has there, and one line that it is connected to. A pair that
shares several keys is counted at the first of them.

Segments that more than ``CROWD`` different lines of a length share (the start of a template, say) are left to a second
search: lines that have or probe one are cut into two segments more, of which any three in place must agree; that key
covers most of a line, so that it is rarely shared, and there is no limit to it.

Linked lines form classes (connected components). The first line of a class, in order of document id and place, stays.
Lines of fewer than ``LEAST_CHARS`` characters, outer white space apart, are only linked to lines equal to them: two
edits make other words of them. Blank lines are never removed.

Lines are told apart by a 64-bit hash; equal lines are one line in the search.

Defined results: null and empty texts have no line; a null id comes before others; rows repeated in full count as one
document, each having its row; an empty table gives an empty result; other columns are ignored.
"""

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroband.llm.components import connected_components
from aeroband.llm.texts import col
from aeroband.operators.joins import fits_broadcast, join_on_bucket
from aeroband.session import written_once

MOST_EDITS = 2
LEAST_CHARS = 20
CROWD = 100
PROBES = 5_000
MORE_SEGMENTS = 2
SPACE = " \t\n\x0b\x0c\r"
ROW = "key long, line long, place int"  # a key of a line; its number if it is the line's own, null if it probes


def segments(length: int, count: int) -> list[tuple[int, int]]:
    """Start and length of ``count`` segments that divide ``length`` evenly, the longer ones last."""
    short, longer = divmod(length, count)
    sizes = [short] * (count - longer) + [short + 1] * longer
    return [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]


def shifts(number: int, count: int, apart: int) -> range:
    """How far right of its place in the shorter line the segment may be in one ``apart`` characters longer.

    Of several segments that match, one has no more edits before it than segments before it, and likewise after it.
    """
    before, after = number, count - 1 - number
    return range(max(-before, apart - after), min(before, apart + after) + 1)


def placements(chosen: tuple[int, ...], apart: int, edits: int) -> list[tuple[int, ...]]:
    """The shifts of several segments that ``edits`` edits can bring about."""
    found = [((), 0, 0)]
    for _ in chosen:
        found = [
            (done + (to,), to, spent + abs(to - last)) for done, last, spent in found
            for to in range(last - edits, last + edits + 1) if spent + abs(to - last) <= edits
        ]
    return [done for done, last, spent in found if spent + abs(apart - last) <= edits]


@cache
def moves(edits: int, more: int, apart: int) -> list[tuple[tuple[int, ...], list[tuple[int, ...]]]]:
    """The segments of each key, in order, and the shifts that they may have in a line ``apart`` characters longer."""
    count = edits + 1 + more
    return [
        (chosen, placements(chosen, apart, edits) if more else [(d,) for d in shifts(chosen[0], count, apart)])
        for chosen in combinations(range(count), 1 + more)
    ]


def _key(parts: list[str], length: int, number: int) -> int:
    value = xxhash.xxh3_64_intdigest("\n".join(parts).encode(), seed=length << 8 | number)
    return value - (1 << 64) if value >> 63 else value


def keys_of(line: str, edits: int, more: int) -> dict[int, int | None]:
    """The keys of a line that are of several segments, with the number of those that are its own."""
    found: dict[int, int | None] = {}
    n = len(line)
    for length in range(max(n - edits, 0), n + 1):
        parts = segments(length, edits + 1 + more)
        for number, (chosen, moved) in enumerate(moves(edits, more, n - length)):
            for places in moved:
                starts = [parts[i][0] + d for i, d in zip(chosen, places)]
                if starts[0] >= 0 and starts[-1] + parts[chosen[-1]][1] <= n:
                    own = length == n and not any(places)
                    key = _key([line[a:a + parts[i][1]] for a, i in zip(starts, chosen)], length, number)
                    found[key] = number if own else found.get(key)
    return found


def single_keys(lines: DataFrame, edits: int) -> DataFrame:
    """The same of single segments: ``key``, ``line`` and ``place`` of a table of lines; a probe may come twice.

    Each line is first copied to a row for each of its keys, so that there is one expression for all of them: an array
    of all keys makes a method too long for the JVM to compile. A probe that runs over the end of a very short line is
    cut there; such lines meet in vain.
    """
    asked = [
        F.struct(F.lit(apart).alias("apart"), F.lit(number).alias("number"), F.lit(shift).alias("shift"))
        for apart in range(edits + 1) for number, (_, moved) in enumerate(moves(edits, 0, apart)) for (shift,) in moved
    ]
    each = lines.select("line", "text", F.char_length("text").alias("n"), F.explode(F.array(*asked)).alias("k")).select(
        "line", "text", (F.col("n") - F.col("k.apart")).alias("length"), "k.*"
    )
    count, number = edits + 1, F.col("number")
    short, longer = F.expr(f"cast(length div {count} as int)"), F.col("length") % count
    start = short * number + F.greatest(longer - (count - number), F.lit(0)) + F.col("shift")
    size = short + (longer >= count - number).cast("int")
    return each.select(
        F.xxhash64(F.substring("text", start + 1, size), "length", "number").alias("key"), "line",
        F.when((F.col("apart") == 0) & (F.col("shift") == 0), number).alias("place"),
    )


def first_shared(a: str, b: str, edits: int, more: int, without: int = 0) -> int | None:
    """The number of the first key of ``a`` that the longer ``b`` probes, but for those whose bits ``without`` has."""
    parts = segments(len(a), edits + 1 + more)
    for number, (chosen, moved) in enumerate(moves(edits, more, len(b) - len(a))):
        if not without >> number & 1:
            own = [a[parts[i][0]:sum(parts[i])] for i in chosen]
            if any(all(parts[i][0] + d >= 0 and b.startswith(x, parts[i][0] + d) for x, i, d in zip(own, chosen, places))
                   for places in moved):
                return number
    return None


def common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def within(a: str, b: str, most: int) -> int:
    """The edit distance of two strings, or ``most`` + 1 if it is greater.

    Bit j of row e says that e edits make the first i - ``most`` + j characters of ``a`` out of the first i of ``b``.
    The bits move along the diagonal, so that a step costs the same however long the strings are; ``seen`` holds, for
    each character, the bits of its places in the band and the step of which they are.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    start = common_prefix(a, b)
    a, b = a[start:], b[start:]
    end = common_prefix(a[::-1], b[::-1])
    a, b = a[:len(a) - end], b[:len(b) - end]
    seen: dict[str, tuple[int, int]] = {}
    band = (1 << 2 * most + 1) - 1

    def places(c, i):
        bits, of = seen.get(c, (0, i))
        return bits >> i - of

    for p, c in enumerate(a[:most]):
        seen[c] = places(c, 0) | 1 << p + most, 0
    rows = [(1 << e + 1) - 1 << most for e in range(most + 1)]
    for i, c in enumerate(b):
        if i + most < len(a):
            seen[a[i + most]] = places(a[i + most], i) | 1 << 2 * most, i
        fits, last_old, last_new = places(c, i), 0, 0
        for e, row in enumerate(rows):
            new = (row & fits | last_old | last_old >> 1 | last_new << 1) & band
            rows[e], last_old, last_new = new, row, new
        if not rows[-1]:
            return most + 1
    return next((e for e, row in enumerate(rows) if row >> len(a) - len(b) + most & 1), most + 1)


def line_hash(line: str) -> int:
    """The number of a line, as Spark's ``xxhash64`` gives it."""
    value = xxhash.xxh64_intdigest(line.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``doc``, ``number`` and ``text`` (without outer white space) of every line that is not blank."""
    each = docs.select("doc_id", "doc", F.posexplode(F.split("text", "\n")).alias("number", "text"))
    return each.withColumn("text", F.btrim("text", F.lit(SPACE))).filter("text <> ''")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``line`` and ``text`` of the different lines that are long enough for edits."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("text")).select(F.btrim("text", F.lit(SPACE)).alias("text"))
    return lines.filter(F.char_length("text") >= LEAST_CHARS).distinct().select(F.xxhash64("text").alias("line"), "text")


def _met(keys: DataFrame) -> DataFrame:
    """The keys that one line has and another has or probes, each line once, with ``n_own``, the lines that have it."""
    of_key = Window.partitionBy("key")
    counted = keys.withColumns({
        "n_own": F.count("place").over(of_key), "least": F.min("line").over(of_key), "most": F.max("line").over(of_key),
    })
    return counted.filter("n_own > 0 and least <> most").groupBy("key", "line", "n_own").agg(F.max("place").alias("place"))


def _compared(met: DataFrame, lines: DataFrame, edits: int, crowd: int, more: int, as_pairs: bool) -> DataFrame:
    """Links of the lines that meet at the keys of ``met`` (with ``crowded``, the bits of a line's crowded keys)."""
    sizes = met.groupBy("key").agg(F.ceil(F.count("place") / crowd).alias("blocks"), F.ceil(F.count("*") / PROBES).alias("parts"))
    rows = met.join(sizes, "key").join(lines, "line")

    def dealt(some, own, ours, theirs):
        n, other = ("blocks", "parts") if own else ("parts", "blocks")
        return some.withColumn(ours, F.pmod(F.xxhash64("line"), F.col(n))).withColumn(
            theirs, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        ).select("key", "block", "part", F.lit(own).alias("own"), "line", "place", "crowded", "text")

    both = dealt(rows.filter("place is not null"), True, "block", "part").union(dealt(rows, False, "part", "block"))
    tasks = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated: comparing costs more than the bytes tell
    group = ["key", "block", "part"]
    ordered = both.repartition(tasks, *group).sortWithinPartitions(*group, F.desc("own"))
    names = ["u", "v", "edits"] if as_pairs else ["line", "links", "other"]

    def counts(a, b, place, crowded):
        if more:
            return first_shared(a, b, edits, 0, crowded) is None and first_shared(a, b, edits, more) == place
        return first_shared(a, b, edits, 0, crowded) == place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(out):
            types = [pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)], names=names)

        def owners():
            return [(line, n, owned[root[i]][0]) for i, (line, *_), n in zip(range(len(owned)), owned, met_by) if n]

        at, owned, root, met_by, out = None, [], [], [], []
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for *key, own, line, place, crowded, text in zip(*columns.values()):
                if key != at:
                    if not as_pairs:
                        out += owners()
                    at, owned, root, met_by = key, [], [], []
                if own:
                    root.append(len(owned))
                    owned.append((line, text, place, crowded))
                    met_by.append(0)
                    continue
                linked = []
                for i, (other, a, number, mask) in enumerate(owned):
                    if len(a) < len(text) or len(a) == len(text) and other < line:
                        apart = within(a, text, edits)
                        if apart <= edits and counts(a, text, number, mask):
                            linked.append(i)
                            if as_pairs:
                                out.append((min(other, line), max(other, line), apart))
                if linked and not as_pairs:
                    out.append((line, len(linked), owned[linked[0]][0]))
                    joined = {root[i] for i in linked}
                    for i in linked:
                        met_by[i] += 1
                    if len(joined) > 1:
                        root = [min(joined) if r in joined else r for r in root]
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if not as_pairs:
            out += owners()
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _texts_of(met: DataFrame, lines: DataFrame) -> DataFrame:
    """``lines`` without those that met none, before their texts are shuffled, if the numbers of the others are few."""
    numbers = met.select("line").distinct()
    return lines.join(F.broadcast(numbers), "line", "left_semi") if fits_broadcast(numbers) else lines


def _linked(docs: DataFrame, edits: int, crowd: int, as_pairs: bool) -> DataFrame:
    lines = written_once(distinct_lines(docs), compression="zstd")  # as large as the corpus
    met = written_once(_met(single_keys(lines, edits)))
    lines = _texts_of(met, lines)
    full = met.filter(F.col("n_own") > crowd)
    none = F.lit(0).cast("long").alias("crowded")
    few = met.filter(F.col("n_own") <= crowd)
    if not full.limit(1).count():
        return _compared(few.select("*", none), lines, edits, crowd, 0, as_pairs)
    bits = F.when(F.col("place").isNotNull(), F.expr("shiftleft(1L, place)")).otherwise(F.lit(0).cast("long"))
    members = written_once(full.groupBy("line").agg(F.bit_or(bits).alias("crowded")))

    def marked(some):
        return some.join(members, "line", "left").withColumn("crowded", F.coalesce("crowded", none))

    def keys(batches):
        for batch in batches:
            rows = [
                (key, line, place) for line, text in zip(batch.column("line").to_pylist(), batch.column("text").to_pylist())
                for key, place in keys_of(text, edits, MORE_SEGMENTS).items()
            ]
            types = [pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows) if rows else [()] * 3, types)], names=["key", "line", "place"]
            )

    again = written_once(_met(lines.join(members, "line", "left_semi").select("line", "text").mapInArrow(keys, ROW)))
    return _compared(marked(few), lines, edits, crowd, 0, as_pairs).union(
        _compared(marked(again), lines, edits, crowd, MORE_SEGMENTS, as_pairs)
    )


def linked_lines(docs: DataFrame, edits: int = MOST_EDITS, crowd: int = CROWD) -> DataFrame:
    """``u``, ``v`` (hashes of different lines, ``u`` < ``v``) and ``edits``, their distance, of all lines within it.

    ``docs`` has ``text``.
    """
    return _linked(docs, edits, crowd, True)


def marked_lines(docs: DataFrame, edits: int = MOST_EDITS, crowd: int = CROWD) -> DataFrame:
    """The rows of ``repeated_lines`` with ``doc``, the number that tells documents apart that share an id."""
    rows = docs.select(
        col("doc_id").cast("long").alias("doc_id"), F.xxhash64(col("doc_id"), col("text")).alias("doc"),
        col("text").alias("text"),
    )
    links = written_once(_linked(rows, edits, crowd, False))
    edges = links.select(F.col("line").alias("u"), F.col("other").alias("v"))
    roots = connected_components(edges).select(F.col("node").alias("line"), F.col("root").alias("class"))
    degrees = links.groupBy("line").agg(F.sum("links").alias("links"))
    found = written_once(occurrences(rows).select("doc_id", "doc", "number", F.xxhash64("text").alias("line")))
    classes = degrees.join(roots, "line", "left")  # the least line of a class has no root but itself
    placed = written_once(join_on_bucket(found, classes, ["line"]).withColumn("class", F.coalesce("class", "line")))
    place = F.struct("doc_id", "doc", "number")
    first = placed.groupBy("class").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    each = join_on_bucket(placed, first, ["class"]).withColumn(
        "removed", F.when(F.coalesce(place != F.col("first"), F.lit(False)), F.col("number"))
    )
    per_doc = each.groupBy("doc").agg(
        F.collect_set("number").alias("numbers"), F.array_sort(F.collect_set("removed")).alias("removed"),
        F.sum("links").alias("all_links"), F.count("*").alias("n"),
    )
    n_lines, copies = F.coalesce(F.size("numbers"), F.lit(0)), F.col("n") / F.size("numbers")  # of rows repeated in full
    return rows.select("doc_id", "doc").join(per_doc, "doc", "left").select(
        "doc_id", "doc", n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce(F.col("all_links") / copies, F.lit(0)).cast("long").alias("n_links"),
    )


def repeated_lines(docs: DataFrame, edits: int = MOST_EDITS, crowd: int = CROWD) -> DataFrame:
    """A row per document: ``doc_id``, ``n_lines`` (not blank), ``n_removed``, ``removed`` (their numbers, from 0),
    and ``n_links``, the lines within the distance of its lines."""
    return marked_lines(docs, edits, crowd).drop("doc")


def without_repeated_lines(docs: DataFrame, edits: int = MOST_EDITS) -> DataFrame:
    """``doc_id`` and ``text`` without the lines that are removed."""
    removed = marked_lines(docs, edits).select("doc", "removed").dropDuplicates(["doc"])  # rows repeated in full share it
    lines = F.split(F.col("text"), "\n")
    rest = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("removed", i)), "\n")
    rows = docs.select(
        col("doc_id").cast("long").alias("doc_id"), F.xxhash64(col("doc_id"), col("text")).alias("doc"),
        col("text").alias("text"),
    )
    return rows.join(removed, "doc").select("doc_id", rest.alias("text"))
