"""Quality rules as a ledger: every rule is evaluated once per document and stored as a bit beside its measurements.

Policies are named masks over those bits, so that a new version of a policy, or the effect of leaving a rule out, is
read off the stored bits and never needs the texts again.

Defined results: null and empty texts have no words and fail the rule on few words; repeated rows and ties are judged
row by row; an empty table gives an empty ledger; other columns are carried along or left out, whatever their names.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.llm.texts import add_columns, col, packed, unpacked

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: str  # SQL over the measurements


# The bit of a rule never changes; a changed rule takes a new bit.
RULES = [
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("short_words", 2, "word_chars < 3 * n_words"),
    Rule("long_words", 3, "word_chars > 10 * n_words"),
    Rule("symbols", 4, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 5, "2 * n_dup_lines > n_lines"),
]
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": ["few_words", "repeated_words", "short_words", "long_words", "symbols", "repeated_lines"],
}
BASE, CURRENT = "base-1", "web-1"


def mask(policy: str, without: str | None = None) -> int:
    return sum(1 << rule.bit for rule in RULES if rule.name in POLICIES[policy] and rule.name != without)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words (a power of two) found at two places or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), dtype=np.int64, count=len(words))
    span = 1
    while span < window:  # the number of a window of twice the length is that of the pair of its halves
        pairs = codes[:-span] * len(words) + codes[span:]
        distinct, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(distinct) == len(pairs):
            return 0
        span *= 2
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(counts[codes] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def measure(data: bytes) -> tuple:
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        # Continuation bytes are not characters of their own.
        sum(len(word) for word in words) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)),
        sum(data.count(symbol) for symbol in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ledger(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The columns ``carried``, as struct ``row``, the measurements, and ``failures`` with the bit of each failed rule."""
    rows = docs.select(F.struct(*[col(name) for name in carried]).alias("row"), col("text").alias("text"))
    fields = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
    failures = sum((F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0) for rule in RULES), F.lit(0))
    return add_columns(rows, "text", fields, measure).withColumn("failures", failures.cast("long"))


def passes(policy: str = CURRENT, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(records: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail nothing else, and that would be kept without it.

    The ledger is reduced to counts per distinct bit set first, of which there are at most 2 to the number of rules.
    """
    whole = F.lit(mask(policy)).cast("long")
    sets = records.groupBy(F.col("failures").bitwiseAND(whole).alias("failed")).agg(F.count("*").alias("n"))
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for r in RULES if r.name in POLICIES[policy]
    ])
    each = sets.withColumn("r", F.explode(rules)).select("failed", "n", "r.rule", "r.bit")
    failed = F.col("failed").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failed") == F.col("bit")
    kept = F.col("failed").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    return each.groupBy("rule").agg(
        *[F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)
          for condition, name in ((failed, "n_failed"), (alone, "n_failed_alone"), (kept, "n_kept_without"))]
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass the policy, with the columns they came with."""
    rows = docs.select(packed(docs).alias("packed"), col("text").alias("text"))
    return unpacked(ledger(rows, ["packed"]).filter(passes(policy)).select("row.packed"), "packed", docs)
