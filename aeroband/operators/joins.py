"""Equi-joins that hold up when one key carries a large share of the rows."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_REDUCER = 1 << 20
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size: 16 bytes a column, and the bytes of its texts."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), F.lit(16 * len(df.columns)))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows, measured by one aggregation over them, are few enough to send to every executor."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= limit


def join_on_bucket(
    left: DataFrame, right: DataFrame, on: list[str], how="left", small=False, most: int = ROWS_PER_REDUCER
) -> DataFrame:
    """``left`` joined to ``right``, whose size per key is bounded, on columns named alike.

    ``small``: the caller has measured the right side and found it fit to broadcast; nothing is shuffled.
    Otherwise keys that hold more than ``most`` left rows, nulls among them, are counted and spread over as many reducers
    as that takes, with a copy of their right rows for each; other keys, and the right side of all without skew, stay as
    they are. There is at most one such key per ``most`` rows, which bounds the broadcast list of them.
    """
    if small:
        return left.join(F.broadcast(right), on=on, how=how)
    salted_left, salted_right = salted(left, right, on, most)
    return salted_left.join(salted_right, on=[*on, "_salt"], how=how).drop("_salt")


def salted(left: DataFrame, right: DataFrame, on: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: heavy keys of the left side are spread over salts, the right side's copied to each."""
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    heavy = F.broadcast(counts.select(
        *[F.col(name).alias(f"_heavy_{name}") for name in on], F.ceil(F.col("_n") / most).cast("int").alias("_salts")
    ))

    def with_salts(df):
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_heavy_{name}")) for name in on])
        return df.join(heavy, same, "left").drop(*[f"_heavy_{name}" for name in on])

    salts = F.coalesce("_salts", F.lit(1))
    spread = with_salts(left).withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
    copied = with_salts(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return spread.drop("_salts"), copied.drop("_salts")
