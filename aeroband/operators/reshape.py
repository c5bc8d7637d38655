"""Projections that depend on which columns hold data, and wide-to-long."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def non_empty_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Those columns that exist and hold some value: one aggregation, one row to the driver."""
    present = available(df, columns)
    if not present:
        return []
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in present]).first()
    return [c for c in present if counts[c] > 0]


def available(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the wanted columns that exist, in the wanted order."""
    return [c for c in columns if c in df.columns]


def select_available(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*available(df, columns))


def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Two columns of the rows that have both."""
    return df.select(x, y).dropna(subset=[x, y])


def to_series(df: DataFrame, ids: list[str], columns: dict[str, str], name="series", value="value") -> DataFrame:
    """Wide to long: one row per row of ``df`` and named column; columns without any value are left out, single
    nulls stay. ``columns`` maps series names to columns.

    All in one plan: the names of the series that hold a value, no more than there are columns, are joined back.
    """
    named = {label: column for label, column in columns.items() if column in df.columns}
    if not named:
        return df.select(*ids, F.lit(None).cast("string").alias(name), F.lit(None).cast("double").alias(value)).limit(0)
    wide = df.select(*ids, *[F.col(column).alias(label) for label, column in named.items()])
    long = wide.unpivot(ids, [f"`{label}`" for label in named], name, value)
    held = long.filter(F.col(value).isNotNull()).select(name).distinct()
    return long.join(F.broadcast(held), name, "left_semi").select(*ids, name, value)
