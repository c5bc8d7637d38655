"""Small numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or_null(value: Column) -> Column:
    """The number, or null for NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def rounded_sql(value: str, digits: int) -> str:
    """SQL that rounds a double half away from zero after scaling it, so that 115.44999999999999, whose tenfold is 1154.5,
    becomes 115.5. Spark's own ``round`` goes by the decimal digits and gives 115.4."""
    scale = f"{10**digits}D"
    return f"(round({value} * {scale}, 0) / {scale})"


def safe_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded in the same way; null if the whole is 0 (a plain division by 0 raises under ANSI
    rules)."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)) * F.lit(10.0**digits)) / F.lit(10.0**digits)
