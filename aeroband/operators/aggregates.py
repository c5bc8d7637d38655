"""Aggregate expressions."""

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F


# Sums of doubles that depend neither on the order of the rows nor on how they are spread: a value is cut into its whole
# part and two times PART_BITS bits of its fraction, and each part is summed as a long integer. A value of this size or
# more, or one that is not finite, is added as it is.
PART_BITS = 30
LARGE = float(1 << 31)


def sum_state(value: str) -> Column:
    """An exact sum of an SQL expression as an aggregate: a struct whose fields merge by adding them up
    (``merged_state``). Given as text, as building it from columns would take some thirty calls into the JVM.

    Longs hold the sums of 2^32 rows of a group. What a value has below 2^-60 is cut off.
    """
    # Parts of the size, as the fraction of a negative value would be rounded.
    size, scale = f"abs({value})", f"{1 << PART_BITS}D"
    whole = f"floor({size})"
    middle = f"floor(({size} - {whole}) * {scale})"
    low = f"floor((({size} - {whole}) * {scale} - {middle}) * {scale})"
    fits = f"{size} < {LARGE}D"
    sums = [
        f"'{name}', sum(case when {fits} then case when {value} < 0 then -{part} else {part} end end)"
        for name, part in (("whole", whole), ("middle", middle), ("low", low))
    ]
    other = f"'other', sum(case when not {fits} then cast({value} as double) end)"
    return F.expr(f"named_struct({', '.join(sums)}, {other}, 'n', count({value}))")


def merged_state(state: str) -> Column:
    """Partial sums of ``sum_state`` in the column ``state``, as one."""
    fields = ("whole", "middle", "low", "other", "n")
    return F.expr(f"named_struct({', '.join(f"'{name}', sum({state}.{name})" for name in fields)})")


def total_of(state: str) -> str:
    """SQL of the sum as a double, null over no values."""
    mask = (1 << PART_BITS) - 1
    middle = f"({state}.middle + shiftright({state}.low, {PART_BITS}))"
    whole = f"({state}.whole + shiftright({middle}, {PART_BITS}))"
    fraction = f"(shiftleft({middle} & {mask}L, {PART_BITS}) + ({state}.low & {mask}L))"
    exact = f"(cast({whole} as double) + cast({fraction} as double) / {1 << 2 * PART_BITS}D)"
    return f"(case when {state}.other is null then {exact} else {state}.other + coalesce({exact}, 0D) end)"


def mean_of(state: str) -> str:
    return f"({total_of(state)} / nullif({state}.n, 0))"


def with_totals(grouped: GroupedData, sums: dict[str, str], means: dict[str, str], *others: Column) -> DataFrame:
    """An aggregation with exact sums and means (names to SQL expressions of the rows) beside other aggregates; columns
    in that order."""
    states = {**sums, **means}
    found = grouped.agg(*[sum_state(value).alias(name) for name, value in states.items()], *others)
    reals = {name: F.expr(total_of(name)) for name in sums} | {name: F.expr(mean_of(name)) for name in means}
    return found.withColumns(reals)


def mean_where(condition: Column, value: Column) -> Column:
    """Plain mean over the rows where the condition holds, null if there are none. Several of these pivot a long table
    in one pass, next to any other measure of the same group."""
    return F.avg(F.when(condition, value))


def where(condition: str, value: str) -> str:
    """SQL of a value that only counts on rows where the condition holds, for exact means of them."""
    return f"(case when {condition} then {value} end)"


def row_count(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)
