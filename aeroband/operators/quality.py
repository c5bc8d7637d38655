"""Data checks: counted on the executors, one row per check as the result.

A suite can also be kept as state: counts per partition of the data, and for uniqueness the number of rows per
partition and value. Both merge by summing, so when a few partitions change only theirs are counted anew, and the report
of the whole table comes from the state.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroband.functions import sql_text
from aeroband.session import written_once

# Columns of the state: counts per partition and check, and rows per partition and value of a unique column.
COUNTS = "part date, check_no int, measured long"
KEYS = "part date, check_no int, value string, n long"


@dataclass(frozen=True)
class Check:
    """A named check of a column; ``bad`` is true for a row that breaks it (null and false: it does not)."""

    name: str
    column: str
    bad: Column | None = None
    bounds: tuple = ()


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values) -> Check:
    """Nulls are the business of ``not_null``."""
    return Check("accepted_values", column, ~F.col(column).isin(list(values)))


def between(column: str, low, high) -> Check:
    """Both ends allowed; nulls are the business of ``not_null``."""
    return Check("between", column, ~F.col(column).between(low, high))


def unique(column: str) -> Check:
    """Violations are the values that occur more than once; nulls do not count."""
    return Check("unique", column)


def row_count(at_least: int = 1, at_most: int | None = None) -> Check:
    return Check("row_count", "", bounds=(at_least, at_most))


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """The report of a table, one row (check, column, violations, passed) per check, whatever the others find.

    All row checks and the row count are one pass. A uniqueness check needs its values brought together; the first
    one shares the pass by grouping on its column, where each task sends partial counts per value.
    """
    uniques = [c for c in checks if c.name == "unique"]
    reports = [_one_pass(df, [c for c in checks if c.name != "unique"], uniques[:1])]
    reports += [_one_pass(df, [], [check]) for check in uniques[1:]]
    return reduce(DataFrame.unionByName, reports)


def _one_pass(df, checks, uniques):
    measures = {f"m{i}": _measure(check) for i, check in enumerate(checks)}
    if uniques:
        column = uniques[0].column
        groups = df.groupBy(F.col(column).alias("_value")).agg(
            F.count(F.lit(1)).alias("_rows"), *[m.alias(name) for name, m in measures.items()]
        )
        repeated = F.count_if((F.col("_rows") > 1) & F.col("_value").isNotNull())
        totals = groups.agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures], repeated.alias("m_unique")
        )
    else:
        totals = df.agg(*[m.alias(name) for name, m in measures.items()])
    rows = [_report_row(check, F.col(name)) for check, name in zip(checks, measures)]
    rows += [_report_row(check, F.col("m_unique")) for check in uniques]
    return totals.select(F.inline(F.array(*rows)))


def _measure(check):
    return F.count(F.lit(1)) if check.name == "row_count" else F.count_if(check.bad)


def _report_row(check, measured):
    if check.name == "row_count":
        at_least, at_most = check.bounds
        outside = measured < F.lit(at_least)
        if at_most is not None:
            outside = outside | (measured > F.lit(at_most))
        violations = outside.cast("long")
    else:
        violations = measured.cast("long")
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.column).alias("column"),
        violations.alias("violations"),
        (violations == 0).alias("passed"),
    )


def suite_state(df: DataFrame, checks: list[Check], part: Column) -> tuple[DataFrame, DataFrame]:
    """The state of a table, or of some of its partitions: counts per ``part`` (a date) and check, and rows per part and
    value of the columns that should be unique. Checks go by their place in the list.

    The table is read once: the rows per value of the first unique column, with the counts of the other checks beside,
    are written to the shared folder, and the counts per part are added up from them.
    """
    uniques = [i for i, check in enumerate(checks) if check.name == "unique"]
    measures = {i: _measure(check) for i, check in enumerate(checks) if check.name != "unique"}
    columns = {f"v{i}": F.col(checks[i].column).cast("string") for i in uniques}
    grouped = df.groupBy(part.cast("date").alias("part"), *[value.alias(name) for name, value in columns.items()]).agg(
        F.count(F.lit(1)).alias("n"), *[measure.alias(f"m{i}") for i, measure in measures.items()]
    )
    if uniques:
        grouped = written_once(grouped)
    entries = F.array(*[F.struct(F.lit(i).alias("check_no"), F.sum(f"m{i}").alias("measured")) for i in measures])
    counts = grouped.groupBy("part").agg(entries.alias("e")).select("part", F.inline("e")) if measures else _none(df, COUNTS)
    keys = [
        grouped.filter(F.col(f"v{i}").isNotNull()).groupBy("part", F.col(f"v{i}").alias("value"))
        .agg(F.sum("n").alias("n")).select("part", F.lit(i).alias("check_no"), "value", "n")
        for i in uniques
    ]
    return counts, reduce(DataFrame.unionByName, keys) if keys else _none(df, KEYS)


def _none(df, schema):
    """No rows, as part of a plan costs nothing."""
    columns = [column.split() for column in schema.split(", ")]
    return df.sparkSession.sql(f"select {', '.join(f'cast(null as {kind}) as {name}' for name, kind in columns)} where false")


def merged_report(counts: DataFrame, keys: DataFrame, checks: list[Check]) -> DataFrame:
    """The report of a whole table from the state of all its partitions, as ``run_suite`` gives it. A table without
    rows has no state."""
    one = F.lit("").alias("model")
    found = merged_reports(counts.select("*", one), keys.select("*", one), {"": ("", 0, checks)})
    return found.drop("place", "table")


def merged_reports(counts: DataFrame, keys: DataFrame, suites: dict[str, tuple[str, int, list[Check]]]) -> DataFrame:
    """The reports of several tables, whose states have the column ``model``, in one plan; ``table`` names the suite,
    ``place`` is that of the check.

    A suite is the name of its model, the place of its first check among the model's, and its checks.
    """
    values = keys.groupBy("model", "check_no", "value").agg(F.sum("n").alias("n")).filter("n > 1")
    repeated = values.groupBy("model", "check_no").agg(F.count(F.lit(1)).alias("measured"))
    measured = counts.select("model", "check_no", "measured").unionByName(repeated)
    totals = measured.groupBy("model", "check_no").agg(F.sum("measured").alias("measured"))
    listed = [(name, model, first + i, check) for name, (model, first, checks) in suites.items() for i, check in enumerate(checks)]
    rows = [
        (place, name, model, check_no, check.name, check.column, *(check.bounds or (None, None)))
        for place, (name, model, check_no, check) in enumerate(listed)
    ]
    values = ", ".join(f"({', '.join(_literal(value) for value in row)})" for row in rows)
    named = counts.sparkSession.sql(
        f"select * from values {values} as t(place, `table`, model, check_no, `check`, `column`, at_least, at_most)"
    )
    rows_found = F.coalesce("measured", F.lit(0).cast("long"))
    outside = (rows_found < F.col("at_least")) | F.coalesce(rows_found > F.col("at_most").cast("long"), F.lit(False))
    violations = F.when(F.col("check") == "row_count", outside.cast("long")).otherwise(rows_found)
    return named.join(totals, ["model", "check_no"], "left").select(
        "place", "table", "check", "column", violations.alias("violations"), (violations == 0).alias("passed")
    )


def _literal(value) -> str:
    return "null" if value is None else str(value) if isinstance(value, int) else sql_text(value)


class QualityError(Exception):
    """Some check failed; ``failures`` lists (table, check, column, violations)."""

    def __init__(self, failures):
        self.failures = failures
        lines = [f"{table}: {check} {column} ({violations} violations)" for table, check, column, violations in failures]
        super().__init__("; ".join(lines))


def gate(reports: dict[str, DataFrame] | DataFrame) -> None:
    """Run the reports of all tables, then refuse if any check failed. A report has one row per check; reports of several
    tables in one say which in the column ``table``."""
    if isinstance(reports, dict):
        reports = reduce(DataFrame.unionByName, [df.withColumn("table", F.lit(name)) for name, df in reports.items()])
    failed = reports.filter(~F.col("passed")).collect()
    if "place" in reports.columns:
        failed.sort(key=lambda row: row["place"])
    if failed:
        raise QualityError([(row["table"], row["check"], row["column"], row["violations"]) for row in failed])
