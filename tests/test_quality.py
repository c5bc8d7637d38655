from datetime import date

import pytest
from pyspark.sql import functions as F

from aeroband.operators.quality import (
    QualityError, accepted_values, between, gate, merged_report, not_null, row_count, run_suite, suite_state, unique,
)

GOOD = [("a", 1), ("b", 10)]


def suite():
    return [
        row_count(1, 3), not_null("k"), unique("k"), unique("v"), accepted_values("k", ["a", "b"]), between("v", 1, 10),
    ]


def report(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    return {(r["check"], r["column"]): (r["violations"], r["passed"]) for r in run_suite(df, suite()).collect()}


def test_all_pass(spark):
    assert set(report(spark, GOOD).values()) == {(0, True)} and len(report(spark, GOOD)) == 6


@pytest.mark.parametrize(
    ("rows", "check", "violations"),
    [
        ([], ("row_count", ""), 1),
        ([("a", 1), ("b", 2), (None, 3), (None, None)], ("row_count", ""), 1),
        ([("a", 1), (None, 2), (None, 3)], ("not_null", "k"), 2),
        ([("a", 1), ("a", 2), ("b", 3)], ("unique", "k"), 1),
        ([("a", 5), ("b", 5), (None, 5)], ("unique", "v"), 1),
        ([("a", 1), ("c", 2), ("d", 3)], ("accepted_values", "k"), 2),
        ([("a", 0), ("b", 11)], ("between", "v"), 2),
    ],
)
def test_each_check_fails_alone(spark, rows, check, violations):
    assert report(spark, rows)[check] == (violations, False)


def test_nulls_are_left_to_not_null(spark):
    found = report(spark, [(None, None), (None, None)])
    assert found.pop(("not_null", "k")) == (2, False)
    assert set(found.values()) == {(0, True)}


def test_suite_without_uniqueness_is_one_pass(spark, plan_of):
    df = spark.range(10)
    plan = plan_of(run_suite(df, [row_count(), not_null("id"), between("id", 0, 9)]))
    assert plan.split("\n\n")[0].count("Range") == 1


def test_gate_names_every_failure(spark):
    df = spark.range(3).withColumn("x", F.lit(None).cast("string"))
    gate({"fine": run_suite(df, [not_null("id")])})
    with pytest.raises(QualityError) as refusal:
        gate({
            "one": run_suite(df, [not_null("x"), not_null("id")]),
            "two": run_suite(df, [not_null("id")]),
            "three": run_suite(df, [between("id", 1, 2)]),
        })
    assert refusal.value.failures == [("one", "not_null", "x", 3), ("three", "between", "id", 1)]
    assert "three: between id (1 violations)" in str(refusal.value)


def test_state_merges_to_the_report_of_the_whole(spark):
    days = [date(2024, 1, n) for n in (1, 2, 3)] + [None]
    rows = [(f"k{n % 7}" if n % 5 else None, n % 13, days[n % 4]) for n in range(100)]
    df = spark.createDataFrame(rows, "k string, v int, d date")
    for kept in (rows, rows[:3], rows[:1], []):
        part = df.limit(0) if not kept else spark.createDataFrame(kept, df.schema)
        counts, keys = suite_state(part, suite(), F.col("d"))
        assert sorted(map(str, merged_report(counts, keys, suite()).collect())) == sorted(map(str, run_suite(part, suite()).collect()))


def test_state_of_changed_partitions_replaces_theirs(spark):
    """Values that are unique on each day but not across days are found, and no longer once a day has changed."""
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    old = spark.createDataFrame([("a", 1, first), ("b", 50, first), ("b", 3, second)], "k string, v int, d date")
    new = spark.createDataFrame([("c", 3, second)], old.schema)
    states = [suite_state(df, suite(), F.col("d")) for df in (old, new)]
    report = lambda *state: {(r["check"], r["column"]): r["violations"] for r in merged_report(*state, suite()).collect()}
    assert report(*states[0])["unique", "k"] == 1
    kept = [state.filter(F.col("part") != F.lit(second)) for state in states[0]]
    after = report(*[a.unionByName(b) for a, b in zip(kept, states[1])])
    assert after["unique", "k"] == 0 and after["between", "v"] == 1 and after["row_count", ""] == 0


def test_state_reads_the_table_once(spark, tmp_path):
    spark.range(20).selectExpr("string(id) as k", "int(id) as v", "date'2024-01-01' as d").write.parquet(str(tmp_path / "t"))
    counts, keys = suite_state(spark.read.parquet(str(tmp_path / "t")), suite(), F.col("d"))
    assert not [f for df in (counts, keys) for f in df.inputFiles() if str(tmp_path / "t") in f]
