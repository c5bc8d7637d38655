import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aeroband.llm import sharding

DOCS = "doc_id long, text string, shard string, slot string, row string, _place int"


def jump(key, shards):
    """The published loop."""
    state, here, after = int(hashlib.md5(str("" if key is None else key).encode()).hexdigest()[:16], 16), -1, 0
    while after < shards:
        here = after
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        after = int((here + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return here


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text {i % 17}" * (i % 5), "x", "y", "z", i) for i in range(700)]
    rows += [(9, "same", "x", "y", "z", 0)] * 350  # a key with a third of all rows, all alike
    rows += [(None, None, None, None, None, None), (None, "é\U0001f600", "a", "b", "c", 1), (-5, "", "a", "b", "c", 1)]
    return spark.createDataFrame(rows + [(800, "long " * 100_000, "", "", "", 0)], DOCS)


@pytest.mark.parametrize("steps", [3, 40])
def test_shards_are_those_of_the_published_loop(spark, monkeypatch, steps):
    monkeypatch.setattr(sharding, "STEPS", steps)
    numbers = {"a": 1, "b": 2, "c": 24, "d": 25, "e": 1000}
    found = sharding.with_shards(spark.range(-50, 300), F.col("id"), numbers).collect()
    assert [tuple(row)[1:] for row in found] == [tuple(jump(row.id, n) for n in numbers.values()) for row in found]


def test_placed_follows_its_contract(docs):
    found = sharding.placed(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    data = [(r.doc_id, (r.text or "").encode()) for r in rows]
    wanted = Counter((i, len(b) + 8, zlib.crc32(b), "key", jump(i, 24), jump(i, 25)) for i, b in data)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in found) == wanted
    for shard in {r.shard for r in found}:
        of_shard = sorted((r for r in found if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in of_shard] == list(range(len(of_shard)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in of_shard]
        assert order == sorted(order)


def test_growth_moves_rows_into_new_shards_only(docs):
    assert {(r.shard == r.grown_shard or r.grown_shard == 24) for r in sharding.placed(docs).collect()} == {True}
    keys = docs.select(F.col("_place").alias("doc_id"), "text").dropna().dropDuplicates(["doc_id"])
    gone = sharding.moved(keys, 24, 30)
    assert gone.filter("grown_shard < 24").count() == 0
    share = gone.count() / keys.count()
    assert 0.1 < share < 0.3  # a fifth belongs in six of thirty shards


def test_written_shards_hold_all_rows_and_columns(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    whole = sharding.read_shard(back, docs)
    assert whole.columns == docs.columns
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, docs.collect()))
    assert {(r.row.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, jump(r.doc_id, 4)) for r in docs.collect()}


def test_empty_table(spark):
    found = sharding.placed(spark.createDataFrame([], DOCS))
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and not found.collect()


def test_plan_has_no_python(spark, plan_of):
    plan = plan_of(sharding.with_shards(spark.range(9), F.col("id"), {"n": 24}).filter("n > 3"))
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
