import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroband.llm import periodic_runs, queries

DOCS = "doc_id long, text string, row string, runs string, n_words long, collapsed string"


def brute(words, least=24):
    """Every period by itself; of stretches found with several, the smallest period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((begin, end - begin, q) for (begin, end), q in found.items())


def words_of(rng):
    """Words with runs in runs, runs that touch, near runs, and rare or common words."""
    kinds, out = rng.choice([2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 5)):
        if rng.random() < 0.4:
            out += [rng.randrange(kinds) for _ in range(rng.randint(0, 40))]
            continue
        q = rng.choice([rng.randint(1, 12), rng.randint(10, 80)])
        inner = [rng.randrange(kinds) for _ in range(rng.choice([q, max(1, q // rng.randint(3, 8))]))]
        unit = (inner * q)[:q]
        if rng.random() < 0.5:
            unit[rng.randrange(q)] = rng.randrange(50)
        out += (unit * 7)[:rng.randint(2 * q, 6 * q)]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = [words_of(rng) for _ in range(rng.randint(1, 4))]
        codes, wanted = [], []
        for i, words in enumerate(docs):
            wanted += [(begin + len(codes), begin + length + len(codes), q) for begin, length, q in brute(words)]
            codes += [*words, -1 - i]
        found = periodic_runs.runs_of(np.array(codes), max(map(len, docs)))
        assert list(map(tuple, found.tolist())) == sorted(wanted, key=lambda run: (run[0], run[2]))


def test_periodic_texts_whose_parts_are_periodic_or_alike():
    thue = [bin(i).count("1") % 2 for i in range(512)]
    fibonacci = [0]
    for _ in range(14):
        fibonacci = [x for v in fibonacci for x in ([0, 1] if v == 0 else [0])]
    for words in (thue * 3, fibonacci, [0] * 3000, ([1] * 400 + [2]) * 4, (([1, 2] * 60 + [3]) * 5 + [4]) * 3):
        found = periodic_runs.runs_of(np.array(words), len(words)).tolist()
        assert [(begin, end - begin, q) for begin, end, q in found] == brute(words)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for begin, length, q in runs for i in range(begin + q, begin + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{begin},{length},{q}\n" for begin, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2], *sha)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(f"é{w}" for w in words_of(rng))) for i in range(150)]
    rows += rows[:50] + [(600, "a b " * 30)] * 100 + [(None, "x y z " * 20), (500, None), (501, ""), (502, " \n\x0b")]
    rows += [(503, "\x0c one\x1ctwo three four " * 12), (504, "p q r " * 15_000), (10, "\u0085 " * 40)]
    return spark.createDataFrame([(i, t, "r", "s", 1, "c") for i, t in rows], DOCS)


def test_query_is_that_of_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    found = queries.op12_periodic_runs(spark, "")
    key = lambda row: (row[0] is not None, *map(str, row))
    wanted = [expected(r.doc_id, r.text if r.doc_id != 504 else None) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in found.collect()]
    assert sorted((r for r in got if r[0] != 504), key=key) == sorted((r for r in wanted if r[0] != 504), key=key)
    assert [r[:5] for r in got if r[0] == 504] == [(504, 1, 0, 45_000, 3)]
    assert sum(r[1] > 0 for r in got) > 50


def test_carried_columns_and_empty_table(spark, docs):
    found = periodic_runs.runs(docs, docs.columns)
    assert found.select("row.*").columns == docs.columns
    assert found.filter("row.doc_id = 600").select("collapsed", F.element_at("runs", 1)["period"]).distinct().first() == ("a b", 2)
    assert not periodic_runs.runs(docs.limit(0), ["doc_id"]).collect()
