import hashlib
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from aeroband.llm import queries, token_alignment

A, B = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, row string, block string, n_a long, keys string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(A)
    byte_level.encode_special_tokens = True
    return byte_level, sentencepiece.SentencePieceProcessor(model_file=B)


def encoded(libraries, text):
    """Ids and byte tokens of both sides, by the libraries themselves, one text at a time."""
    byte_level, pieces = libraries
    letters = token_alignment.byte_alphabet()
    a = byte_level.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    tokens_a = [bytes(letters[c] for c in byte_level.id_to_token(i)) for i in a]
    names = [pieces.id_to_piece(i) for i in b]
    tokens_b = [bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
    return a, b, tokens_a, tokens_b


def brute(libraries, rows):
    """The contract's columns, from sets of end offsets."""
    counts, of_row = Counter(), []
    for _, text in rows:
        a, b, tokens_a, tokens_b = encoded(libraries, text) if text else ([], [], [], [])
        if not text or b"".join(tokens_a) != (" " + text).encode() or b"".join(tokens_b) != (" " + text).encode():
            of_row.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(t) for t in tokens]).tolist() for tokens in (tokens_a, tokens_b))
        ends = sorted(set(ends_a) & set(ends_b))
        groups, links = [], []
        at_a, at_b = ({e: k + 1 for k, e in enumerate(of_side)} | {0: 0} for of_side in (ends_a, ends_b))
        for start, end in zip([0, *ends], ends):
            own_a, own_b = a[at_a[start]:at_a[end]], b[at_b[start]:at_b[end]]
            groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
            links.append((own_a[-1], own_b[-1]))
        counts.update(links)
        of_row.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return counts, most, [
        (i, 0, 0, 0, 0, 0, 0, "") if found is None else (
            i, *found[:3], len(found[3]), sum(counts[p] == most[p[1]] for p in found[3]), sum(counts[p] for p in found[3]), found[4]
        ) for (i, _), found in zip(rows, of_row)
    ]


@pytest.fixture(scope="module")
def rows(spark):
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    odd = [
        None, "", " ", "  two  spaces ", "x", "the", "\n", "tab\tand\r\nlines\n\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ low",
        "naïve café   　wide", "\U0001f600\U0001f468‍\U0001f469", "हिन्दी বাংলা ਪੰਜਾਬੀ", "a" * 3000, "word " * 20_000, "\0nul", "ﬁ ﬀ ①",
    ]
    found = [tuple(row) for row in some] + [(1000 + i, text) for i, text in enumerate(odd)]
    return found + [(None, "no id")] + found[:3] + [(7, "common words in a third of all rows")] * 120


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "r", "b", 5, "k") for i, t in rows], DOCS)


def ordered(found):
    return sorted(map(tuple, found), key=lambda row: (row[0] is not None, *map(str, row)))


def test_query_is_that_of_brute_force(spark, docs, rows, libraries, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    found = queries.op11_token_alignment(spark, "")
    assert ordered(found.collect()) == ordered(brute(libraries, rows)[2])
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_many_small_blocks_give_the_same(docs, rows, libraries):
    limits = token_alignment.Limits(block_links=2000, block_docs=40, fan_in=3, runs_per_salt=2)
    found = token_alignment.Alignment(docs.repartition(2), ["doc_id"], A, B, limits=limits).documents()
    got = found.select("row.doc_id", *token_alignment.FIGURES, "n_best", "count_sum", "groups_sha256")
    assert ordered(got.collect()) == ordered(brute(libraries, rows)[2])


def test_pairs_are_those_of_brute_force(docs, rows, libraries):
    counts, most, _ = brute(libraries, rows)
    found = token_alignment.Alignment(docs, docs.columns, A, B).pairs().collect()
    assert {(r.a, r.b): (r["count"], r.best) for r in found} == {p: (n, n == most[p[1]]) for p, n in counts.items()}
    assert len(found) == len(counts)


def test_empty_table(spark, docs):
    alignment = token_alignment.Alignment(docs.limit(0), ["doc_id"], A, B)
    assert not alignment.documents().collect() and not alignment.pairs().collect()


def test_byte_side_gives_the_ids_of_its_file_on_every_character(libraries):
    side = token_alignment.ByteSide(A)
    known = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Co", "Cn")]
    texts = [f"a{c}b 1{c}2 .{c}. {c} {c}\n{c}{c}" for c in known[::9] + known[:3000]] + [" \n ", "\t\tx  y   z ", " " * 500, "'s 'LL"]
    wanted = [found.ids for found in libraries[0].encode_batch([" " + text for text in texts], add_special_tokens=False)]
    assert [ids.tolist() for ids in side(texts)] == wanted
