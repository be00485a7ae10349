"""Ranked lexical search against scoring every document."""

import brute
import numpy as np
import pytest
from tablevault.llm import lexical_search as search
from tablevault.llm.common import table

SF = "/root/testdata/sf0.01"


def found(docs, items, best=10):
    return sorted(tuple(r) for r in search.search(docs, items, best).collect())


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(rows, "item_id long, text string")


def test_equals_scoring_all(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute.ranked(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in items.collect()],
    )
    assert found(docs, items) == want


def test_odd_rows(documents, items):
    rows = [
        (1, "Cat cat CAT dog"), (2, "cat"), (3, None), (4, ""), (5, " .,! "), (6, "été cat"),
        (7, "cat"), (7, "dog dog"), (None, "cat"), (8, "x " * 5000 + "cat"),
    ]
    asked = [(1, "CAT, dog! cat"), (2, None), (3, "..."), (4, "unknown words"), (5, "Été"), (1, "dog")]
    got = found(documents(*rows), items(*asked), best=20)
    want = brute.ranked(rows, asked, best=20)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # "É" is not lower-cased, so item 5 finds nothing.
    assert {r[0] for r in got} == {1}


def test_equal_scores_go_by_id(documents, items):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here")] * 3
    got = found(documents(*rows), items((9, "words")))
    assert [(r[1], r[2]) for r in got] == [(i, i) for i in range(1, 11)]


def test_other_columns_do_not_clash(spark, items):
    docs = spark.sql("SELECT 1 doc_id, 'a b' text, 'x' item, 2 score, 'y' ids, 3 rank, 4 lengths")
    asked = items((1, "b")).selectExpr("*", "1 doc_id", "'z' term")
    assert [r[:3] for r in found(docs, asked)] == [(1, 1, 1)]


def test_empty_tables(documents, items):
    assert found(documents(), items((1, "a"))) == []
    assert found(documents((1, "a")), items()) == []
    assert found(documents((1, None)), items((1, "a"))) == []


def test_items_in_blocks(documents, items, monkeypatch):
    rows = [(i, f"common word{i % 7} word{i % 5} " + "more " * (i % 9)) for i in range(60)]
    asked = [(i, f"common word{i % 7} more") for i in range(9)]
    whole = found(documents(*rows), items(*asked))
    monkeypatch.setattr(search, "ITEMS", 4)
    monkeypatch.setattr(search, "ITEM_TERMS", 5)
    assert found(documents(*rows), items(*asked)) == whole == brute.ranked(rows, asked)


def test_many_candidates_are_not_broadcast(documents, items, monkeypatch):
    rows = [(i, f"a b c{i % 3}") for i in range(50)]
    monkeypatch.setattr(search, "MOST_BROADCAST", 0)
    assert found(documents(*rows), items((1, "a c1"))) == brute.ranked(rows, [(1, "a c1")])


def test_full_signatures_exclude_nothing(documents, items, monkeypatch):
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(40)) + (" key" if i == 3 else "")) for i in range(30)]
    monkeypatch.setattr(search, "MOST_BITS", 64)
    assert found(documents(*rows), items((1, "key t5x1"))) == brute.ranked(rows, [(1, "key t5x1")])


def test_blocks_hold_every_document_once(documents, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ROWS", 8)
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(70)]
    index = search.build_index(documents(*rows)).collect()
    assert sorted(i for r in index for i in r["ids"]) == list(range(1, 70))
    for block in index:
        assert block["lengths"] == block["ids"]
        assert len(block["slices"]) == block["width"] * -(-len(block["ids"]) // 8)


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(search, "_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    terms = search.Terms([b"ab", b"cd", b"abc"])
    tokens = search.Tokens.of(__import__("pyarrow").array(["cd x ab", None, "abc cd abcd"]))
    token, term = terms.among(tokens)
    assert list(zip(tokens.doc[token].tolist(), term.tolist(), strict=True)) == [
        (0, 1), (0, 0), (2, 2), (2, 1),
    ]
