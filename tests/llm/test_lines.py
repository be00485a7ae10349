"""Recurring lines that op9 and the pipeline's line stage must drop."""

import time

import brute
import corpus_pipeline as pipeline
from conftest import words

from tablevault.llm import queries as Q
from tablevault.llm.common import table

SF = "/root/testdata/sf0.01"


def dropped(spark, rows, tmp_path):
    """{doc_id: line numbers} by op9, after comparing it with the pipeline's stage."""
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["dropped_lines"] for r in Q.op9_template_tree(spark, str(tmp_path)).collect()}
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    stage = dict(pipeline.STAGES)["line_dedup"](spark, rows, "").collect()
    for r in stage:
        lines = texts[r["doc_id"]].split("\n")
        kept = [x for i, x in enumerate(lines) if i not in found[r["doc_id"]]]
        assert r["text"] == "\n".join(kept)
    return found


def test_short_lines_recur_unmasked(documents, spark, tmp_path):
    rows = [(i, f"{words(100 * i, 9)}\nPage 3 of 10\n\n前書きと目次\nPage {i} of 7") for i in range(4)]
    rows += [(10 + i, f"{words(5000 + 100 * i, 9)}\nOnly three") for i in range(3)]
    got = dropped(spark, documents(*rows), tmp_path)
    assert got == {0: [], 1: [1, 3], 2: [1, 3], 3: [1, 3], 10: [], 11: [], 12: []}


def test_two_templates_in_one_leaf(documents, spark, tmp_path):
    forum = "Posted by user {} in the forum for general talk today at noon"
    mail = "Posted by user {} via mail from our old list archive server there"
    names = [words(100 + i, 1) for i in range(12)]
    lines = [forum.format(n) for n in names[:5]] + [mail.format(n) for n in names[5:9]]
    lines += [f"Posted by user {words(200 + 20 * i, 10)}" for i in range(7)]
    rows = [(i, f"{words(5000 + 100 * i, 9)}\n{x}") for i, x in enumerate(lines)]
    got = dropped(spark, documents(*rows), tmp_path)
    assert {d for d, at in got.items() if at} == {1, 2, 3, 4, 6, 7, 8}
    assert all(at in ([], [1]) for at in got.values())


def test_long_lines_of_two_documents(documents, spark, tmp_path):
    passage, unspaced = words(0, 50), "".join(chr(0x4E00 + i) for i in range(300))
    rows = [(i, f"{words(1000 + 500 * i, 200)}\n{passage}\n{unspaced}\nOne short line here") for i in range(2)]
    rows += [(10 + i, f"{words(5000, 49)}\n{words(7000, 60)} {2020 + i}") for i in range(2)]
    got = dropped(spark, documents(*rows), tmp_path)
    assert got == {0: [], 1: [1, 2], 10: [], 11: []}


def test_copies_of_a_document_keep_their_long_lines_for_the_next_stage(documents, spark):
    own = f"{words(0, 200)}\n{words(300, 200)}"
    docs = documents((1, own), (2, own + " end"), (3, f"{words(300, 200)}\n{words(900, 90)}"))
    stages = dict(pipeline.STAGES)
    lines = stages["line_dedup"](spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == {
        1: own, 2: own + " end", 3: words(900, 90),
    }
    assert {r["doc_id"] for r in stages["near_dedup"](spark, lines, "").collect()} == {1, 3}


def test_query_over_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    gone = brute.recurring_lines(list(texts.items()))
    assert sum(map(len, gone.values())) > 100
    rows = Q.op9_template_tree(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lines = texts[r["doc_id"]].split("\n")
        kept = [x for i, x in enumerate(lines) if i not in set(gone[r["doc_id"]])]
        assert r["dropped_lines"] == gone[r["doc_id"]]
        assert (r["n_lines"], r["n_dropped"]) == (len(lines), len(lines) - len(kept))
        assert r["kept_sha256"] == brute.sha("\n".join(kept))


def test_no_lines(documents, spark, tmp_path):
    assert dropped(spark, documents(), tmp_path) == {}
    (tmp_path / "odd").mkdir()
    same = "the same few words"
    rows = documents((1, None), (2, ""), (3, "\n\n"), (4, same), (4, same), (5, same), (6, same), (7, same))
    rows.coalesce(1).write.parquet(f"{tmp_path}/odd/documents.parquet")
    got = {(r["doc_id"], tuple(r["dropped_lines"])) for r in Q.op9_template_tree(spark, f"{tmp_path}/odd").collect()}
    assert got == {(1, ()), (2, ()), (3, ()), (4, ()), (5, (0,)), (6, (0,)), (7, (0,))}


def test_documents_of_very_many_lines(documents, spark, tmp_path):
    """A text is split once, not once for each of its lines; the former code took minutes."""
    own = [words(6 * i, 6) for i in range(24_000)]
    rows = [(i, "\n".join(["Line of many", *own[6000 * i :][:6000], "the end of it"] * 5)) for i in range(4)]
    began = time.monotonic()
    got = dropped(spark, documents(*rows), tmp_path)
    assert time.monotonic() - began < 120
    assert [len(got[i]) for i in range(4)] == [0, 10, 10, 10]
