"""Chat formatting: exact round trips, the loss mask, merged turns."""

import hashlib

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tablevault.llm.chat_format import Template, format_chat, read_chat
from tablevault.llm.common import table
from tablevault.llm.queries import op12_relational_chat

SF = "/root/testdata/sf0.01"
FIELDS = "conv_id long, turn long, role string, text string"


def read(spark, rows, template=Template(), fields=FIELDS):
    chats = format_chat(spark.createDataFrame(rows, fields), template)
    return {r["conv_id"]: r for r in read_chat(chats, template).collect()}


def test_layout(spark):
    rows = [(1, 2, "assistant", "c</s>"), (1, 0, "user", "a"), (1, 1, "user", "\\[INST]b"),
            (1, 3, "assistant", "é")]
    row = read(spark, rows)[1]
    assert row["formatted"] == (
        "<s>[INST]user[/INST]a[SEP]\\\\[\\INST]b</s>[INST]assistant[/INST]c<\\/s>[SEP]é</s>"
    )
    data = row["formatted"].encode()
    assert [data[s:e].decode() for s, e in row["loss"]] == ["c<\\/s>", "é"]
    assert row["learned"] == ["c</s>", "é"]
    assert [tuple(t) for t in row["turns"]] == [
        ("user", "a"), ("user", "\\[INST]b"), ("assistant", "c</s>"), ("assistant", "é")
    ]


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 1, "", "x"),
        (2, 5, "assistant", ""), (None, 1, "user", "no id"), (3, 0, "[/INST]", "["),
        (4, 0, "user", "long " * 300_000),
    ]
    got = read(spark, rows)
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "first"), ("", ""), ("", ""), ("", "x")]
    assert got[2]["learned"] == [""] and got[2]["loss"][0]["start"] == got[2]["loss"][0]["end"]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "no id")]
    assert [tuple(t) for t in got[3]["turns"]] == [("[/INST]", "[")]
    assert got[4]["turns"][0]["text"] == "long " * 300_000


def test_empty_table_and_clashing_names(spark):
    assert read(spark, []) == {}
    rows = [(1, 0, "user", "a", "x", 7)]
    got = read(spark, rows, fields=FIELDS + ", turns string, id long")
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "a")]


def test_text_of_another_template_is_not_read(spark):
    chats = spark.sql("SELECT 'plain' formatted, CAST(NULL AS array<struct<start:int,end:int>>) loss")
    assert tuple(read_chat(chats).select("turns", "learned").first()) == (None, None)


def test_template_is_checked():
    for bad in ("x", "a\\b", "</s>"):
        with pytest.raises(ValueError):
            Template(start=bad)
    with pytest.raises(ValueError):
        Template(between="<x[y")


pieces = st.sampled_from(
    ["<s>", "</s>", "[INST]", "[/INST]", "[SEP]", "\\", "<", "[", "]", "/", "s>", "é", "\n", "a"]
)
texts = st.lists(pieces, max_size=8).map("".join)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>"]), texts), min_size=1, max_size=40))
def test_round_trip(spark, turns):
    # Ten conversations in a job.
    rows = [(i // 4, i, role, text) for i, (role, text) in enumerate(turns)]
    got = read(spark, rows)
    for conv in {r[0] for r in rows}:
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert [tuple(t) for t in got[conv]["turns"]] == own
        assert got[conv]["learned"] == [t for role, t in own if role == "assistant"]


def test_query(spark):
    rows = {}
    for r in table(spark, SF, "conversations").orderBy("turn").collect():
        rows.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    same = "</s>[INST] ok [/INST]"
    rows[-1] = [("user", same), ("assistant", same)]
    got = op12_relational_chat(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        turns = rows[r["conv_id"]]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == brute.sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), brute.sha(learned))


def test_no_python_runs(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], FIELDS).where(F.col("conv_id") > 0)
    plan = read_chat(format_chat(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
