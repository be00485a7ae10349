"""Fingerprints, languages, tokens, shards and archives."""

import base64
import hashlib

import brute
import pytest
from conftest import words
from pyspark.sql import functions as F

from tablevault.llm import bpe, language, sharding, warc
from tablevault.llm import queries as Q
from tablevault.llm.components import components
from tablevault.llm.simhash import fingerprint, near_duplicates

SF = "/root/testdata/sf0.001"


def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def test_near_duplicates_of_all_documents(spark):
    got = {r[0]: tuple(r)[1:] for r in Q.op3_segment_popcounts(spark, SF).collect()}
    assert got == brute.near_duplicates(texts(spark))


def test_near_duplicates_of_odd_texts(documents):
    base = words(0, 400)
    rows = [(i, base + f" tail{i}") for i in range(8)] + [(20, None), (21, " "), (22, "One two"), (23, "ONE two")]
    got = near_duplicates(documents(*rows, (20, None)))
    found = {r["doc_id"]: (f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in got.collect()}
    assert found == brute.near_duplicates(rows) and got.count() == 13
    assert near_duplicates(documents()).collect() == []


def test_fingerprint_of_a_text_in_several_chunks(monkeypatch):
    from tablevault.llm import simhash

    text = words(0, 500).encode()
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 40)
    assert fingerprint(text) == whole
    assert fingerprint(b"a" * 100 + b" b c") == fingerprint(b"A" * 100 + b"\n\nb  c ")


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)] + [(7, 7)]
    links = spark.createDataFrame(chain + star, "u long, v long")
    got = dict(components(links).collect())
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[i] for i in range(1, 60)} == {1}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    from tablevault.llm import components as module

    monkeypatch.setattr(module, "_small_star", None)
    links = spark.createDataFrame([(1, 5), (6, 1), (2, 9), (9, 2)], "u long, v long")
    assert dict(components(links).collect()) == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2}


def test_rows_that_copies_take_end_before_the_joins(spark, monkeypatch):
    from tablevault.llm import simhash

    found, kept = {}, simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, label: found.setdefault(label, kept(df, label)))
    copies = [(1 << 40) ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    far = [0x5A5A5A5A5A5A5A50 ^ 3, 0x5A5A5A5A5A5A5A50 ^ 12]  # linked with each other alone
    points = spark.createDataFrame([(fp,) for fp in copies + far], "fp long")
    got = dict(simhash.classes(points).collect())
    assert {got[fp] for fp in copies} == {min(copies)} and {got[fp] for fp in far} == {min(far)}
    assert "hub" in found["cells"].columns and found["open"].isEmpty()


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.op7_bitmask_filters(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    held = got.where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))
    ).first()
    assert held[0] > 0.98 and held[1] > 100
    assert got.where("score < 0 OR score > 1").count() == 0


def test_languages_of_odd_texts(documents):
    filters = language.LanguageFilters.built({"aa": language._grams(["abc"]).__next__()[0].tolist()})
    docs = documents((1, None), (2, ""), (3, "12 ! 34"), (4, "ABC"), (5, "日本")).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, filters).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "aa", "aa"]
    assert got[4][1] == 1 and got[5][1] == 0
    empty = language.fit(documents((1, None), (2, "x", None)))
    assert {r["lang_pred"] for r in language.predict(documents((1, "a")), empty).collect()} == {"und"}


def test_filters_of_more_than_64_languages():
    grams = {f"l{i}": [i * 1000 + 1] for i in range(130)}
    filters = language.LanguageFilters.built(grams)
    import numpy as np

    hits = filters.hits(np.array([77001], np.uint64), np.zeros(1, np.int64), 1)
    assert hits[0].argmax() == 77 and hits.sum() == 1


def test_tokens_as_the_reference_library(spark, documents):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = [
        None, "", " ", "\n\n  x", "it's we'LL  don't", "a  b 　 c", "é日本語😀🏽 ñandú",
        "<|endoftext|>", "x" * 300, "1234567 ½ ²", "\t\r\n \x0b\x1c\x85end", "é ​﻿",
    ]
    rows = [(i, t) for i, t in enumerate(odd)] + [(1000 + d, t) for d, t in texts(spark)[:60]]
    vocabulary = bpe.Vocabulary.read(path)
    tokens = bpe.encode(documents(*rows), vocabulary, public_tokenizers.PATTERN, most_frequent=50)
    got = {r["doc_id"]: r for r in bpe.decode(tokens, vocabulary).collect()}
    for doc, text in rows:
        assert got[doc]["ids"] == reference.encode_ordinary(text or ""), text
        assert bytes(got[doc]["decoded"]) == (text or "").encode()


def test_words_that_are_tokens_and_words_of_any_length(documents):
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {b"xyz": 256, b"ab": 257, b"ba": 258, b"abab": 259}
    reference = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    texts = ["xyz xyza", "ab" * 700 + "a xyz", "ba" * 100_000, "", "aba " * 9, "é" * 600]
    rows = list(enumerate(texts))
    for frequent in (0, 2):
        found = bpe.encode(
            documents(*rows).coalesce(1), bpe.Vocabulary.of(ranks), r"\S+", most_frequent=frequent
        )
        got = {r["doc_id"]: r["ids"] for r in found.collect()}
        for doc, text in rows:
            assert got[doc] == reference.encode_ordinary(text), text[:20]


def test_decoding_of_odd_lists(spark):
    vocabulary = bpe.Vocabulary.of({bytes([b]): b for b in range(256)} | {b"ab": 256})
    rows = spark.createDataFrame([([97, 256],), ([],), (None,), ([9999],)], "ids array<int>")
    got = [r["decoded"] and bytes(r["decoded"]) for r in bpe.decode(rows, vocabulary).collect()]
    assert got == [b"aab", bytearray(b""), None, None]
    with pytest.raises(ValueError):
        bpe.Vocabulary.of({b"a": 0})


def test_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = Q.op6_virtual_slots(spark, "/root/testdata/sf0.01").collect()
    want = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    import zlib

    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len(t) + 1, zlib.crc32(t)) for d, t in want.items()
    }
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    assert max(loads) <= 1.02 * min(loads)
    for s in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_slot_map_is_edited_not_dealt_anew(spark, documents, tmp_path):
    docs = documents(*[(i, "x" * (i % 50)) for i in range(600)], (None, None))
    rows = sharding.with_slots(docs, 128)
    first = sharding.slot_map(sharding.slot_sizes(rows, 128), 4)
    first = sharding.store_map(spark, str(tmp_path / "map"), 1, first)
    second = sharding.rebalanced(first, 5)
    second = sharding.store_map(spark, str(tmp_path / "map"), 2, second)
    before = {r["virtual_slot"]: r["shard"] for r in first.collect()}
    after = {r["virtual_slot"]: r["shard"] for r in second.collect()}
    assert set(before) == set(after) == set(range(128))
    moved = {s for s in before if before[s] != after[s]}
    assert {after[s] for s in moved} == {4} and len(moved) < 45
    loads = {r["shard"]: r["b"] for r in second.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert max(loads.values()) <= 1.6 * min(loads.values())
    assert sharding.shard(documents()).collect() == []


def test_archives_round_trip(spark, tmp_path):
    rows = [
        (1, "http://a/ b", "<p>one</p>" * 50), (2, "http://b", None), (3, None, ""),
        (4, "http://é", "<p>one</p>" * 50), (None, "http://n", "<p>one</p>" * 50),
        (5, "http://c", "a\r\n\r\nb\x00" * 9),
    ] + [(100 + i, f"http://m/{i}", f"<html>{words(i * 50, 60)}</html>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("hex", F.lit(1))
    records = warc.with_record_types(pages)
    path = f"file://{tmp_path}/archive"
    files = warc.write_archives(records.repartition(3), path)
    files = spark.createDataFrame(files.collect(), files.schema)
    got = {r["id"]: r for r in warc.read_archives(files).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        assert got[page]["payload_bytes"] == len(data)
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if got[page]["record_type"] == "response":
            assert bytes(got[page]["payload"]) == data
    assert (got[4]["record_type"], got[4]["refers_to"]) == ("revisit", 1)
    assert (got[3]["record_type"], got[3]["refers_to"]) == ("revisit", 2)
    assert got[None]["refers_to"] == 1 and got[1]["record_type"] == "response"


def test_an_archive_is_a_dictionary_and_a_frame_for_each_record(spark, tmp_path):
    import struct

    import zstandard

    rows = [(i, f"http://m/{i}", f"<html>{words(i * 50, 60)}</html>") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.with_record_types(pages).coalesce(1)
    file, count, size = warc.write_archives(records, f"file://{tmp_path}/w").first()
    with open(file.removeprefix("file://"), "rb") as f:
        data = f.read()
    assert (count, size) == (80, len(data))
    magic, length = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_MAGIC == 0x184D2A5D and length > 0
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + length])
    at, starts = 8 + length, []
    while at < len(data):
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        record = frame.decompress(data[at:])
        assert frame.eof and record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
        starts.append(at)
        at = len(data) - len(frame.unused_data)
    assert len(starts) == 80
    # Any record alone, from where it starts, and not without the dictionary.
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert b"WARC-Record-ID: <urn:page:" in reader.decompress(data[starts[41] :])
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(data[starts[41] :])


def test_archives_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    files = warc.write_archives(warc.with_record_types(pages), f"file://{tmp_path}/none")
    assert files.collect() == []
    files = spark.createDataFrame([], files.schema)
    assert warc.read_archives(files).collect() == []


def test_damaged_archives_are_reported(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "text" * 100)], "page_id long, url string, html string")
    files = warc.write_archives(warc.with_record_types(pages).coalesce(1), f"file://{tmp_path}/w")
    files = spark.createDataFrame(files.collect(), files.schema)
    name = files.first()["file"].removeprefix("file://")
    with open(name, "rb") as f:
        data = f.read()
    with open(name, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(files).collect()
