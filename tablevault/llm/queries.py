"""The queries of this package over the given tables, and the SQL they must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.llm import bpe, language, warc
from tablevault.llm.chat_format import format_chat, read_chat
from tablevault.llm.common import stored, table
from tablevault.llm.decontaminate import find_contamination
from tablevault.llm.exact_dedup import exact_dedup
from tablevault.llm.lexical_search import search
from tablevault.llm.line_dedup import drop_recurring_lines, lines_of
from tablevault.llm.prefix_trie import prefix_trie, rebuilt, turn_ids
from tablevault.llm.sharding import shard
from tablevault.llm.simhash import near_duplicates
from tablevault.llm.substring_dedup import remove_repeated_words
from tablevault.llm.suffix_dedup import remove_repeated_bytes
from tablevault.sources.scratch import scratch_path


def op1_radix_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.with_record_types(table(spark, sf_dir, "pages"))
    files = stored(warc.write_archives(records, scratch_path(spark, "warc")), "warc-files")
    found = warc.read_archives(files, payloads=False)
    return found.select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op3_segment_popcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_folded_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    tokens = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return bpe.decode(tokens, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(text, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op7_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.predict(rows, language.fit(docs)).drop("text")


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines")
    )
    return drop_recurring_lines(docs, short_lines=True).select(
        "doc_id",
        "n_lines",
        F.size("dropped_lines").cast("long").alias("n_dropped"),
        "dropped_lines",
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op10_window_hash_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_bitsliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read_chat(format_chat(rows.unionByName(added))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_rollup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_ids(table(spark, sf_dir, "conversations"))))


def queries() -> dict:
    return {
        "op1_radix_suffixes": op1_radix_suffixes,
        "op2_dictionary_warc": op2_dictionary_warc,
        "op3_segment_popcounts": op3_segment_popcounts,
        "op4_folded_merges": op4_folded_merges,
        "op5_content_sort": op5_content_sort,
        "op6_virtual_slots": op6_virtual_slots,
        "op7_bitmask_filters": op7_bitmask_filters,
        "op8_recompression": op8_recompression,
        "op9_template_tree": op9_template_tree,
        "op10_window_hash_set": op10_window_hash_set,
        "op11_bitsliced_search": op11_bitsliced_search,
        "op12_relational_chat": op12_relational_chat,
        "op13_rollup_trie": op13_rollup_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_dictionary_warc": OP2,
        "op5_content_sort": OP5,
        "op10_window_hash_set": OP10,
        "op11_bitsliced_search": OP11,
        "op12_relational_chat": OP12,
        "op13_rollup_trie": OP13,
    }


_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP5 = f"""
WITH normal AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
     groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM normal JOIN groups USING (norm)
"""

OP2 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), least AS (
    SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT)
                     // CAST(pow(32, 3 - i % 4) AS BIGINT)) % 32 AS BIGINT), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN least USING (payload)
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP10 = f"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark
), wanted AS (
    SELECT DISTINCT item, list_slice(words, i, i + n - 1) AS window_words, n
    FROM (SELECT item, words, least(len(words), 10) AS n FROM items WHERE len(words) > 0),
         LATERAL unnest(range(1, len(words) - n + 2)) AS s(i)
), docs AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), lengths AS (
    SELECT DISTINCT n FROM wanted
), windows AS (
    SELECT doc_id, i, n, list_slice(words, i, i + n - 1) AS window_words
    FROM docs, lengths, LATERAL unnest(range(1, len(words) - n + 2)) AS s(i)
), hits AS (
    SELECT doc_id, i, n, item FROM windows JOIN wanted USING (n, window_words)
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM hits, LATERAL unnest(range(i, i + n)) AS s(p) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11 = f"""
WITH docs AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), counts AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY doc_id, term
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, n_docs
), norms AS (
    SELECT doc_id, 100 - 90 + ((90 * len(terms) * n_docs) // n_terms) AS m
    FROM docs, totals WHERE len(terms) > 0
), wanted AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scores AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place,
           doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

_CONTROLS = r"'<s>|</s>|\[INST\]|\[/INST\]|\[SEP\]'"

# A turn adds its escaped text and either `[SEP]`, or the header of a new block and the end of one.
OP12 = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                     (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, lag(role) OVER turns IS NOT DISTINCT FROM role AS same,
           length(text) + length(text) - length(replace(text, '\\', ''))
               + len(regexp_extract_all(text, {_CONTROLS})) AS text_chars,
           length(role) + length(role) - length(replace(role, '\\', ''))
               + len(regexp_extract_all(role, {_CONTROLS})) AS role_chars
    FROM rows WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
               AS turns_sha256,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                               ORDER BY turn NULLS FIRST, role, text), '') AS learned,
           3 + sum(text_chars + CASE WHEN same THEN 5 ELSE 6 + role_chars + 7 + 4 END) AS formatted_chars
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole
"""

# crc32 of the ids by its bitwise rule; DuckDB has no such function.
OP13 = """
WITH RECURSIVE own AS (
    SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                              ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
    SELECT c, 0 AS digit, CAST(4294967295 AS BIGINT) AS value FROM own
    UNION ALL
    SELECT c, digit + 1, list_reduce(
        list_prepend(xor(value, CAST(ascii(substr(CAST(c AS VARCHAR), digit + 1, 1)) AS BIGINT)), range(8)),
        lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)
    FROM crc WHERE digit < length(CAST(c AS VARCHAR))
), shared AS (
    SELECT c, CAST(xor(value, CAST(4294967295 AS BIGINT)) % 4 AS BIGINT) AS h
    FROM crc WHERE digit = length(CAST(c AS VARCHAR))
), convs AS (
    SELECT own.c, list_concat(coalesce(base.turns, [])[1:h], own.turns[h + 1:]) AS turns
    FROM own JOIN shared USING (c) LEFT JOIN own AS base ON base.c = own.c - own.c % 20
), members AS (
    SELECT c, d, turns[1:d] AS prefix, d = len(turns) AS ends
    FROM convs, LATERAL unnest(range(0, len(turns) + 1)) AS s(d)
), nodes AS (
    SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ended,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE
               len(regexp_extract_all(prefix[d].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM members GROUP BY prefix, d
), children AS (
    SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children
    FROM nodes WHERE d > 0 GROUP BY ALL
), known AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, d)
), sums AS (
    SELECT prefix[1:a] AS prefix, a AS d, count(*) FILTER (n_children = 0) AS n_leaves,
           sum(saved) AS saved_tokens
    FROM known, LATERAL unnest(range(0, d + 1)) AS s(a) GROUP BY ALL
)
SELECT known.conv_id, known.d AS depth, parent.conv_id AS parent_conv_id, known.n_convs,
       known.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(known.ended) AS ends_sha256
FROM known JOIN sums ON known.prefix = sums.prefix AND known.d = sums.d
LEFT JOIN nodes AS parent ON known.d > 0 AND parent.d = known.d - 1 AND parent.prefix = known.prefix[1:known.d - 1]
"""
