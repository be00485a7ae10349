"""Removal of lines that recur across documents, by a tree of log templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import release, stored, text_or_empty

WILDCARD = "<*>"
DEPTH = 3  # leading tokens that the tree branches on, below the number of tokens
LEAST_TOKENS = 3
LEAST_DOCUMENTS = 4
# Lines of so many tokens or characters (for scripts without spaces) are passages, which recur
# as they are if two documents have them.
LONG_TOKENS = 50
LONG_CHARS = 300
LEAST_LONG = 2
SIMILARITY = 0.8
EXACT, LONG = "exact", "long"  # tell the hashes of unmasked lines from others
# White space between tokens that is not one space.
_WIDE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _lines_at(text: Column, at: Column) -> Column:
    """A text's lines at some places; the text is split once, not for each of them."""
    held = F.transform(
        F.array(lines_of(text)), lambda lines: F.transform(at, lambda i: F.get(lines, i))
    )
    return held[0]


def _spaced(line: Column) -> Column:
    """A line's tokens with one space between them; most lines are so already."""
    return F.trim(F.regexp_replace(line, _WIDE, " "))


def _masked(spaced: Column) -> Column:
    """The same, with every token that holds a digit generalised.

    The pattern begins at tokens alone, so tokens of any length are read once.
    """
    general = F.regexp_replace(spaced, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", WILDCARD)
    return F.when(spaced.rlike("[0-9]"), general).otherwise(spaced)


def _tokens(spaced: Column) -> Column:
    """The number of tokens."""
    gaps = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", 0).otherwise(gaps + 1)


def _words(spaced: Column, tokens: Column) -> Column:
    """How many of the tokens, whose number is known, are no wildcard."""
    apart = F.concat(F.lit(" "), F.replace(spaced, F.lit(" "), F.lit("  ")), F.lit(" "))
    other = F.replace(apart, F.lit(f" {WILDCARD} "), F.lit(""))
    wild = (F.octet_length(apart) - F.octet_length(other)) / (len(WILDCARD) + 2)
    return tokens - F.when(spaced.contains(WILDCARD), wild).otherwise(0)


def _leaf(tokens: Column, leading: Column) -> Column:
    return F.xxhash64(tokens, F.substring_index(leading, " ", DEPTH))


def _described(lines: DataFrame, least_tokens: int, short_lines: bool) -> DataFrame:
    """`lines` (line, ...) with the leaf and masked hash of each that has enough tokens without digits.

    The leaf is the place in the tree: the number of tokens and the leading ones. With
    `short_lines`, other lines that have a token are described too, unmasked: their hash is
    that of the tokens as they are, and also their leaf, so each has a leaf of its own. Long
    lines are described once more, unmasked, with the inverse of their hash as the leaf.
    A row is a line, so all of this is generated code.
    """
    spaced = lines.withColumn("spaced", _spaced(F.col("line")))
    counted = spaced.withColumns(
        {"general": _masked(F.col("spaced")), "tokens": _tokens(F.col("spaced"))}
    ).withColumn("enough", _words(F.col("general"), F.col("tokens")) >= least_tokens)
    enough, some = F.col("enough"), F.col("tokens") > 0
    long = (F.col("tokens") >= LONG_TOKENS) | (F.char_length("line") >= LONG_CHARS)
    leaf = F.when(enough, _leaf(F.col("tokens"), F.col("general")))
    masked = F.when(enough, F.xxhash64("general"))
    if short_lines:
        exact = F.xxhash64("spaced", F.lit(EXACT))
        leaf, masked = leaf.when(some, exact), masked.when(some, exact)
    kept = [c for c in lines.columns if c != "line"]
    found = counted.select(
        *kept,
        leaf.alias("own_leaf"),
        masked.alias("own_masked"),
        F.when(long & some, F.xxhash64("spaced", F.lit(LONG))).alias("passage"),
    )
    entry = F.array(
        F.struct(F.col("own_leaf").alias("leaf"), F.col("own_masked").alias("masked")),
        F.struct(F.bitwise_not("passage").alias("leaf"), F.col("passage").alias("masked")),
    )
    return found.select(*kept, F.inline(entry)).where("leaf IS NOT NULL")


def _general_lines(
    docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame
) -> DataFrame:
    """(leaf, masked, tokens) of the lines of `docs` at the places `wanted` (doc, content, at).

    Only documents that hold a wanted line are split, and only such lines are masked.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        column(id_col).alias("doc"), F.xxhash64(text).alias("content"), text.alias("text")
    )
    # Each document meets one row, which lists its places, so nothing is sorted.
    listed = wanted.groupBy(F.col("doc").alias("of"), F.col("content").alias("held")).agg(
        F.collect_set("at").alias("places")
    )
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("content") == F.col("held"))
    lines = rows.join(listed.hint("shuffle_hash"), same).select(
        F.explode(_lines_at(F.col("text"), F.col("places"))).alias("line")
    )
    # A generator keeps the masking from being repeated in what reads it.
    general = lines.select(F.explode(F.array(_masked(_spaced(F.col("line"))))).alias("general"))
    return general.distinct().select(
        _leaf(_tokens(F.col("general")), F.col("general")).alias("leaf"),
        F.xxhash64("general").alias("masked"),
        F.split("general", " ").alias("tokens"),
    )


def _long() -> Column:
    """Whether a line is described as a long one, unmasked."""
    return F.col("leaf") == F.bitwise_not(F.col("masked"))


def _held(places: DataFrame, copies: DataFrame | None) -> DataFrame:
    """`places` with the `holder` of each: the document, for long lines its group of copies."""
    if copies is None:
        return places.withColumn("holder", F.col("doc"))
    one = copies.groupBy("doc").agg(F.min("group").alias("holder"))
    moved = stored(one.where("holder IS NOT NULL AND NOT holder <=> doc"), "copies")
    moved = moved.withColumnRenamed("doc", "of")
    own = places.where(_long()).join(moved, F.col("doc").eqNullSafe(F.col("of")), "left").drop("of")
    own = own.withColumn("holder", F.coalesce("holder", "doc"))
    return own.unionByName(places.where(~_long()).withColumn("holder", F.col("doc")))


def line_places(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    least_tokens: int = LEAST_TOKENS,
    short_lines: bool = False,
) -> DataFrame:
    """(doc, content, at, leaf, masked) of each line that takes part; no texts."""
    rows = docs.select(
        column(id_col).alias("doc"),
        F.xxhash64(text_or_empty(text_col)).alias("content"),
        F.posexplode(lines_of(text_or_empty(text_col))).alias("at", "line"),
    )
    return _described(rows, least_tokens, short_lines)


def _agreeing(groups: DataFrame, similarity: float) -> DataFrame:
    """(leaf, masked, template) of the lines that agree with the constants of their group."""
    held = groups.select("group", "docs", "total", F.posexplode("tokens").alias("at", "token"))
    # Of two tokens that each hold half of the lines, the greater is the constant.
    constants = (
        held.groupBy("group", "at", "token")
        .agg(F.sum("docs").alias("docs"), F.max("total").alias("total"))
        .where(2 * F.col("docs") >= F.col("total"))
        .groupBy("group", "at")
        .agg(F.max("token").alias("token"))
    )
    size = F.size("tokens").alias("n")
    found = (
        groups.select("group", "leaf", "masked", size, F.posexplode("tokens").alias("at", "token"))
        .join(constants, ["group", "at", "token"], "left_semi")
        .groupBy("group", "leaf", "masked")
        .agg((F.count(F.lit(1)) / F.max("n")).alias("agrees"))
        .where(F.col("agrees") >= similarity)
        .select("leaf", "masked", F.xxhash64("group", F.lit(WILDCARD)).alias("template"))
    )
    return stored(found, "agreeing")


def _resplit(groups: DataFrame, agreeing: DataFrame, least_documents: int) -> DataFrame:
    """The lines that do not agree, in finer groups that may yet hold a template.

    Each row has its group's `total` of documents and number `n` of lines.
    Each line goes with the most frequent (place, token) it has that some other line of the
    group has not. Lines without a token that `least_documents` lines share stay together if
    others left their group, and are done otherwise, so every round makes groups smaller.
    """
    rest = groups.join(agreeing, ["leaf", "masked"], "left_anti").drop("total")
    rest = rest.withColumnRenamed("n", "before")
    totals = rest.groupBy("group").agg(F.sum("docs").alias("total"), F.count(F.lit(1)).alias("n"))
    totals = totals.where((F.col("total") >= least_documents) & (F.col("n") > 1))
    rest = stored(rest.join(totals, "group"), "rest-lines")
    held = rest.select("group", "leaf", "masked", "docs", "total", F.posexplode("tokens").alias("at", "token"))
    frequent = (
        held.groupBy("group", "at", "token")
        .agg(F.sum("docs").alias("held"), F.max("total").alias("total"))
        .where((F.col("held") >= least_documents) & (F.col("held") < F.col("total")))
        .select("group", "at", "token", "held")
    )
    best = F.max(F.struct("held", (-F.col("at")).alias("back"), "token")).alias("best")
    chosen = held.join(frequent, ["group", "at", "token"]).groupBy("leaf", "masked").agg(best)
    split = rest.join(chosen, ["leaf", "masked"], "left").where("best IS NOT NULL OR n < before")
    finer = split.select(
        "leaf", "masked", "tokens", "docs", F.xxhash64("group", "best.back", "best.token").alias("group")
    )
    finer = stored(finer, "finer-lines")
    several = finer.groupBy("group").agg(F.sum("docs").alias("total"), F.count(F.lit(1)).alias("n"))
    several = several.where((F.col("total") >= least_documents) & (F.col("n") > 1))
    return stored(finer.join(several, "group"), "open-lines")


def recurring_templates(
    docs: DataFrame,
    places: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    least_tokens: int = LEAST_TOKENS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Lines, as (leaf, masked), whose template recurs, and the first document that has it.

    `places` are the `line_places` of `docs`, stored, with the `holder` that each counts for. Lines are filed in a tree of fixed
    depth: by their number of tokens, then by the first `DEPTH` tokens. Tokens with digits
    are variable. In a leaf, a place is constant if one token holds it in at least half of
    the leaf's lines (counted once per document), else it is variable; lines that agree with
    the constants in `similarity` of all tokens form a template. The leaf's other lines are
    split by the most frequent token that each has, and each part is looked at like a leaf,
    until no part of `least_documents` documents and several lines is left. A line that fits
    no part's constants is a template of its own. A template recurs if at least
    `least_documents` documents hold it, a long line, unmasked, if `LEAST_LONG` do. Columns:
    leaf, masked, template, first (least id) and documents.
    """
    # A line counts once per document, however often it stands there.
    in_docs = places.select("leaf", "masked", F.col("holder").alias("doc")).distinct()
    variants = stored(
        in_docs.groupBy("leaf", "masked").agg(
            F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first")
        ),
        "lines",
    )

    # Leaves that may hold a template of several variants; only their lines' texts are kept.
    # Unmasked lines are alone in their leaves, so their texts are not needed.
    leaves = stored(
        variants.groupBy("leaf")
        .agg(F.sum("docs").alias("total"), F.count(F.lit(1)).alias("n"))
        .where((F.col("total") >= least_documents) & (F.col("n") > 1)),
        "leaves",
    )
    release(docs.sparkSession)
    # The text of a variant is read at one of its places.
    place = F.min(F.struct("doc", "content", "at")).alias("place")
    wanted = places.join(leaves.select("leaf"), "leaf", "left_semi").groupBy("leaf", "masked").agg(place)
    texts = _general_lines(docs, id_col, text_col, wanted.select("place.*"))
    lines = texts.join(variants.drop("first").join(leaves, "leaf"), ["leaf", "masked"])
    groups = stored(lines.withColumn("group", F.col("leaf")), "open-lines")
    release(docs.sparkSession)
    agreeing = [_agreeing(groups, similarity)]
    while not (groups := _resplit(groups, agreeing[-1], least_documents)).isEmpty():
        release(docs.sparkSession)
        agreeing.append(_agreeing(groups, similarity))
    general = reduce(DataFrame.unionByName, agreeing)
    # A document may hold several variants of one template, so those are counted anew.
    recount = (
        places.join(general, ["leaf", "masked"])
        .select("template", F.col("holder").alias("doc"))
        .distinct()
        .groupBy("template")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"))
    )
    least = F.when(_long(), min(LEAST_LONG, least_documents)).otherwise(least_documents)
    recurs = F.col("docs") >= least
    single = variants.where(recurs).join(general, ["leaf", "masked"], "left_anti")
    columns = ["leaf", "masked", "template", "docs", "first"]
    return (
        general.join(recount, "template")
        .where(recurs)
        .select(columns)
        .unionByName(single.withColumn("template", F.col("masked")).select(columns))
        .withColumnRenamed("docs", "documents")
    )


def drop_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    least_tokens: int = LEAST_TOKENS,
    similarity: float = SIMILARITY,
    short_lines: bool = False,
    copies: DataFrame | None = None,
) -> DataFrame:
    """All columns of `docs`, with recurring lines dropped from the text.

    Lines are those of `recurring_templates`; each stays in the document of the least id
    that holds its template, so that no content is lost altogether, and goes from all
    others. Adds `dropped_lines`, the sorted line numbers from 0. Defined cases: a NULL text
    stays NULL; lines without a token always stay; lines of fewer than `least_tokens` tokens
    without digits stay unless `short_lines`, and then recur only as they are, unmasked; rows
    that share an id count as one document and keep the same lines; rows with a NULL id
    never count as first. `copies` (doc, group) makes long lines count once per group of copies
    and stay in the whole of the first group, so that copies remain alike for a later stage,
    which is to drop them; `group` is an id of one of the copies. A column named `dropped_lines` in `docs` is replaced.
    """
    places = stored(line_places(docs, id_col, text_col, least_tokens, short_lines), "line-places")
    places = _held(places, copies)
    release(docs.sparkSession)
    templates = stored(
        recurring_templates(docs, places, id_col, text_col, least_documents, least_tokens, similarity),
        "templates",
    )
    release(docs.sparkSession)
    kept = [c for c in docs.columns if c != "dropped_lines"]
    rows = docs.select(
        F.struct(*[column(c) for c in kept]).alias("row"),
        column(id_col).alias("doc"),
        F.xxhash64(text_or_empty(text_col)).alias("content"),
    )
    gone = (
        places.join(templates, ["leaf", "masked"])
        .where(~F.col("holder").eqNullSafe(F.col("first")))
        .groupBy("doc", "content")
        .agg(F.array_sort(F.collect_set("at")).alias("gone"))
        .select(F.col("doc").alias("gone_doc"), F.col("content").alias("gone_content"), "gone")
    )
    same = F.col("doc").eqNullSafe(F.col("gone_doc")) & (
        F.col("content") == F.col("gone_content")
    )
    lines = lines_of(column(text_col))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    left = _lines_at(column(text_col), F.array_except(every, "gone"))
    joined = rows.join(gone.hint("shuffle_hash"), same, "left").select("row.*", "gone")
    return joined.withColumns(
        {
            text_col: F.when(F.col("gone").isNull(), column(text_col)).otherwise(
                F.array_join(left, "\n")
            ),
            "dropped_lines": F.coalesce("gone", F.array().cast("array<int>")),
        }
    ).drop("gone")
