"""Linking mentions to coded vocabularies.

A linker takes mentions (id, key) and terms and returns id and codes.  Each has
an equi-join at its core: on the normalised key, a token, the first token, a
length band, or a slice of the text; what remains is a condition on few pairs.
Vocabularies may be of any size: none is broadcast by hand, Spark decides by
what it knows of them.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def exact_link(mentions: DataFrame, terms: DataFrame) -> DataFrame:
    """id, codes: all codes of the term that equals the key, sorted; [] if none does."""
    codes = terms.groupBy("term").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return mentions.join(codes, mentions["key"] == codes["term"], "left").select(mentions["id"], F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))


def tiered_link(mentions: DataFrame, tiers: list[tuple[str, object]]) -> DataFrame:
    """id, codes, tier: of the first linker that finds codes.

    A linker only gets what the ones before it left.
    """
    rest, found = mentions, None
    for name, linker in tiers:
        hit = linker(rest).filter(F.size("codes") > 0).withColumn("tier", F.lit(name))
        found = hit if found is None else found.unionByName(hit)
        rest = rest.join(hit.select("id"), "id", "left_anti")
    none = rest.select("id", F.array().cast("array<string>").alias("codes"), F.lit("none").alias("tier"))
    return found.unionByName(none)


def subset_link(queries: DataFrame, titles: DataFrame, least: int = 2) -> DataFrame:
    """id, code: of the titles that hold all of a query's tokens, the one with the
    fewest others, then the least code.  Columns: id, tokens; code, tokens.

    Equal token sets collapse on both sides.  A set is looked up by its token that the
    fewest titles have; the others are compared in the row.
    """
    sets = lambda t: F.array_sort(F.array_distinct(t))
    asked = queries.filter(F.size("tokens") >= least).select("id", sets("tokens").alias("q"))
    held = titles.select("code", sets("tokens").alias("h")).groupBy("h").agg(F.min("code").alias("code"))
    spread = held.select(F.explode("h").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c"))
    distinct = asked.select("q").distinct()
    # a query with a token that no title has drops out: its count of known tokens falls short
    ranked = distinct.select("q", F.explode("q").alias("t")).join(spread, "t").groupBy("q").agg(F.min_by("t", F.struct("c", "t")).alias("rare"), F.count(F.lit(1)).alias("known")).filter(F.col("known") == F.size("q"))
    listed = held.select("h", "code", F.explode("h").alias("rare"))
    whole = ranked.join(listed, "rare").filter(F.size(F.array_except("q", "h")) == 0)
    best = whole.groupBy("q").agg(F.min_by("code", F.struct(F.size("h") - F.size("q"), "code")).alias("code"))
    return asked.join(best, "q").select("id", "code")


def prefix_link(cores: DataFrame, products: DataFrame, tiers: Column, most: int = 3) -> DataFrame:
    """id, codes: the best ``most`` codes of the products that begin with the core and a
    blank, by tier, length and text.  Columns: id, core; text, code.

    Each product meets cores by its own beginnings, one for each of its blanks.
    """
    words = F.split("text", " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    p = products.filter(F.contains("text", F.lit(" "))).withColumn("tier", tiers).select("text", "code", "tier", F.explode(heads).alias("core"))
    best = p.groupBy("core", "code").agg(F.min(F.struct("tier", F.length("text").alias("l"), "text")).alias("k"))
    few = best.join(cores.select("core").distinct(), "core", "left_semi")
    ranked = few.withColumn("r", F.row_number().over(Window.partitionBy("core").orderBy("k", "code"))).filter(F.col("r") <= most)
    codes = ranked.groupBy("core").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "code"))), lambda x: x["code"]).alias("codes"))
    return cores.join(codes, "core").select("id", "codes")


def overlap_link(queries: DataFrame, products: DataFrame) -> DataFrame:
    """id, code: among the products with the query's first token, the one that shares
    most other tokens, then the least code.  Columns: id, tokens; code, tokens.

    Equal token lists collapse; the rest meet by first and other token, so what shares
    nothing never meets.
    """
    head, others = F.element_at("tokens", 1), F.array_sort(F.array_distinct(F.slice("tokens", F.lit(2), F.size("tokens"))))
    q = queries.filter(F.size("tokens") > 1).select("id", head.alias("h"), others.alias("a"))
    p = products.filter(F.size("tokens") > 1).select("code", head.alias("h"), others.alias("b")).groupBy("h", "b").agg(F.min("code").alias("code"))
    met = q.select("h", "a").distinct().withColumn("t", F.explode("a")).join(p.select("h", "code", F.explode("b").alias("t")), ["h", "t"])
    shared = met.groupBy("h", "a", "code").agg(F.count(F.lit(1)).alias("o"))
    best = shared.groupBy("h", "a").agg(F.min_by("code", F.struct(-F.col("o"), "code")).alias("code"))
    return q.join(best, ["h", "a"]).select("id", "code")


#: A run of word characters, or one other character.
SEGMENT = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]"


def phrase_occurrences(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """doc_id, phrase, start: every occurrence of a lower-case phrase with no word
    character next to it, overlapping ones, too.

    Texts and phrases are cut into segments, so an occurrence is as many segments
    in a row as the phrase has; for each of the few lengths these runs meet the
    lexicon in an equi-join.  No text is carried along.
    """
    cut = lambda c: F.regexp_extract_all(c, F.lit(SEGMENT), F.lit(0))
    lengths = sorted(r[0] for r in lexicon.select(F.size(cut(F.col("phrase"))).alias("k")).distinct().collect() if r[0])  # bounded by the longest phrase
    w = Window.partitionBy("doc_id").orderBy("pos")
    word = lambda c: F.coalesce(F.col(c).rlike("^[\\p{L}\\p{N}_]"), F.lit(False))
    segments = docs.select("doc_id", F.posexplode(cut(F.col("text"))).alias("pos", "seg"))
    placed = segments.withColumn("start", F.sum(F.length("seg")).over(w) - F.length("seg")).withColumn("is_word", word("seg"))
    free_start = F.col("is_word") | ~F.coalesce(F.lag("is_word").over(w), F.lit(False))
    runs = []
    for k in lengths:
        own = F.concat("seg", *(F.lead("seg", j).over(w) for j in range(1, k)))
        free_end = (F.lead("is_word", k - 1).over(w) if k > 1 else F.col("is_word")) | ~F.coalesce(F.lead("is_word", k).over(w), F.lit(False))
        runs.append(F.when(free_start & free_end, F.lower(own)))
    spread = placed.select("doc_id", "start", F.array(*runs).alias("runs")).select("doc_id", "start", F.explode("runs").alias("phrase")) if runs else placed.select("doc_id", "start", F.col("seg").alias("phrase")).limit(0)
    return spread.join(lexicon.select("phrase").distinct(), "phrase")


def containment_link(mentions: DataFrame, terms: DataFrame, least: int = 5) -> DataFrame:
    """id, term: the longest term of ``least`` characters or more that stands in the key
    as whole words, then the first by code point.  Columns: id, key; term.

    Keys grow when their runs of words are spelled out, by more than Spark expects; a semi
    join can't broadcast that side.
    """
    words = lambda c: F.split(c, " ")
    runs = F.expr("transform(flatten(transform(sequence(0, size(ws) - 1), i -> transform(sequence(i, size(ws) - 1), j -> slice(ws, i + 1, j - i + 1)))), x -> array_join(x, ' '))")
    pieces = mentions.withColumn("ws", words("key")).select("id", F.explode(F.array_distinct(runs)).alias("term")).filter(F.length("term") >= least)
    return pieces.join(terms.select("term").distinct(), "term", "left_semi").groupBy("id").agg(F.min_by("term", F.struct(-F.length("term"), "term")).alias("term"))


@F.pandas_udf(DoubleType())
def _ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def fuzzy_link(mentions: DataFrame, terms: DataFrame, threshold: float = 0.86) -> DataFrame:
    """id, term, ratio: the most similar term at ``threshold`` or above, the first on ties.

    A ratio of t needs lengths whose quotient is t / (2 - t) or more; lengths in
    narrow bands meet in an equi-join.  It is at most the share of characters that the
    two have in common, each as often as in both; only pairs within that bound go to
    Python.  Equal keys are compared once.  Columns: id, key; term.
    """
    least = threshold / (2 - threshold)
    # the n-th copy of a character is a token of its own, so sets of them intersect as multisets
    letters = lambda c: F.expr(f"transform(array_sort(split({c}, '')), (x, i) -> concat(x, i - array_position(array_sort(split({c}, '')), x)))")
    t = terms.select("term").distinct().withColumn("n", F.length("term")).withColumn("tl", letters("term"))
    keys = mentions.select("key").distinct().withColumn("kl", letters("key"))
    m = keys.withColumn("n", F.explode(F.sequence(F.ceil(F.length("key") * least).cast("int"), F.floor(F.length("key") / least).cast("int"))))
    near = m.join(t, "n").filter(2 * F.size(F.array_intersect("kl", "tl")) >= threshold * (F.size("kl") + F.size("tl")))
    found = near.select("key", "term").withColumn("ratio", _ratio("key", "term")).filter(F.col("ratio") >= threshold)
    return mentions.join(found, "key").groupBy("id").agg(F.min_by("term", F.struct(-F.col("ratio"), "term")).alias("term"), F.max("ratio").alias("ratio"))


def title_subset_best(pairs: DataFrame, special: Column, is_category: Column) -> DataFrame:
    """id, code: among the titles that hold a query's tokens, ordinary chapters first, then
    finer codes, then fewer other words, then the code.  Columns: id, code, extra."""
    return pairs.groupBy("id").agg(F.min_by("code", F.struct(special.cast("int"), is_category.cast("int"), "extra", "code")).alias("code"))


def resolve_categories(linked: DataFrame, catalog: DataFrame) -> DataFrame:
    """id, code: a three-character category becomes its ``.9`` child, else the child whose
    title says unspecified, shortest first, else it stays.  Columns: id, code; code, title."""
    marks = "không đặc hiệu|không xác định|unspecified"
    parts = catalog.withColumn("category", F.substring_index("code", ".", 1)).filter(F.col("code") != F.col("category"))
    nine, said = F.col("code") == F.concat("category", F.lit(".9")), F.lower("title").rlike(marks)
    best = parts.filter(nine | said).groupBy("category").agg(F.min_by("code", F.struct((~nine).cast("int"), F.length("code"), "code")).alias("child"))
    return linked.join(best, linked["code"] == best["category"], "left").select(linked["id"], F.coalesce("child", linked["code"]).alias("code"))


def align_texts(raw: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, idx, start, end: the n-th item with a text takes that text's n-th occurrence.

    Items are (doc_id, idx, text) in the order named, ``raw`` is (doc_id, text).
    Occurrences don't overlap; case-insensitive ones serve only if no exact one is left.
    """
    items = found.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("idx")))
    joined = items.join(raw.withColumnRenamed("text", "doc_text"), "doc_id").filter(F.length("text") > 0)
    at = lambda hay, needle: F.expr(f"length(substring_index({hay}, {needle}, n))")
    placed = joined.withColumn("exact", at("doc_text", "text")).withColumn("loose", at("lower(doc_text)", "lower(text)")).withColumn("size", F.length("doc_text"))
    start = F.when(F.col("exact") < F.col("size"), F.col("exact")).when(F.col("loose") < F.col("size"), F.col("loose"))
    return placed.withColumn("start", start).filter("start IS NOT NULL").select("doc_id", "idx", "start", (F.col("start") + F.length("text")).alias("end"))


def merge_candidates(parts: DataFrame) -> DataFrame:
    """id, code, kind, score: each code once, products first, then by score.
    Columns: id, code, kind, score, ord."""
    first = parts.groupBy("id", "code").agg(F.min_by("kind", "ord").alias("kind"), F.max("score").alias("score"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy((~F.col("kind").isin("SCD", "SBD", "GPCK", "BPCK")).cast("int"), F.col("score").desc_nulls_last(), "code")))


def code_fill(linked: DataFrame, catalog: DataFrame, pattern: str) -> DataFrame:
    """id, codes: the linker's codes, else those proposed that have the form of a code and
    are in the catalog.  Columns: id, codes, proposed."""
    good = linked.filter(F.size("codes") == 0).select("id", F.explode("proposed").alias("code")).filter(F.col("code").rlike(pattern)).join(catalog.select("code").distinct(), "code", "left_semi")
    filled = good.groupBy("id").agg(F.array_sort(F.collect_set("code")).alias("more"))
    return linked.join(filled, "id", "left").select("id", F.when(F.size("codes") > 0, F.col("codes")).otherwise(F.coalesce("more", F.array().cast("array<string>"))).alias("codes"))


def title_link(keys: DataFrame, titles: DataFrame) -> DataFrame:
    """id, code: the shortest code of the title that equals the key, the first on ties.
    Columns: id, key; title, code, ord."""
    best = titles.groupBy("title").agg(F.min_by("code", F.struct(F.length("code"), "ord")).alias("code"))
    return keys.join(best, keys["key"] == best["title"]).select("id", "code")


def first_contained(keys: DataFrame, entries: DataFrame) -> DataFrame:
    """id, code: of the first entry, by ord, whose words stand in the key in a row.
    Columns: id, key; term, code, ord.  Spelled-out keys are never broadcast, see ``containment_link``."""
    runs = F.expr("transform(flatten(transform(sequence(0, size(ws) - 1), i -> transform(sequence(i, size(ws) - 1), j -> slice(ws, i + 1, j - i + 1)))), x -> array_join(x, ' '))")
    pieces = keys.withColumn("ws", F.split("key", " ")).select("id", F.explode(F.array_distinct(runs)).alias("term"))
    return pieces.join(entries.hint("merge"), "term").groupBy("id").agg(F.min_by("code", "ord").alias("code"))
