"""Adding lexicon matches to a document's mentions, and joining broken ones.

Matches are found on the original text, so their order is fixed before the fold
and a document's array of mentions can be folded natively.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MENTION = "struct<s:int,e:int,type:string,tags:array<string>,codes:array<string>>"


def _touches(x: Column, y: Column) -> Column:
    return (F.greatest(x["s"], y["s"]) < F.least(x["e"], y["e"])) & (x["type"] == y["type"])


def _holds(big: Column, small: Column) -> Column:
    """Strictly contains."""
    return (big["s"] <= small["s"]) & (small["e"] <= big["e"]) & (big["e"] - big["s"] > small["e"] - small["s"])


def inject_terms(mentions: Column, matches: Column) -> Column:
    """Adds coded matches, in order, to an array of mentions.

    A match that is there already is skipped; it replaces mentions of its type
    that it strictly contains; any other overlap with its type leaves all as it was.
    """

    def step(own: Column, m: Column) -> Column:
        same = F.exists(own, lambda x: (x["s"] == m["s"]) & (x["e"] == m["e"]) & (x["type"] == m["type"]))
        clash = F.exists(own, lambda x: _touches(x, m) & ~_holds(m, x))
        rest = F.filter(own, lambda x: ~(_touches(x, m) & _holds(m, x)))
        return F.when(same | clash, own).otherwise(F.concat(rest, F.array(m)))

    return F.aggregate(matches, mentions, step)


def extend_phrases(mentions: Column, matches: Column, safe: Column, merged_type: str = "SYM") -> Column:
    """Widens mentions to matches that strictly contain all mentions of their type they touch.

    A match that touches none is added only if its text is in the array ``safe``
    (its codes' first entry holds the text).  Tags are united for ``merged_type`` only.
    """

    def step(own: Column, m: Column) -> Column:
        hit = F.filter(own, lambda x: _touches(x, m))
        fits = F.when(F.size(hit) > 0, F.forall(hit, lambda x: _holds(m, x))).otherwise(F.array_contains(safe, F.element_at(m["codes"], 1)))
        tags = F.when(m["type"] == merged_type, F.array_sort(F.array_distinct(F.flatten(F.transform(hit, lambda x: x["tags"]))))).otherwise(F.array().cast("array<string>"))
        new = F.struct(m["s"].alias("s"), m["e"].alias("e"), m["type"].alias("type"), tags.alias("tags"), F.array().cast("array<string>").alias("codes"))
        return F.when(F.coalesce(fits, F.lit(False)), F.concat(F.filter(own, lambda x: ~_touches(x, m)), F.array(new))).otherwise(own)

    return F.aggregate(matches, mentions, step)


def expand_spans(mentions: DataFrame, matches: DataFrame) -> DataFrame:
    """Mentions (doc_id, s, e, type, tags) with those of a match's type that it contains
    replaced by the match, which takes their tags."""
    m = matches.select("doc_id", F.col("s").alias("ms"), F.col("e").alias("me"), F.col("type").alias("mt"))
    inside = (mentions["doc_id"] == m["doc_id"]) & (mentions["type"] == m["mt"]) & (m["ms"] <= mentions["s"]) & (mentions["e"] <= m["me"])
    rest = mentions.join(m, inside, "left_anti")
    wide = mentions.join(m.withColumnRenamed("doc_id", "d"), (mentions["doc_id"] == F.col("d")) & (mentions["type"] == F.col("mt")) & (F.col("ms") <= mentions["s"]) & (mentions["e"] <= F.col("me")))
    merged = wide.groupBy("d", "ms", "me", "mt").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"))
    return rest.unionByName(merged.select(F.col("d").alias("doc_id"), F.col("ms").alias("s"), F.col("me").alias("e"), F.col("mt").alias("type"), "tags"))


def merge_guarded(mentions: DataFrame, lookup: Callable[[str, str], list[str]], coded: tuple[str, ...], gap: int = 4) -> DataFrame:
    """Joins fragments inside a word, unless both are of one coded type and have codes of
    their own that differ.

    ``lookup`` (type, text) is asked about texts that the merge itself makes, so a
    document is handled by one Python call.  Columns: doc_id, text (of the document), s, e, type, tags.
    """

    def word(c: str) -> bool:
        return c == "_" or c.isalnum()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        text, out = pdf["text"].iloc[0], []
        for r in pdf.sort_values(["s", "e"], kind="stable").itertuples(index=False):
            new = [int(r.s), int(r.e), r.type, set(r.tags)]
            if out:
                old = out[-1]
                between = text[old[1] : new[0]]
                inside = 0 <= new[0] - old[1] <= gap and all(map(word, between)) and old[1] > 0 and word(text[old[1] - 1]) and word(text[new[0]])
                if inside and old[2] == new[2] and old[2] in coded:
                    a, b = lookup(old[2], text[old[0] : old[1]]), lookup(new[2], text[new[0] : new[1]])
                    inside = not (a and b and a != b)
                if inside:
                    old[2] = new[2] if new[1] - new[0] > old[1] - old[0] else old[2]
                    old[1], old[3] = max(old[1], new[1]), old[3] | new[3]
                    continue
            out.append(new)
        return pd.DataFrame([(pdf["doc_id"].iloc[0], s, e, t, sorted(tags)) for s, e, t, tags in out], columns=["doc_id", "s", "e", "type", "tags"])

    return mentions.groupBy("doc_id").applyInPandas(run, "doc_id long, s int, e int, type string, tags array<string>")


def project_labels(tokens: DataFrame, mentions: DataFrame) -> DataFrame:
    """doc_id, tok, label: B- for the first token a mention overlaps, I- for the others, O outside.

    Columns: doc_id, tok, ts, te; doc_id, s, e, type.  A token of no width is special and gets null.
    """
    hit = tokens.join(mentions, "doc_id").filter("greatest(ts, s) < least(te, e)")
    first = hit.groupBy("doc_id", "s", "e", "type").agg(F.min("tok").alias("first"))
    named = hit.join(first, ["doc_id", "s", "e", "type"]).groupBy("doc_id", "tok").agg(F.min_by(F.concat(F.when(F.col("tok") == F.col("first"), "B-").otherwise("I-"), "type"), F.struct("s", "e", "type")).alias("label"))
    return tokens.join(named, ["doc_id", "tok"], "left").select("doc_id", "tok", F.when(F.col("ts") < F.col("te"), F.coalesce("label", F.lit("O"))).alias("label"))


def join_clauses(clauses: Column, between: str = ". ") -> Column:
    """(text, spans) of clauses (text, s, e) in a row, each span moved to its place."""
    start = F.struct(F.lit("").alias("text"), F.array().cast("array<struct<s:int,e:int>>").alias("spans"))

    def step(a: Column, c: Column) -> Column:
        head = F.when(F.length(a["text"]) > 0, F.concat(a["text"], F.lit(between))).otherwise(F.lit(""))
        at = F.length(head)
        return F.struct(F.concat(head, c["text"]).alias("text"), F.concat(a["spans"], F.array(F.struct((c["s"] + at).alias("s"), (c["e"] + at).alias("e")))).alias("spans"))

    return F.aggregate(clauses, start, step)
