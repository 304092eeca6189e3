"""Structural checks of prediction records, as rows of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import text as tx

ENTITY = "array<struct<text:string,type:string,start:int,end:int>>"
REQUIRED = ("text", "type", "position", "assertions")
#: Spans of so few characters are suspect where a word goes on beside them.
SHORT = 4


def record_issues(records: DataFrame, types: list[str]) -> DataFrame:
    """doc_id, idx, code for each fault of each entity (columns doc_id, text, payload: JSON).

    A payload that isn't an array of objects is one issue of its own, idx -1.
    """
    parsed = records.withColumn("es", F.from_json("payload", ENTITY))
    broken = parsed.filter("es IS NULL").select("doc_id", F.lit(-1).cast("long").alias("idx"), F.lit("bad_json").alias("code"))
    each = parsed.select("doc_id", F.col("text").alias("t"), F.posexplode("es").alias("idx", "e"))
    rules = {
        "bad_type": ~F.coalesce(F.col("e.type").isin(types), F.lit(False)),
        "bad_range": ~F.coalesce((F.col("e.start") >= 0) & (F.col("e.start") <= F.col("e.end")) & (F.col("e.end") <= F.length("t")), F.lit(False)),
        "bad_text": ~F.coalesce(F.substring("t", F.col("e.start") + 1, F.col("e.end") - F.col("e.start")) == F.col("e.text"), F.lit(False)),
    }
    codes = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())), lambda x: x.isNotNull())
    return broken.unionByName(each.select("doc_id", F.col("idx").cast("long").alias("idx"), F.explode(codes).alias("code")))


def span_counts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n, right: how many spans a document has, how many of them hold their own word.
    Columns: doc_id, text; doc_id, s, e, word.

    A document's spans meet its text in one row, cut into blocks: beside each span the text
    would be copied as often as it has spans.  Spans of other ids don't count; one that
    starts below 0 or ends before its start holds nothing.
    """
    each = spans.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e", "word")).alias("spans"))
    cut = docs.select("doc_id", tx.blocks_of("text").alias("blocks")).join(each, "doc_id")
    holds = lambda x: (x["s"] >= 0) & (x["s"] <= x["e"]) & (tx.slice_blocks(F.col("blocks"), x["s"], x["e"]) == x["word"])
    own = cut.select("doc_id", F.size("spans").cast("long").alias("n"), F.size(F.filter("spans", holds)).cast("long").alias("right"))
    return own.groupBy("doc_id").agg(F.sum("n").alias("n"), F.sum("right").alias("right"))


def _kind(v: Column) -> Column:
    """Type of a variant; VOID for JSON's null and for none at all."""
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _all(v: Column, kind: str) -> Column:
    """Whether a variant is a list of nothing but ``kind``."""
    return _kind(v).startswith("ARRAY") & F.coalesce(F.forall(F.try_variant_get(v, "$", "array<variant>"), lambda x: _kind(x) == kind), F.lit(False))


def _entity(e: Column, i: Column) -> Column:
    """What the rules look at in one element of a record."""
    part = {c: F.try_variant_get(e, f"$.{c}", "variant") for c in (*REQUIRED, "candidates")}
    string = lambda c: F.when(_kind(part[c]) == "STRING", F.try_variant_get(e, f"$.{c}", "string"))
    placed = _all(part["position"], "BIGINT") & (F.size(F.try_variant_get(part["position"], "$", "array<variant>")) == 2)
    at = lambda k: F.when(placed, F.try_variant_get(e, f"$.position[{k}]", "bigint"))
    lacking = F.lit(False)
    for c in REQUIRED:
        lacking = lacking | part[c].isNull()
    strings = lambda c: F.when(_all(part[c], "STRING"), F.try_variant_get(e, f"$.{c}", "array<string>"))
    return F.struct(
        i.alias("idx"),
        _kind(e).startswith("OBJECT").alias("object"),
        lacking.alias("lacking"),
        string("text").alias("text"),
        string("type").alias("type"),
        at(0).alias("s"),
        at(1).alias("e"),
        strings("assertions").alias("assertions"),
        strings("candidates").alias("candidates"),
        part["candidates"].isNotNull().alias("has_candidates"),
        (_kind(part["candidates"]) == "VOID").alias("no_candidates"),
    )


def entity_issues(records: DataFrame, types: list[str], assertion_types: list[str], candidate_types: list[str], assertions: list[str]) -> DataFrame:
    """doc_id, idx, level (error or warning), code: each fault of each record.

    ``records`` has doc_id, text and payload: JSON, a list of objects with text, type, position
    ([start, end] in code points), assertions and, for ``candidate_types``, candidates.  All
    rules run inside a record's own row, without a shuffle.

    Defined cases: idx is -1 for faults of a whole record.  A null text is no_input, a payload
    that doesn't parse (null and repeated keys included) bad_json, and either is a record's only
    issue.  An element that is no object, lacks a field, or has no string as its text or no two
    integers as its position is judged no further, but for its type and, if it has a position,
    overlaps.  Overlaps are looked for between neighbours by position only, and stand at the
    later one's idx.  A record that comes twice is judged twice.
    """
    whole = lambda level, code: F.struct(F.lit(-1).alias("idx"), F.lit(level).alias("level"), F.lit(code).alias("code"))
    parsed = records.select("doc_id", F.col("text").alias("t"), F.try_parse_json("payload").alias("v"))
    parsed = parsed.withColumn("es", F.when(F.col("t").isNotNull() & _kind(F.col("v")).startswith("ARRAY"), F.transform(F.try_variant_get("v", "$", "array<variant>"), _entity)))
    t = F.col("t")
    true = lambda c: F.coalesce(c, F.lit(False))

    def rules(x: Column) -> Column:
        full = x["object"] & ~x["lacking"]
        judged = full & x["text"].isNotNull() & x["s"].isNotNull()
        inside = judged & (x["s"] >= 0) & (x["s"] <= x["e"]) & (x["e"] <= F.length(t))
        s, e = x["s"].cast("int"), x["e"].cast("int")
        bare = F.regexp_replace(x["text"], "(?U)^\\s+|\\s+$", "")
        faults = [
            ("error", "not_object", ~x["object"]),
            ("error", "missing_field", x["object"] & x["lacking"]),
            ("error", "bad_type", full & ~true(x["type"].isin(types))),
            ("error", "text_not_string", full & x["text"].isNull()),
            ("error", "bad_position", full & x["text"].isNotNull() & x["s"].isNull()),
            ("error", "out_of_bounds", judged & ~inside),
            ("error", "span_mismatch", inside & (tx.slice_text(t, s, e) != x["text"])),
            ("warning", "short_embedded", inside & (x["s"] < x["e"]) & (F.length(bare) <= SHORT) & ~tx.outside_word(t, s, e)),
            ("error", "bad_assertions", judged & x["assertions"].isNull()),
            ("error", "unknown_assertion", judged & F.exists(x["assertions"], lambda a: ~a.isin(assertions))),
            ("warning", "needless_assertions", judged & (F.size(x["assertions"]) > 0) & ~true(x["type"].isin(assertion_types))),
            ("error", "no_candidates", judged & true(x["type"].isin(candidate_types)) & ~x["has_candidates"]),
            ("error", "bad_candidates", judged & ~x["no_candidates"] & x["candidates"].isNull()),
        ]
        return F.array(*(F.when(true(c), F.struct(x["idx"].alias("idx"), F.lit(level).alias("level"), F.lit(code).alias("code"))) for level, code, c in faults))

    key = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.coalesce(x["type"], F.lit("")).alias("type"), F.coalesce(x["text"], F.lit("")).alias("text"), x["idx"].alias("idx"))
    judged = F.filter("es", lambda x: x["object"] & ~x["lacking"] & x["text"].isNotNull() & x["s"].isNotNull())
    parsed = parsed.withColumn("keys", F.transform(judged, lambda x: key(x).dropFields("idx"))).withColumn("placed", F.array_sort(F.transform(F.filter("es", lambda x: x["s"].isNotNull()), key)))
    behind = lambda x, i: (i > 0) & tx.overlaps(F.get("placed", i - 1)["s"], F.get("placed", i - 1)["e"], x["s"], x["e"])
    found = F.concat(
        F.flatten(F.transform("es", rules)),
        F.array(
            F.when(F.col("keys") != F.array_sort("keys"), whole("warning", "unsorted")),
            F.when(F.size(F.array_distinct("keys")) < F.size("keys"), whole("warning", "duplicates")),
        ),
        F.transform(F.filter("placed", behind), lambda x: F.struct(x["idx"].alias("idx"), F.lit("warning").alias("level"), F.lit("overlap").alias("code"))),
    )
    kind = _kind(F.col("v"))
    issues = F.when(t.isNull(), F.array(whole("error", "no_input"))).when(F.col("v").isNull(), F.array(whole("error", "bad_json"))).when(~kind.startswith("ARRAY"), F.array(whole("error", "not_list"))).otherwise(found)
    return parsed.select("doc_id", F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("x")).select("doc_id", F.col("x.idx").cast("long").alias("idx"), "x.level", "x.code")


def file_issues(found: DataFrame, expected: DataFrame) -> DataFrame:
    """doc_id, level, code: ids of one side only, and one row without an id if the counts differ.

    Both have doc_id; ids count once, null ids don't count.
    """
    side = lambda d, c: d.select("doc_id").filter("doc_id IS NOT NULL").distinct().withColumn(c, F.lit(1))
    both = side(found, "f").join(side(expected, "x"), "doc_id", "full")
    one = both.filter("f IS NULL OR x IS NULL").select("doc_id", F.when(F.col("f").isNull(), "error").otherwise("warning").alias("level"), F.when(F.col("f").isNull(), "missing_output").otherwise("unexpected_output").alias("code"))
    differ = both.agg(F.count("f").alias("f"), F.count("x").alias("x")).filter("f <> x")
    return one.unionByName(differ.select(F.lit(None).cast(found.schema["doc_id"].dataType).alias("doc_id"), F.lit("error").alias("level"), F.lit("file_count").alias("code")))
