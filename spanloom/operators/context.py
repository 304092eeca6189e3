"""Context of mentions: sections, sentences, negation, tails of drug mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sections(docs: DataFrame, headers: dict[str, str]) -> DataFrame:
    """doc_id, kind, start, end: from each header line to the next mark.

    A line with a header's pattern, or any line that ends with a colon, is a
    mark; the latter only closes what came before (kind ``other``).
    """
    lines = docs.select("doc_id", F.length("text").alias("n"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    w = Window.partitionBy("doc_id").orderBy("i")
    placed = lines.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    kind = F.when(F.rtrim("line").endswith(":"), "other")
    for name, pattern in reversed(headers.items()):
        kind = F.when((F.length("line") <= 120) & F.lower("line").rlike(pattern), name).otherwise(kind)
    marks = placed.withColumn("kind", kind).filter("kind IS NOT NULL")
    return marks.withColumn("end", F.lead("start").over(w)).select("doc_id", "kind", "start", F.coalesce("end", "n").alias("end"))


def in_section(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """``mentions`` with the kind of the last section that holds their start, or null."""
    s = spans.select("doc_id", F.col("start").alias("ss"), F.col("end").alias("se"), "kind")
    hits = mentions.join(s, "doc_id").filter("ss <= start AND start < se").groupBy("doc_id", "start").agg(F.max_by("kind", "ss").alias("kind"))
    return mentions.join(hits, ["doc_id", "start"], "left")


def sentence_bounds(text: Column, at: Column) -> tuple[Column, Column]:
    """(start, end) of the sentence around a position; marks are . ; ? ! and line ends."""
    before, after = F.substring(text, F.lit(1), at), F.substring(text, at + 1, F.length(text))
    head = F.length(before) - F.length(F.regexp_extract(before, "[^.;?!\\n]*$", 0))
    return head, at + F.length(F.regexp_extract(after, "^[^.;?!\\n]*", 0))


#: What ends a cue's scope, beside the conjunctions of a language.
CLAUSE_MARKS = "[,.;:\\n]"


def negated(text: Column, at: Column, cues: list[str], pseudo: tuple[str, ...] = (), breaks: tuple[str, ...] = (), width: int = 60, whole: bool = True) -> Column:
    """A cue ends in the ``width`` characters before, with no clause mark or conjunction (``breaks``) after it.

    A pseudo-negation anywhere in these characters vetoes.  Cues are tried in the order given; one
    counts if its last occurrence begins beyond the end of the one taken before.  ``whole``: a
    cue must begin a word; else it may stand anywhere, as phrases of several words do.
    """
    left = F.lower(F.substring(text, F.greatest(at - width, F.lit(0)) + 1, F.least(at, F.lit(width))))
    found = F.lit(-1)
    for cue in cues:
        if whole:
            last = f"(?s)^(.*)(?<![\\p{{L}}\\p{{N}}_])\\Q{cue}\\E(?![\\p{{L}}\\p{{N}}_])"
            begins = F.when(left.rlike(last), F.length(F.regexp_extract(left, last, 1))).otherwise(-1)
        else:
            back = F.locate(cue[::-1], F.reverse(left))
            begins = F.when(back > 0, F.length(left) - back + 1 - len(cue)).otherwise(-1)
        found = F.when(begins > found, begins + len(cue)).otherwise(found)
    ends = "|".join([CLAUSE_MARKS, *(f"(?U)\\b{w}\\b" for w in breaks)])
    veto = F.lit(False)
    for p in pseudo:
        veto = veto | F.contains(left, F.lit(p))
    return ~veto & (found >= 0) & ~F.substring(left, found + 1, F.length(left)).rlike(ends)


def sig_tail(tokens: Column, at: Column, vocabulary: list[str], most: int = 6) -> Column:
    """How many of the next ``most`` tokens go on with a drug's directions: each part
    between colons is in the vocabulary, a number, a range or an interval."""
    words = F.array(*(F.lit(v) for v in vocabulary))
    number = "^([0-9]+([.,/-][0-9]+)?|q[0-9]+h?)$"
    good = lambda t: F.forall(F.split(F.lower(t), ":"), lambda p: F.array_contains(words, p) | p.rlike(number))
    return F.aggregate(F.slice(tokens, at + 2, most), F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")), lambda a, t: F.struct((a["n"] + F.when(a["open"] & good(t), 1).otherwise(0)).alias("n"), (a["open"] & good(t)).alias("open")), lambda a: a["n"])


def family_gate(mentions: DataFrame, cue: str) -> DataFrame:
    """``mentions`` (tags, kind, sentence) without ``isFamily`` where neither the section nor the sentence speaks of family."""
    said = F.coalesce(F.col("kind") == "family", F.lit(False)) | F.coalesce(F.lower("sentence").rlike(cue), F.lit(False))
    return mentions.withColumn("tags", F.when(said, F.col("tags")).otherwise(F.array_remove("tags", "isFamily")))


def hedge_codes(codes: Column) -> Column:
    """A lone four-character code that isn't a ``.9`` gets its category's ``.9`` beside it."""
    only = F.element_at(codes, 1)
    fits = (F.size(codes) == 1) & only.rlike("^[A-Z][0-9]{2}[.][0-8]$")
    return F.when(fits, F.concat(codes, F.array(F.concat(F.substring(only, 1, 3), F.lit(".9"))))).otherwise(codes)


def salvage_list(raw: Column, schema: str) -> Column:
    """The first bracketed list of a model's answer, parsed; [] if there is none."""
    block = F.regexp_extract(raw, "(?s)\\[.*\\]", 0)
    return F.coalesce(F.from_json(F.when(F.length(block) > 0, block), schema), F.from_json(F.lit("[]"), schema))
