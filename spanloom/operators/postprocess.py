"""What happens to mentions after recognition: the noise filter and the chain of context rules.

Mentions are rows (doc_id, start, end, type, text, assertions, candidates) of
documents (doc_id, text).  The order of the chain is fixed: sections, negation,
family gate, consistency, hedge; options only switch its steps.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import is_word_char, norm_ws, slice_text
from spanloom.operators import context, terminology

CODED = ("DIAG", "DRUG")
ASSERTABLE = ("DIAG", "SYM", "DRUG")


@dataclass(frozen=True)
class NoiseOptions:
    """``denied`` and ``short_allowed`` hold (type, text); the former in lower case, the latter as written."""

    denied: tuple[tuple[str, str], ...] = ()
    short_allowed: tuple[tuple[str, str], ...] = ()
    drop_short: bool = False


def _listed(kind: Column, text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    return F.concat_ws("\t", kind, text).isin([f"{k}\t{t}" for k, t in pairs]) if pairs else F.lit(False)


def noise_reasons(mentions: DataFrame, docs: DataFrame, options: NoiseOptions = NoiseOptions()) -> DataFrame:
    """``mentions`` with reason, the first rule that drops one (null: it stays).

    denied: the list has it.  uncoded: a coded type without candidates.  embedded: at most four
    characters and a word character beside it, but coded ones stay.  short: at most two
    characters and not on the other list, if the options ask for it.
    """
    bare = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    coded = F.col("type").isin(*CODED)
    inside = is_word_char(F.col("__left")) | is_word_char(F.col("__right"))
    rules = [
        ("denied", _listed(F.col("type"), F.lower(bare), options.denied)),
        ("uncoded", coded & (F.coalesce(F.size("candidates"), F.lit(0)) < 1)),
        ("embedded", ~coded & (F.length(bare) <= 4) & inside),
        ("short", F.lit(options.drop_short) & (F.length(bare) <= 2) & ~_listed(F.col("type"), F.col("text"), options.short_allowed)),
    ]
    at = lambda p: slice_text("__text", p.cast("int"), (p + 1).cast("int"))
    left = F.when(F.col("start") > 0, at(F.col("start") - 1))
    beside = mentions.join(docs.select("doc_id", F.col("text").alias("__text")), "doc_id", "left").withColumn("__left", left).withColumn("__right", at(F.col("end"))).drop("__text")
    return terminology.drop_reasons(beside, rules).select(*mentions.columns, "reason")


# Fixed values: (text of a mention, phrase that makes it a false positive, characters looked at before and after it);
# no width: as many as the phrase has.
FALSE_POSITIVES = (
    ("ban", "ban đầu", None, None),
    ("phù", "phù hợp", None, None),
    ("sốc", "sốc điện", 40, 60),
    ("sốc", "bị sốc khi", 40, 60),
    ("liệt", "tuyến tiền liệt", None, None),
    ("ho", "- ho bệnh", 40, 60),
    ("ho", "- ho rung", 40, 60),
    ("ho", "- ho đái", 40, 60),
)
# What follows a mention that was cut short.
CLIPPED_BEFORE = (" cơ tim", " tá tràng", " thực quản", " đại tràng", " phổi", " gan", " thận")


def without_false_positives(mentions: DataFrame, docs: DataFrame, rules=FALSE_POSITIVES, types: tuple[str, ...] = ("DIAG", "SYM")) -> DataFrame:
    """``mentions`` without those of ``types`` near a phrase that gives their text another meaning.

    Mentions of documents that aren't there stay.
    """
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    wrong = F.lit(False)
    for text, phrase, before, after in rules:
        left = F.greatest(start - (len(phrase) if before is None else before), F.lit(0))
        near = F.lower(slice_text("__text", left, end + (len(phrase) if after is None else after)))
        wrong = wrong | ((F.lower("text") == text) & F.contains(near, F.lit(phrase)))
    seen = mentions.join(docs.select("doc_id", F.col("text").alias("__text")), "doc_id", "left")
    return seen.filter(~F.coalesce(F.col("type").isin(*types) & wrong, F.lit(False))).select(*mentions.columns)


def suspects(mentions: DataFrame, docs: DataFrame, tails: tuple[str, ...] = CLIPPED_BEFORE, most: int = 3) -> DataFrame:
    """``mentions`` with short (at most ``most`` characters), clipped (one of ``tails`` follows)
    and repeats (mentions of the same type and normalised text in the document)."""
    seen = mentions.join(docs.select("doc_id", F.col("text").alias("__text")), "doc_id", "left")
    end = F.col("end").cast("int")
    after = slice_text("__text", end, end + max(map(len, tails)))
    clipped = F.lit(False)
    for tail in tails:
        clipped = clipped | F.startswith(after, F.lit(tail))
    w = Window.partitionBy("doc_id", "type", norm_ws("text"))
    return seen.withColumn("short", F.length("text") <= most).withColumn("clipped", F.coalesce(clipped, F.lit(False))).withColumn("repeats", F.count(F.lit(1)).over(w)).drop("__text")


@dataclass(frozen=True)
class ContextOptions:
    """Steps of the chain; none is on by default.  consistency: majority or union.  hedge: uncurated or all."""

    sections: bool = False
    negation: bool = False
    family_gate: bool = False
    consistency: str | None = None
    hedge: str | None = None

    def __post_init__(self):
        if self.consistency not in (None, "majority", "union") or self.hedge not in (None, "uncurated", "all"):
            raise ValueError(f"unknown mode in {self}")


@dataclass(frozen=True)
class ContextWords:
    """headers: patterns of header lines by kind, family before drug_history before history.
    The other fields are phrases in lower case."""

    headers: dict[str, str] = field(default_factory=dict)
    cues: tuple[str, ...] = ()
    pseudo: tuple[str, ...] = ()
    breaks: tuple[str, ...] = ()
    family_cue: str = "(?!)"


def _add(tag: str, where: Column) -> Column:
    return F.when(F.coalesce(where, F.lit(False)), F.array_union("assertions", F.array(F.lit(tag)))).otherwise(F.col("assertions"))


def consistent(mentions: DataFrame, mode: str) -> DataFrame:
    """Mentions of one text and type in a document, two or more, get the assertions that more than half of them bear, or any."""
    w = Window.partitionBy("doc_id", "text", "type")
    members, said = F.count(F.lit(1)).over(w), F.flatten(F.collect_list("assertions").over(w))
    voted = mentions.withColumn("__n", members).withColumn("__said", said)
    enough = lambda t: F.size(F.filter("__said", lambda x: x == t)) * 2 > F.col("__n")
    each = F.array_sort(F.array_distinct("__said"))
    agreed = each if mode == "union" else F.filter(each, enough)
    applies = (F.col("__n") > 1) & F.col("type").isin(*ASSERTABLE)
    return voted.withColumn("assertions", F.when(applies, agreed).otherwise(F.col("assertions"))).drop("__n", "__said")


def post_process(mentions: DataFrame, docs: DataFrame, options: ContextOptions, words: ContextWords, curated: DataFrame | None = None) -> DataFrame:
    """``mentions`` after the steps that ``options`` names; assertions of assertable types leave sorted and once each.

    A drug list's header makes drugs historical, a family header all that stands under it; a
    general history's header does nothing, as its scope has no end.  ``curated`` (text): what
    an ``uncurated`` hedge leaves alone.  Mentions of documents that aren't there keep what
    they have, but for consistency and hedge, which need no text.
    """
    columns = mentions.columns
    own = mentions.withColumn("assertions", F.coalesce("assertions", F.array().cast("array<string>")))
    able = F.col("type").isin(*ASSERTABLE)
    if options.sections or options.family_gate:
        marks = context.sections(docs, words.headers).filter("kind <> 'other'")
        own = context.in_section(own, marks)
    else:
        own = own.withColumn("kind", F.lit(None).cast("string"))
    if options.negation or options.family_gate:
        own = own.join(docs.select("doc_id", F.col("text").alias("__text")), "doc_id", "left")
    at = F.col("start").cast("int")
    if options.sections:
        own = own.withColumn("assertions", _add("isFamily", able & (F.col("kind") == "family")))
        own = own.withColumn("assertions", _add("isHistorical", (F.col("kind") == "drug_history") & (F.col("type") == "DRUG")))
    if options.negation:
        said = context.negated(F.col("__text"), at, list(words.cues), words.pseudo, words.breaks, whole=False)
        own = own.withColumn("assertions", _add("isNegated", able & said))
    if options.family_gate:
        begins, ends = context.sentence_bounds(F.col("__text"), at)
        with_sentence = own.withColumn("tags", F.col("assertions")).withColumn("sentence", slice_text("__text", begins, ends))
        gated = context.family_gate(with_sentence, words.family_cue)
        own = gated.withColumn("assertions", F.when(F.col("__text").isNull(), F.col("assertions")).otherwise(F.col("tags")))
    if options.consistency:
        own = consistent(own, options.consistency)
    if options.hedge:
        free = F.col("type") == "DIAG"
        if options.hedge == "uncurated" and curated is not None:
            known = curated.select(norm_ws("text").alias("__norm")).distinct().withColumn("__known", F.lit(True))
            own = own.withColumn("__norm", norm_ws("text")).join(known, "__norm", "left")
            free = free & F.col("__known").isNull()
        own = own.withColumn("candidates", F.when(free, context.hedge_codes(F.col("candidates"))).otherwise(F.col("candidates")))
    return own.withColumn("assertions", F.when(able, F.array_sort(F.array_distinct("assertions"))).otherwise(F.col("assertions"))).select(*columns)
