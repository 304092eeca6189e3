"""Directions that follow a product's mention and belong to it: dose, route, frequency, form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import overlaps, slice_text

# Words of routes, frequencies, units and forms, and the phrases that begin an indication.
ROUTES = "po iv im sc sq sl pr ng pg top inh id ip it neb od os ou buccal rectal oral".split()
FREQUENCIES = "daily qd bid tid qid qhs qam qpm qnoon qod qwk weekly prn ac pc hs stat once nightly".split()
UNITS = """mg mcg µg g gm kg ml l unit units u iu meq mmol mmol/l % tab tabs cap caps puff puffs
drop drops patch spray vial amp""".split()
FORMS = """tablet tablets capsule capsules suspension solution syrup injection cream ointment gel inhaler
nebuliser nebulizer supp suppository er xl xr sr cr la viên nén gói ống lọ chai siro""".split()
INDICATIONS = ("điều trị", "để điều", "chỉ định", "dùng cho", "cho bệnh")
NUMBER = r"(?U)^\d+([.,]\d+)?(-\d+([.,]\d+)?)?$"
INTERVAL = r"(?U)^q\d+h?$"
ITEM_NUMBER = r"(?U)^\d{1,2}[.)]$"
#: Tokens that a mention grows by at most.
MOST_TOKENS = 6


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def is_direction(token: Column) -> Column:
    """Each part between colons is a word of directions, an interval or a number; an item's number isn't one."""
    known = lambda p: p.isin(ROUTES + FREQUENCIES + UNITS + FORMS) | p.rlike(INTERVAL) | p.rlike(NUMBER)
    parts = lambda bare: F.filter(F.split(bare, ":"), lambda p: p != "")
    all_known = lambda ps: (F.size(ps) > 0) & F.forall(ps, known)
    return _let(F.lower(F.regexp_replace(token, "^[,;]+|[,;]+$", "")), lambda bare: ~bare.rlike(ITEM_NUMBER) & _let(parts(bare), all_known))


def _word_end(text: Column, start: Column, end: Column) -> Column:
    """The end of the word that the mention stops in, if the whole word is a direction; else its own end."""
    run = F.regexp_extract(F.substring(text, end + 1, F.length(text)), r"(?U)^\S*", 0)
    head = F.regexp_extract(slice_text(text, start, end), r"(?U)\S*$", 0)
    return F.when((F.length(run) > 0) & is_direction(F.concat(head, run)), end + F.length(run)).otherwise(end)


def _grown(pieces: Column) -> Column:
    """How many characters of ``pieces`` (tokens with the blanks before them, in order) go on with a mention."""
    token = lambda i: F.regexp_replace(F.get(pieces, i), r"^[ \t]+", "")
    quantity = lambda i: F.coalesce(F.lower(F.regexp_replace(token(i), "^[,;.]+|[,;.]+$", "")).isin(UNITS + FORMS), F.lit(False))

    def goes_on(i: Column) -> Column:
        ahead = F.lower(F.regexp_replace(F.array_join(F.slice(pieces, i + 1, 4), ""), r"^[ \t]+", ""))
        stop = F.lit(False)
        for phrase in INDICATIONS:
            stop = stop | F.startswith(ahead, F.lit(phrase))
        lone = F.regexp_replace(token(i), "^[,;.]+|[,;.]+$", "").rlike(NUMBER) & ~quantity(i + 1)
        return ~stop & is_direction(token(i)) & ~lone

    first = F.struct(F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc: Column, i: Column) -> Column:
        on = acc["open"] & goes_on(i)
        return F.struct((acc["n"] + F.when(on, F.length(F.get(pieces, i))).otherwise(0)).alias("n"), on.alias("open"))

    most = F.least(F.size(pieces), F.lit(MOST_TOKENS))
    return F.when(most > 0, F.aggregate(F.sequence(F.lit(0), most - 1), first, step, lambda acc: acc["n"])).otherwise(0)


def extended_end(text: Column, start: Column, end: Column) -> Column:
    """The end of a product's mention with the directions after it, on its line and before any indication.

    A number counts only before a unit or a form; marks at the end stay out.
    """
    word = rf"(?U)^([ \t]+\S+){{0,{MOST_TOKENS + 4}}}"
    pieces = lambda whole: F.regexp_extract_all(F.regexp_extract(F.substring(text, whole + 1, F.length(text)), word, 0), F.lit(r"(?U)[ \t]+\S+"), 0)
    far = lambda whole: _let(pieces(whole), lambda p: whole + _grown(p))
    bare = lambda e: e - F.length(F.regexp_extract(slice_text(text, start, e), "[,;.:/)]*$", 0))
    return _let(_word_end(text, start, end), lambda whole: _let(far(whole), bare))


def extend_products(mentions: DataFrame, docs: DataFrame, kind: str = "DRUG") -> DataFrame:
    """``mentions`` (doc_id, start, end, type, text) of ``docs`` (doc_id, text), those of ``kind`` grown by their directions.

    One grows only if it hits no mention of another type; mentions of documents that aren't
    there stay as they are.  A document's few other spans travel as one array.
    """
    others = mentions.filter(F.col("type") != kind).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("__others"))
    texts = docs.select("doc_id", F.col("text").alias("__text"))
    seen = mentions.join(texts, "doc_id", "left").join(others, "doc_id", "left")
    far = F.when((F.col("type") == kind) & F.col("__text").isNotNull(), extended_end(F.col("__text"), F.col("start").cast("int"), F.col("end").cast("int")).cast("long"))
    hit = F.coalesce(F.exists("__others", lambda o: overlaps(F.col("start"), F.col("__far"), o["start"], o["end"])), F.lit(False))
    grows = F.coalesce(F.col("__far") > F.col("end"), F.lit(False)) & ~hit
    marked = seen.withColumn("__far", far).withColumn("__grows", grows)
    text = F.when(F.col("__grows"), slice_text("__text", F.col("start").cast("int"), F.col("__far").cast("int"))).otherwise(F.col("text"))
    end = F.when(F.col("__grows"), F.col("__far")).otherwise(F.col("end"))
    return marked.withColumn("text", text).withColumn("end", end).select(*mentions.columns)
