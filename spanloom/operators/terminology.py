"""Building, overriding and auditing curated vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_code(mined: DataFrame, key: str, code: str) -> DataFrame:
    """key, code, n, n_codes: the most frequent code of each key; on ties the greatest."""
    counts = mined.groupBy(key, code).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.max_by(code, F.struct("n", code)).alias(code), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_codes"))


def conflicts(mined: DataFrame, key: str, code: str) -> DataFrame:
    """Keys with more than one code."""
    return mode_code(mined, key, code).filter("n_codes > 1")


def priority_union(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of the first part that has their key; ``prio`` tells which."""
    all_rows = None
    for i, p in enumerate(parts):
        own = p.withColumn("prio", F.lit(i))
        all_rows = own if all_rows is None else all_rows.unionByName(own)
    best = all_rows.groupBy(key).agg(F.min("prio").alias("prio"))
    return all_rows.join(best, [key, "prio"])


def carry_over(rebuilt: DataFrame, kept: DataFrame, key: str, code: str) -> DataFrame:
    """Codes of ``kept`` where it has the key, else the rebuilt ones; keys of either side."""
    old = kept.groupBy(key).agg(F.max(code).alias("old"))
    new = rebuilt.groupBy(key).agg(F.max(code).alias("new"))
    return new.join(old, key, "full").select(key, F.coalesce("old", "new").alias(code), F.when(F.col("old").isNull(), "rebuilt").when(F.col("new").isNull(), "orphan").otherwise("kept").alias("origin"))


def nearest_ancestor(codes: DataFrame, catalog: DataFrame, least: int = 3) -> DataFrame:
    """code, found: the longest prefix of ``least`` characters or more that the catalog has."""
    prefixes = codes.select("code").distinct().withColumn("l", F.explode(F.sequence(F.length("code"), F.lit(least), F.lit(-1)))).filter(F.length("code") >= least)
    cut = prefixes.select("code", F.rtrim(F.substring("code", F.lit(1), F.col("l")), F.lit(".")).alias("p"))
    hit = cut.join(catalog.select(F.col("code").alias("p")).distinct(), "p").groupBy("code").agg(F.max_by("p", F.length("p")).alias("found"))
    return codes.select("code").distinct().join(hit, "code", "left")


def promoted_children(catalog: DataFrame) -> DataFrame:
    """category, child: ``.9`` if the catalog has it, else the least child."""
    parts = catalog.filter(F.col("code").contains(".")).select(F.substring_index("code", ".", 1).alias("category"), "code")
    return parts.groupBy("category").agg(F.coalesce(F.min(F.when(F.col("code").endswith(".9"), F.col("code"))), F.min("code")).alias("child"))


def audit_codes(curated: DataFrame, catalog: DataFrame) -> DataFrame:
    """code, action, proposed for each curated code: promote a category to a child,
    shorten an unknown code to an ancestor, keep, or review."""
    known = catalog.select("code").distinct().withColumn("known", F.lit(True))
    own = curated.select("code").distinct().join(known, "code", "left")
    children = promoted_children(catalog)
    up = nearest_ancestor(own.filter("known IS NULL"), catalog)
    joined = own.join(children, own["code"] == children["category"], "left").join(up.withColumnRenamed("code", "c"), F.col("code") == F.col("c"), "left")
    action = F.when(F.col("child").isNotNull(), "promote").when(F.col("known"), "keep").when(F.col("found").isNotNull(), "ancestor").otherwise("review")
    return joined.select("code", action.alias("action"), F.when(action == "promote", F.col("child")).when(action == "ancestor", F.col("found")).when(action == "keep", F.col("code")).alias("proposed"))


def vote(mentions: DataFrame, key: list[str], value: str, majority: bool = True) -> DataFrame:
    """key, value: values that more than half of a group's members have, or any, in groups of two or more."""
    members = mentions.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).filter("members >= 2")
    counts = mentions.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(members, key).filter("2 * n > members" if majority else "n > 0")


def worklist(mentions: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """key, freq, code, in_terms: terms and mentions, mentioned most first by frequency."""
    freq = mentions.groupBy(key).agg(F.count(F.lit(1)).alias("freq"))
    return terms.join(freq, key, "full").select(key, F.coalesce("freq", F.lit(0)).alias("freq"), "code", F.col("code").isNotNull().alias("in_terms"))


def drop_reasons(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``rows`` with ``reason``: the first rule that holds, null if none does."""
    reason = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        reason = F.when(rule, F.lit(name)).otherwise(reason)
    return rows.withColumn("reason", reason)


def first_row(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__r = 1").drop("__r")


def concept_index(current: DataFrame, archive: DataFrame, norm) -> DataFrame:
    """term, code, kind, source: each normalised text with each of its codes once; current
    atoms beat archived ones, then the first wins.  Columns: code, kind, text, ord."""
    both = current.withColumn("source", F.lit("rrf_current")).withColumn("p", F.lit(0)).unionByName(archive.withColumn("source", F.lit("rrf_archive")).withColumn("p", F.lit(1)))
    keyed = both.withColumn("term", norm("text")).filter(F.length("term") > 0)
    return keyed.groupBy("term", "code").agg(F.min_by(F.struct("kind", "source"), F.struct("p", "ord")).alias("k")).select("term", "code", "k.kind", "k.source")


def prescribable_names(atoms: DataFrame) -> DataFrame:
    """text: short names of substances and brands, as first seen."""
    good = atoms.filter(F.col("kind").isin("IN", "PIN", "BN") & (F.size(F.split(F.trim("text"), "\\s+")) <= 4) & (F.length("text") <= 40))
    return good.groupBy(F.lower("text").alias("k")).agg(F.min_by("text", "ord").alias("text")).select("text")


def catalog_names(raw: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """code, name: two or more (code, name) projections of each row, the first of equal ones
    without regard to case.  Columns: ord and those named in ``pairs``."""
    both = raw.select("ord", F.posexplode(F.array(*(F.struct(F.trim(F.col(c)).alias("code"), F.trim(F.col(n)).alias("name")) for c, n in pairs))).alias("k", "x")).select("ord", "k", "x.*")
    good = both.filter((F.length("code") > 0) & (F.length("name") > 0))
    return first_row(good.withColumn("low", F.lower("name")), ["code", "low"], [F.col("ord"), F.col("k")]).select("code", "name").orderBy("code", "name")


def expansion_reasons(titles: DataFrame, existing: DataFrame) -> DataFrame:
    """``titles`` (code, term) with the reason why each isn't added, null if it is."""
    have = existing.select("term").distinct().withColumn("have", F.lit(True))
    w = Window.partitionBy("term").orderBy("code")
    marked = titles.join(have, "term", "left").withColumn("again", F.row_number().over(w) > 1)
    rules = [
        ("chapter", F.substring("code", 1, 1).isin("U", "V", "W", "X", "Y", "Z")),
        ("level", F.length(F.regexp_replace("code", "[.]", "")) != 4),
        ("short", F.size(F.split("term", " ")) < 3),
        ("known", F.col("have").isNotNull() | F.col("again")),
    ]
    return drop_reasons(marked, rules).drop("have", "again")


def apply_proposals(terms: DataFrame, proposals: DataFrame, pattern: str, catalog: DataFrame) -> DataFrame:
    """``terms`` (term, type, code) with ``code`` replaced where an acceptable proposal
    (term, type, proposed) differs, and ``origin``.  Texts never change, no code gets empty."""
    good = proposals.filter(F.col("proposed").rlike(pattern)).join(catalog.select(F.col("code").alias("proposed")).distinct(), "proposed", "left_semi")
    one = good.groupBy("term", "type").agg(F.max("proposed").alias("proposed"))
    joined = terms.join(one, ["term", "type"], "left")
    new = F.coalesce("proposed", "code")
    return joined.select("term", "type", new.alias("code"), F.when(new != F.col("code"), "recoded").otherwise("kept").alias("origin"))


def vocabulary_use(found: DataFrame, terms: DataFrame) -> DataFrame:
    """n_terms, n_used: how many terms occur at all (columns phrase; term)."""
    used = found.select(F.col("phrase").alias("term")).distinct().withColumn("used", F.lit(1))
    return terms.select("term").distinct().join(used, "term", "left").agg(F.count(F.lit(1)).alias("n_terms"), F.count("used").alias("n_used"))


def coverage_score(mentions: DataFrame, warnings: Column, errors: Column) -> DataFrame:
    """A proxy objective: 0.70 + 0.25 * coverage - min(0.001 * warnings, 0.10); -1e9 with errors."""
    share = F.coalesce(F.avg((F.size("candidates") > 0).cast("double")), F.lit(0.0))
    return mentions.agg(F.when(errors > 0, F.lit(-1e9)).otherwise(0.70 + 0.25 * share - F.least(0.001 * warnings, F.lit(0.10))).alias("score"))


def phrase_lexicon(phrases: DataFrame, least: int, generic: list[str], single: list[str]) -> DataFrame:
    """type, text, n: admissible phrases by type, cleaned and counted, longest first.

    Phrases of ``least`` characters or more that aren't generic, of two words or more, or
    one that is in ``single`` or comes twice.  Columns: type, text.
    """
    clean = F.lower(F.trim(F.regexp_replace("text", "(?U)\\s+", " ")))
    counted = phrases.select("type", clean.alias("text")).groupBy("type", "text").agg(F.count(F.lit(1)).alias("n"))
    good = (F.length("text") >= least) & ~F.col("text").isin(generic) & (F.contains("text", F.lit(" ")) | F.col("text").isin(single) | (F.col("n") >= 2))
    return counted.filter(good).orderBy(-F.length("text"), "text", "type")


def coded_lexicon(terms: DataFrame, least: int, generic: list[str]) -> DataFrame:
    """text, type, codes: terms of ``least`` characters or more with a code, longest first.  Columns: text, type, code."""
    clean = F.lower(F.trim(F.regexp_replace("text", "(?U)\\s+", " ")))
    own = terms.filter(F.col("code").isNotNull()).select(clean.alias("text"), "type", "code").filter((F.length("text") >= least) & ~F.col("text").isin(generic))
    return own.groupBy("text", "type").agg(F.array_sort(F.collect_set("code")).alias("codes")).orderBy(-F.length("text"), "text", "type")


def surface_forms(mentions: DataFrame, key: str, form: str, context: str, order: str, most: int = 2) -> DataFrame:
    """key, freq, form, contexts: the most frequent way a key is written, the first on ties,
    and the first ``most`` distinct contexts."""
    forms = mentions.groupBy(key, form).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("o"))
    best = forms.groupBy(key).agg(F.sum("n").alias("freq"), F.max_by(form, F.struct("n", -F.col("o"))).alias(form))
    seen = mentions.groupBy(key, context).agg(F.min(order).alias("o")).withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("o", context))).filter(F.col("r") <= most)
    listed = seen.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", context))), lambda x: x[context]).alias("contexts"))
    return best.join(listed, key).select(key, "freq", form, "contexts")


def coverage_by_type(rows: DataFrame, kind: str, seen: Column, coded: Column) -> DataFrame:
    """kind, n, n_seen, n_uncoded."""
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.count_if(seen).alias("n_seen"), F.count_if(~coded).alias("n_uncoded"))


def unambiguous(terms: DataFrame, existing: DataFrame, least: int = 6) -> DataFrame:
    """term, code: new terms of ``least`` characters or more that have exactly one code."""
    one = terms.filter(F.length("term") >= least).groupBy("term").agg(F.min("code").alias("code"), F.count_distinct("code").alias("n")).filter("n = 1")
    return one.join(existing.select("term").distinct(), "term", "left_anti").select("term", "code")


def supplement(base: DataFrame, more: DataFrame, key: str, norm) -> DataFrame:
    """``base`` and those rows of ``more`` whose normalised key it lacks."""
    have = base.select(norm(key).alias("__k")).distinct()
    return base.unionByName(more.withColumn("__k", norm(key)).join(have, "__k", "left_anti").drop("__k"))


def text_inconsistency(mentions: DataFrame, key: str, code: str, group: str) -> DataFrame:
    """key, n_codes, n_groups, repeats: keys with several codes, and how often a key comes again in a group."""
    each = mentions.groupBy(key, group).agg((F.count(F.lit(1)) - 1).alias("again")).groupBy(key).agg(F.count(F.lit(1)).alias("n_groups"), F.sum("again").alias("repeats"))
    codes = mentions.groupBy(key).agg(F.count_distinct(code).alias("n_codes"))
    return codes.join(each, key).filter("n_codes > 1").select(key, "n_codes", "n_groups", "repeats")
