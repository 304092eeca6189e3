"""Quality rules by weak supervision (native).

Every rule looks at counts of one document and votes good (1), bad (0) or
abstains (null).  Expectation-maximisation over the histogram of vote patterns
estimates how often each rule is right; a document's posterior probability of
being good, given its votes and those accuracies, decides whether it stays.

The pipeline's stage gives each rule two rates, of bad votes on bad and on good
documents: a rule that looks for one kind of junk misses the other kinds, so
its good vote says little while its bad vote says much.  With one accuracy for
both, as in ``op10_quality_rules`` and its SQL, four good votes outweigh any bad
one.  Which class a rule that agrees with no other sides with isn't identified by
votes alone; the bounds of the rates decide it.

The histogram has at most ``3 ** len(RULES)`` rows whatever the corpus holds,
so that is all the driver ever sees.  Texts are never shuffled.

Defined cases: a null or empty text has no words, all counts 0, fails the base
rules and goes.  An empty table gives an empty table.  Repeated rows are judged
each for itself, equally.  Null ids are kept as null.  Extra columns of any
name pass through ``keep_quality`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, materialize, on_plain_names, table, word_array

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
EM_ROUNDS = 40
#: Accuracies stay in these bounds, so that no rule can turn against its meaning.
LEAST_ACCURACY, MOST_ACCURACY = 0.55, 0.99
FIRST_ACCURACY, FIRST_GOOD = 0.8, 0.8
#: Bounds of a rule's share of bad votes on good documents and on bad ones; they don't meet.
#: MOST_HIT keeps one kind of junk from being all that is bad: each rule looks for one of several kinds.
LEAST_FALSE, MOST_FALSE = 0.001, 0.01
LEAST_HIT, MOST_HIT = 0.1, 0.4
FIRST_FALSE, FIRST_HIT = 0.01, 0.2
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: name -> (bad if, good if), SQL over the counts; neither: abstain.
RULES = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 15 * n_words", "word_chars >= 3 * n_words AND word_chars <= 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "dup_lines": ("2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines"),
    "repeats": ("10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
}


def vote_sql(rule: str) -> str:
    bad, good = RULES[rule]
    return f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END"


def _repeat_words(words: str, grams: str) -> Column:
    """Words inside three-word windows that the text has twice or more.

    ``grams`` holds a 64-bit hash for each window.  Texts without a repeated
    window, most of them, are told by the number of distinct hashes; for the
    others equal hashes become neighbours by sorting, and every window covers
    the words up to the next repeated window, three at most.
    """
    return F.expr(
        f"""
        CASE WHEN size({grams}) = size(array_distinct({grams})) THEN 0L ELSE
          aggregate(
            array_sort(flatten(transform(array(sort_array(transform({grams}, (h, i) -> named_struct('h', h, 'i', i)))), s ->
              transform(filter(s, (x, k) -> (k > 0 AND get(s, k - 1).h = x.h) OR get(s, k + 1).h = x.h), x -> x.i)))),
            named_struct('n', 0L, 'end', -1),
            (a, i) -> named_struct('n', a.n + 3 - greatest(a.end - i, 0), 'end', i + 3),
            a -> a.n) END
        """
    )


def document_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of each document's whole text added."""
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.withColumn("__text", full_text())
        .withColumn("__words", word_array(text))
        .withColumn("__lines", lines)
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("__grams", F.expr("CASE WHEN n_words < 3 THEN array() ELSE transform(sequence(0, CAST(n_words AS INT) - 3), i -> xxhash64(get(__words, i), get(__words, i + 1), get(__words, i + 2))) END"))
        .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
        .withColumn("n_symbols", F.expr(f"CAST(length(__text) - length(regexp_replace(__text, '[{SYMBOLS}]', '')) AS BIGINT)"))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("__lines")))
        .withColumn("n_repeat_words", _repeat_words("__words", "__grams"))
        .drop("__text", "__words", "__lines", "__grams")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit_votes(patterns: list[tuple[tuple[int | None, ...], int]]) -> tuple[float, list[float]]:
    """(share of good documents, accuracy of each rule) by EM over vote patterns."""
    n_rules = len(patterns[0][0]) if patterns else 0
    good, accuracy = FIRST_GOOD, [FIRST_ACCURACY] * n_rules
    for _ in range(EM_ROUNDS):
        n = q_sum = 0.0
        right, cast = [0.0] * n_rules, [0.0] * n_rules
        for votes, count in patterns:
            q = posterior(votes, good, accuracy)
            n += count
            q_sum += count * q
            for k, v in enumerate(votes):
                if v is not None:
                    cast[k] += count
                    right[k] += count * (q if v else 1 - q)
        good = min(max(q_sum / n, 0.01), 0.99)
        accuracy = [min(max(r / c, LEAST_ACCURACY), MOST_ACCURACY) if c else FIRST_ACCURACY for r, c in zip(right, cast, strict=True)]
    return good, accuracy


def posterior(votes, good: float, accuracy: list[float]) -> float:
    odds = math.log(good / (1 - good))
    for v, a in zip(votes, accuracy, strict=True):
        if v is not None:
            odds += (1 if v else -1) * math.log(a / (1 - a))
    return 1 / (1 + math.exp(-odds))


def fit_rates(patterns: list[tuple[tuple[int | None, ...], int]]) -> tuple[float, list[float], list[float]]:
    """(share of good documents, each rule's share of bad votes on bad, on good documents) by EM over vote patterns."""
    n_rules = len(patterns[0][0]) if patterns else 0
    good, hit, false = FIRST_GOOD, [FIRST_HIT] * n_rules, [FIRST_FALSE] * n_rules
    for _ in range(EM_ROUNDS):
        n = q_sum = 0.0
        bad_votes, cast = [[0.0, 0.0] for _ in range(n_rules)], [[0.0, 0.0] for _ in range(n_rules)]
        for votes, count in patterns:
            q = rates_posterior(votes, good, hit, false)
            n += count
            q_sum += count * q
            for k, v in enumerate(votes):
                if v is not None:
                    for c, share in enumerate((1 - q, q)):
                        cast[k][c] += count * share
                        bad_votes[k][c] += count * share * (1 - v)
        good = min(max(q_sum / n, 0.01), 0.99)
        hit = [min(max(b[0] / c[0], LEAST_HIT), MOST_HIT) if c[0] else FIRST_HIT for b, c in zip(bad_votes, cast, strict=True)]
        false = [min(max(b[1] / c[1], LEAST_FALSE), MOST_FALSE) if c[1] else FIRST_FALSE for b, c in zip(bad_votes, cast, strict=True)]
    return good, hit, false


def rates_posterior(votes, good: float, hit: list[float], false: list[float]) -> float:
    odds = math.log(good / (1 - good))
    for v, h, f in zip(votes, hit, false, strict=True):
        if v is not None:
            odds += math.log((1 - f) / (1 - h)) if v else math.log(f / h)
    return 1 / (1 + math.exp(-odds))


def accuracy_weights(patterns) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good before any vote, and what each rule's good and bad vote add; one accuracy a rule."""
    good, accuracy = fit_votes(patterns)
    return math.log(good / (1 - good)), [(math.log(a / (1 - a)), -math.log(a / (1 - a))) for a in accuracy]


def rate_weights(patterns) -> tuple[float, list[tuple[float, float]]]:
    """As ``accuracy_weights``, with two rates a rule."""
    good, hit, false = fit_rates(patterns)
    return math.log(good / (1 - good)), [(math.log((1 - f) / (1 - h)), math.log(f / h)) for h, f in zip(hit, false, strict=True)]


def quality_scores(docs: DataFrame, keep: tuple[str, ...] | None = None, weigh=accuracy_weights) -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``quality_posterior`` and ``kept``;
    of its own columns those in ``keep``, all by default.

    The counted rows are written once: the histogram needs all of them before
    the first verdict, and counting the texts twice would double the work.
    """
    counted = materialize(document_counts(docs).select(*(docs.columns if keep is None else keep), "n_lines", *COUNTS), "counts")
    votes = {r: F.expr(vote_sql(r)) for r in RULES}
    histogram = counted.groupBy(*(v.alias(r) for r, v in votes.items())).agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted(((tuple(x[r] for r in RULES), x["n"]) for x in histogram.collect()), key=lambda p: [(-1 if v is None else v) for v in p[0]])
    odds = F.lit(0.0)
    if patterns:
        before, weights = weigh(patterns)
        odds = F.lit(before)
        for (good, bad), v in zip(weights, votes.values(), strict=True):
            odds = odds + F.when(v == 1, good).when(v == 0, bad).otherwise(0.0)
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("quality_posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= 0.5))
    )


@on_plain_names(("doc_id", "text"))
def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its own columns only."""
    return quality_scores(docs, weigh=rate_weights).filter("kept").select(*docs.columns)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    counted = quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))
    return counted.select("doc_id", *COUNTS, "base_failed", "kept")


def _oracle() -> str:
    names = list(RULES)
    votes = ", ".join(f"{vote_sql(r)} AS v{k}" for k, r in enumerate(names))
    keys = ", ".join(f"v{k}" for k in range(len(names)))
    log_odds = "ln(good / (1 - good))" + "".join(f" + CASE v{k} WHEN 1 THEN ln(a{k} / (1 - a{k})) WHEN 0 THEN -ln(a{k} / (1 - a{k})) ELSE 0 END" for k in range(len(names)))
    fitted = ", ".join(
        f"CASE WHEN sum(CASE WHEN v{k} IS NOT NULL THEN n END) > 0 THEN least(greatest(sum(CASE v{k} WHEN 1 THEN n * q WHEN 0 THEN n * (1 - q) END) / sum(CASE WHEN v{k} IS NOT NULL THEN n END), {LEAST_ACCURACY}), {MOST_ACCURACY}) ELSE {FIRST_ACCURACY} END AS a{k}"
        for k in range(len(names))
    )
    first = ", ".join(f"CAST({FIRST_ACCURACY} AS DOUBLE) AS a{k}" for k in range(len(names)))
    accuracies = ", ".join(f"a{k}" for k in range(len(names)))
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
g AS (
  SELECT row_number() OVER () AS rid, *, CASE WHEN len(ws) < 3 THEN [] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END AS gs FROM t),
x AS (SELECT rid, unnest(gs) AS gram, unnest(range(0, len(gs))) AS i FROM g),
d AS (SELECT rid, i FROM x QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
r AS (SELECT rid, CAST(count(DISTINCT w) AS BIGINT) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS w FROM d) GROUP BY rid),
c AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM g LEFT JOIN r USING (rid)),
v AS (SELECT *, {votes} FROM c),
h AS (SELECT {keys}, count(*) AS n FROM v GROUP BY ALL),
em AS (
  SELECT 0 AS k, CAST({FIRST_GOOD} AS DOUBLE) AS good, {first}
  UNION ALL
  SELECT k + 1, least(greatest(sum(n * q) / sum(n), 0.01), 0.99), {fitted}
  FROM (SELECT em.*, h.*, 1 / (1 + exp(-({log_odds}))) AS q FROM em, h WHERE k < {EM_ROUNDS})
  GROUP BY k),
fit AS (SELECT good, {accuracies} FROM em WHERE k = {EM_ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND 1 / (1 + exp(-({log_odds}))) >= 0.5 AS kept
FROM v, fit
"""


ORACLE = _oracle()
