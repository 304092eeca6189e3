"""Scores of predicted mentions against true ones: word error rate and Jaccard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EMPTY = "__EMPTY__"
#: Shares of the final score: text, assertions, candidates.
WEIGHTS = (0.3, 0.3, 0.4)


def jaccard(a: Column, b: Column) -> Column:
    """1 for two empty sets, 0 for one."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def with_occurrence(mentions: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """occ: number of the mention among those with the same key, from 0, in order."""
    return mentions.withColumn("occ", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def value_items(mentions: DataFrame, values: str, by_occurrence: bool = True) -> DataFrame:
    """doc_id, item: one for each value of a mention; an empty list counts as one value."""
    keyed = with_occurrence(mentions, ["doc_id", "text", "type"], ["start_pos", "end_pos"]) if by_occurrence else mentions.withColumn("occ", F.lit(0))
    listed = F.when(F.size(values) == 0, F.array(F.lit(EMPTY))).otherwise(F.col(values))
    return keyed.withColumn("v", F.explode(listed)).select("doc_id", F.concat_ws("\t", "text", "type", F.col("occ").cast("string"), "v").alias("item")).distinct()


def set_similarity(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """doc_id, j: Jaccard of the items of each document of either side.

    Items meet in one pre-aggregated shuffle; no set is ever built.
    """
    both = truth.select("doc_id", "item", F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(predicted.select("doc_id", "item", F.lit(0).alias("t"), F.lit(1).alias("p")))
    items = both.groupBy("doc_id", "item").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    return items.groupBy("doc_id").agg((F.sum(F.col("t") * F.col("p")) / F.count(F.lit(1))).alias("j"))


def candidate_weights(mentions: DataFrame) -> DataFrame:
    """doc_id, w: one for each coded mention and each of its codes."""
    return mentions.groupBy("doc_id").agg(F.sum(F.size("candidates") + 1).alias("w"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.coalesce(F.sum(value * weight) / F.sum(weight), F.lit(1.0))


def edit_distance(a: Column, b: Column) -> Column:
    """Between two arrays of words, unit costs; a row of the table after each word of ``a``."""
    first = F.sequence(F.lit(0), F.size(b))

    def row(prev: Column, word: Column) -> Column:
        costs = F.zip_with(F.slice(prev, 1, F.size(b)), F.slice(prev, 2, F.size(b)), lambda d, u: F.struct(d.alias("d"), u.alias("u")))
        steps = F.zip_with(costs, b, lambda c, w: F.least(c["u"] + 1, c["d"] + F.when(w == word, 0).otherwise(1)))
        return F.aggregate(steps, F.array(F.element_at(prev, 1) + 1), lambda acc, s: F.concat(acc, F.array(F.least(s, F.element_at(acc, -1) + 1))))

    return F.element_at(F.aggregate(a, first, row), -1)


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """May exceed 1; against no words it is 0 or 1."""
    return F.when(F.size(reference) == 0, F.when(F.size(hypothesis) == 0, 0.0).otherwise(1.0)).otherwise(edit_distance(reference, hypothesis) / F.size(reference))


def final_score(text: Column, assertions: Column, candidates: Column) -> Column:
    return WEIGHTS[0] * text + WEIGHTS[1] * assertions + WEIGHTS[2] * candidates


def word_stream(mentions: DataFrame, typed: bool = True) -> DataFrame:
    """doc_id, words: the words of a document's mentions in order, each after its mention's type if ``typed``.
    Columns: doc_id, text, type, start_pos, end_pos."""
    packed = F.array_sort(F.collect_list(F.struct("start_pos", "end_pos", "type", "text")))
    words = lambda m: F.filter(F.split(m["text"], "(?U)\\s+"), lambda w: w != "")
    named = lambda m: F.transform(words(m), lambda w: F.concat(m["type"], F.lit("\t"), w)) if typed else words(m)
    return mentions.groupBy("doc_id").agg(F.flatten(F.transform(packed, named)).alias("words"))


def score_documents(truth: DataFrame, predicted: DataFrame, asserted: tuple[str, ...], coded: tuple[str, ...]) -> DataFrame:
    """num_scored, wer, j_assertions, j_candidates, final: one row over all documents of either side.

    Columns of both: doc_id, text, type, start_pos, end_pos, assertions, candidates.
    """
    ids = truth.select("doc_id").union(predicted.select("doc_id")).distinct()
    none = F.array().cast("array<string>")
    a, b = word_stream(truth).withColumnRenamed("words", "ref"), word_stream(predicted).withColumnRenamed("words", "hyp")
    text = ids.join(a, "doc_id", "left").join(b, "doc_id", "left").select("doc_id", word_error_rate(F.coalesce("ref", none), F.coalesce("hyp", none)).alias("wer"))
    only = lambda m, types, v, name: set_similarity(value_items(truth.filter(F.col("type").isin(*types)), v), value_items(m.filter(F.col("type").isin(*types)), v)).withColumnRenamed("j", name)
    each = text.join(only(predicted, asserted, "assertions", "ja"), "doc_id", "left").join(only(predicted, coded, "candidates", "jc"), "doc_id", "left")
    each = each.join(candidate_weights(truth.filter(F.col("type").isin(*coded))), "doc_id", "left").select("doc_id", "wer", F.coalesce("ja", F.lit(1.0)).alias("ja"), F.coalesce("jc", F.lit(1.0)).alias("jc"), F.coalesce("w", F.lit(0)).alias("w"))
    weighted = F.when(F.sum("w") > 0, F.sum(F.col("jc") * F.col("w")) / F.sum("w")).otherwise(1.0)
    means = each.agg(F.count(F.lit(1)).alias("num_scored"), F.avg("wer").alias("wer"), F.avg("ja").alias("j_assertions"), weighted.alias("j_candidates"))
    return means.withColumn("final", final_score(1 - F.col("wer"), F.col("j_assertions"), F.col("j_candidates")))
