"""Splits, summaries and synthetic variants of training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import hash_bucket


def split_folds(ids: DataFrame, key: str, holdout_percent: int, folds: int) -> DataFrame:
    """key, split, fold, by hash: the same on every engine and in every run."""
    h = hash_bucket(F.col(key), 10_000)
    return ids.select(key, F.when(h < 100 * holdout_percent, "holdout").otherwise("train").alias("split"), (h % folds).alias("fold"))


def summarize(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """dimension, value, n: counts by each dimension, in one pass."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("n"))


def substitute(text: Column, spans: Column, k: Column, new: Column) -> tuple[Column, Column]:
    """(text, spans) with span k's text replaced by ``new`` and later spans moved."""
    old = F.element_at(spans, k)
    shift = F.length(new) - (old["e"] - old["s"])
    moved = F.transform(spans, lambda x: F.struct(F.when(x["s"] >= old["e"], x["s"] + shift).otherwise(x["s"]).alias("s"), F.when(x["e"] >= old["e"], x["e"] + shift).otherwise(x["e"]).alias("e")))
    return F.concat(F.substring(text, F.lit(1), old["s"]), new, F.substring(text, old["e"] + 1, F.length(text))), moved


def threshold_sweep(scored: DataFrame, group: str, value: str, truth: Column, grid: list[float]) -> DataFrame:
    """group, threshold: the first of the grid with the best share of right calls."""
    each = scored.select(group, F.col(value).alias("v"), truth.alias("y"), F.explode(F.array(*(F.lit(t) for t in grid))).alias("threshold"))
    right = each.groupBy(group, "threshold").agg(F.sum(((F.col("v") >= F.col("threshold")) == F.col("y")).cast("long")).alias("right"))
    return right.groupBy(group).agg(F.max_by("threshold", F.struct("right", -F.col("threshold"))).alias("threshold"), F.max("right").alias("right"))


def remainder(all_rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an incremental run has still to do."""
    return all_rows.join(done.select(key).distinct(), key, "left_anti")


def text_pools(parts: list[DataFrame], kind: str, text: str) -> DataFrame:
    """kind, n, pool: the distinct texts of each kind in all parts, sorted."""
    both = None
    for p in parts:
        own = p.select(kind, text)
        both = own if both is None else both.unionByName(own)
    return both.distinct().groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(text)).alias("pool"))


def hash_sample(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """group, key: ``n`` rows of each group in the order of a hash of the key, the same in every run."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(F.md5(F.col(key).cast("string")), key)
    return rows.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).select(group, key)


def fill_template(template: Column, slot: str, value: Column) -> tuple[Column, Column, Column]:
    """(text, start, end): the template with its slot filled and its first letter raised, and where the value stands."""
    at = F.locate(slot, template) - 1
    filled = F.concat(F.substring(template, F.lit(1), at), value, F.substring(template, at + len(slot) + 1, F.length(template)))
    raised = F.concat(F.upper(F.substring(filled, 1, 1)), F.substring(filled, F.lit(2), F.length(filled)))
    return raised, at, at + F.length(value)
