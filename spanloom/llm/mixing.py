"""Mixing sources to target weights by pivotal dependent rounding (native).

Each source has a target share of all words; a document of a source is to be
taken ``target / source size`` times.  The whole part of that is fixed; the
fraction is a probability, and pivotal rounding settles it: two documents with
open probabilities meet, and words (probability times size) move from one to
the other, in a random direction whose odds leave both expectations as they
were, until one of them is integral.  The other one goes on to the next duel.
Words never appear or vanish in a duel, so a source ends within one document's
size of its target.

The duels form a reduction tree.  Documents are dealt to buckets of about
``BUCKET``; a bucket folds its documents one after another and passes one open
document on; the open documents of all buckets are dealt again, until one bucket
is left for each source.  Its last open document takes the nearer whole number,
and documents of that bucket that bring the source closer to its target, tried
from the largest down, change sides.  A hot source just has more
buckets, no group is larger than a few hundred rows, and every level handles a
``BUCKET``-th of the one before.  All draws are hashes of ids, so reruns agree.

Defined cases: a null text has size 0; null is a source of its own, the last.
A document of size 0 has nothing to move; it is taken the whole part of times.
Rows that repeat are settled each for itself.  A null id draws like any other.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, materialize, on_plain_names, table, word_array

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BUCKET = 256
SEED = 20240607


def text_size(text: Column) -> Column:
    """Number of words."""
    return F.size(word_array(text)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, n_docs, source_size, target: one row for each source.

    Sources by code point, null last, have the given weights in turn.  Targets
    share the sum of all sizes by weight and stop at ``most`` times the source's
    size.  In order of size per weight, those that stop come first: a source
    stops if the words that the earlier ones left, shared over the weights from
    it on, would exceed its own limit.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    limit = F.col("source_size") * float(most)
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none = F.lit(0.0)
    return (
        sources.withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("all_weights", F.sum("weight").over(whole))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum(limit).over(before), none))
        .withColumn("left_weights", F.col("all_weights") - F.coalesce(F.sum("weight").over(before), none))
        .withColumn("stops", F.col("left_words") * F.col("weight") > limit * F.col("left_weights"))
        .withColumn("free_words", F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), limit)).over(whole), none))
        .withColumn("free_weights", F.sum(F.when(~F.col("stops"), F.col("weight"))).over(whole))
        .select("source", "n_docs", F.col("source_size").cast("long").alias("source_size"), F.when(F.col("stops"), limit).otherwise(F.col("free_words") * F.col("weight") / F.col("free_weights")).alias("target"))
    )


def _uniform(*what: str) -> str:
    return f"(pmod(xxhash64({', '.join(what)}), 1048576) + 0.5D) / 1048576D"


#: One duel of the open document ``a.c`` and the next one ``x``; ``up`` words or
#: ``down`` words can move.  Taking the smaller of two limits makes one of the
#: two documents exactly 0 or 1.
_FOLD = """
aggregate(
  slice(xs, 2, size(xs)),
  named_struct('done', cast(array() AS array<struct<r:bigint,key:bigint,size:bigint,p:double>>), 'c', xs[0]),
  (a, x) -> transform(
    transform(
      array(named_struct('up', least((1 - a.c.p) * a.c.size, x.p * x.size), 'down', least(a.c.p * a.c.size, (1 - x.p) * x.size))),
      m -> named_struct('m', m, 'rise', {draw} * (m.up + m.down) < m.down)),
    d -> CASE
      WHEN d.rise AND (1 - a.c.p) * a.c.size <= x.p * x.size THEN named_struct(
        'done', concat(a.done, array(named_struct('r', a.c.r, 'key', a.c.key, 'size', a.c.size, 'p', 1.0D))),
        'c', named_struct('r', x.r, 'key', x.key, 'size', x.size, 'p', greatest(0.0D, x.p - d.m.up / x.size)))
      WHEN d.rise THEN named_struct(
        'done', concat(a.done, array(named_struct('r', x.r, 'key', x.key, 'size', x.size, 'p', 0.0D))),
        'c', named_struct('r', a.c.r, 'key', a.c.key, 'size', a.c.size, 'p', least(1.0D, a.c.p + d.m.up / a.c.size)))
      WHEN a.c.p * a.c.size <= (1 - x.p) * x.size THEN named_struct(
        'done', concat(a.done, array(named_struct('r', a.c.r, 'key', a.c.key, 'size', a.c.size, 'p', 0.0D))),
        'c', named_struct('r', x.r, 'key', x.key, 'size', x.size, 'p', least(1.0D, x.p + d.m.down / x.size)))
      ELSE named_struct(
        'done', concat(a.done, array(named_struct('r', x.r, 'key', x.key, 'size', x.size, 'p', 1.0D))),
        'c', named_struct('r', a.c.r, 'key', a.c.key, 'size', a.c.size, 'p', greatest(0.0D, a.c.p - d.m.down / a.c.size)))
    END)[0])
"""


#: The last bucket of a source: ``c`` is rounded, then ``done`` evens out the error.
_BALANCE = """
aggregate(
  reverse(sort_array(transform(done, d -> named_struct('size', d.size, 'r', d.r, 'key', d.key, 'p', d.p)))),
  named_struct('e', (round(c.p) - c.p) * c.size, 'out', array(named_struct('r', c.r, 'key', c.key, 'size', c.size, 'p', round(c.p)))),
  (a, x) -> transform(
    array(CASE WHEN x.p > 0.5 AND abs(a.e - x.size) < abs(a.e) THEN -1.0D WHEN x.p < 0.5 AND abs(a.e + x.size) < abs(a.e) THEN 1.0D ELSE 0.0D END),
    m -> named_struct('e', a.e + m * x.size, 'out', concat(a.out, array(named_struct('r', x.r, 'key', x.key, 'size', x.size, 'p', x.p + m)))))[0],
  a -> a.out)
"""


def _level(open_rows: DataFrame, sources: DataFrame, level: int, seed: int, bucket: int) -> DataFrame:
    """source, done (array of settled documents), c (the open one): a row for each bucket."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / float(bucket ** (level + 1))))
    return (
        open_rows.join(sources.select(F.col("source").alias("__s"), "n_docs"), F.col("source").eqNullSafe(F.col("__s")))
        .groupBy("source", F.pmod(F.xxhash64("r", F.lit(seed + level)), buckets).alias("b"))
        .agg(F.sort_array(F.collect_list(F.struct("r", "key", "size", "p"))).alias("xs"))
        .select("source", F.expr(_FOLD.format(draw=_uniform("a.c.r", "x.r", "a.c.key", "x.key", str(seed)))).alias("f"))
        .select("source", "f.done", "f.c")
    )


def pivotal_rounding(rows: DataFrame, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """source, key, size, p with p 0 or 1, from rows with p between 0 and 1.

    ``rows`` has source, key (long), size (positive) and p.  In each source the
    sum of p * size changes by half of one row's size at most.
    """
    rows = materialize(rows.select("source", "key", "size", "p", F.xxhash64("key", "size", F.lit(seed)).alias("r")), "open")
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    most = sources.agg(F.max("n_docs")).first()[0] or 0
    settled, open_rows, level = [], rows, 0
    while most > bucket ** (level + 1):
        folded = materialize(_level(open_rows, sources, level, seed, bucket), f"level{level}")
        settled.append(folded.select("source", F.explode("done").alias("d")))
        open_rows, level = folded.select("source", "c.*"), level + 1
    settled.append(_level(open_rows, sources, level, seed, bucket).select("source", F.explode_outer(F.expr(_BALANCE)).alias("d")))
    out = settled[0]
    for one in settled[1:]:
        out = out.unionByName(one)
    return out.select("source", "d.key", "d.size", "d.p")


def mix_sources(docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """key, source, size, source_size, target, base, copies for each row of ``docs`` (columns key, source, size)."""
    sized = docs.select(F.col(key).cast("long").alias("key"), "source", "size")
    targets = materialize(source_targets(sized, weights, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = targets.select(F.col("source").alias("__s"), "source_size", "target", F.floor(ratio).alias("base"), (ratio - F.floor(ratio)).alias("p"))
    joined = sized.join(shares, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    moving = (F.col("p") > 0) & (F.col("size") > 0)
    fixed = joined.filter(~moving).select("source", "key", "size", F.lit(0.0).alias("p"))
    drawn = pivotal_rounding(joined.filter(moving), seed)
    return (
        drawn.unionByName(fixed)
        .join(shares.drop("p"), F.col("source").eqNullSafe(F.col("__s")))
        .select("key", "source", "size", "source_size", "target", "base", (F.col("base") + F.col("p").cast("long")).alias("copies"))
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", text_size(full_text()).alias("size")), "sizes")
    mixed = mix_sources(sized)
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


@on_plain_names(("doc_id", "text", "source"))
def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mix takes it.

    Rows are told apart by id and a hash of text and source.  Of rows that are
    equal in these, which share one decision count, the first ones get the
    larger number of copies.
    """
    tag = F.xxhash64("doc_id", "text", "source")
    sized = materialize(docs.select(tag.alias("key"), "source", text_size(full_text()).alias("size")), "sizes")
    taken = mix_sources(sized, "key", weights, most, seed).groupBy("key").agg(F.min("base").alias("__base"), F.sum(F.col("copies") - F.col("base")).alias("__more"))
    joined = docs.withColumn("__tag", tag).join(taken, F.col("__tag") == F.col("key"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    copies = F.col("__base") + F.when(turn <= F.col("__more"), 1).otherwise(0)
    return joined.withColumn("__n", copies.cast("int")).filter("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*(docs[c] for c in docs.columns))
