"""Spans of one document: folds, decoding, windows.

The greedy operators keep a document's mentions as one array, sorted by the
priority of the rule, and fold it natively; a document has tens of mentions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def greedy_disjoint(sorted_spans: Column, start: str = "s", end: str = "e") -> Column:
    """The spans that overlap none kept before them, in the order given."""
    hit = lambda x, y: F.greatest(x[start], y[start]) < F.least(x[end], y[end])
    return F.aggregate(sorted_spans, F.slice(sorted_spans, 1, 0), lambda kept, x: F.when(F.exists(kept, lambda y: hit(x, y)), kept).otherwise(F.concat(kept, F.array(x))))


def resolve_overlaps(mentions: DataFrame, group: str, priority: list[Column], fields: list[str]) -> DataFrame:
    """``mentions`` without those that overlap one of higher priority in their group.

    ``fields`` begins with the start and the end.
    """
    key = [p.alias(f"k{i}") for i, p in enumerate(priority)]
    packed = F.array_sort(F.collect_list(F.struct(*key, *(F.col(c) for c in fields))))
    kept = greedy_disjoint(packed, fields[0], fields[1])
    return mentions.groupBy(group).agg(kept.alias("kept")).select(group, F.explode("kept").alias("m")).select(group, *(F.col(f"m.{c}").alias(c) for c in fields))


def dedupe_edge(mentions: DataFrame, key: list[str], order: str, tags: str, edge: str, plain: Column | None = None) -> DataFrame:
    """One row for each key: the union of the tags of those not cut by a window's
    edge, or of all if every one is.

    Where ``plain`` holds, which looks at the key alone, types bear no assertions
    and the first row in ``order`` stays as it is.
    """
    inner = F.min(F.col(edge).cast("int")) == 0
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    united, cut = F.when(inner, flat(F.when(~F.col(edge), F.col(tags)))).otherwise(flat(F.col(tags))), ~inner
    if plain is not None:
        first = F.bool_or(plain)
        united, cut = F.when(first, F.min_by(tags, order)).otherwise(united), F.when(first, F.min_by(edge, order)).otherwise(cut)
    return mentions.groupBy(*key).agg(united.alias(tags), cut.alias(edge), F.min(order).alias(order))


def decode_bio(tokens: DataFrame, group: list[str], order: list[str], label: str = "label") -> DataFrame:
    """group, span, type, first, last, n: runs of one type.

    ``B-x`` begins a span; ``I-x`` goes on with the one before it if that is of
    type x, else it begins one.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    kind = F.when(F.col(label) != "O", F.expr(f"substring(`{label}`, 3)"))
    marked = tokens.withColumn("type", kind).withColumn("before", F.lag("type").over(w)).withColumn("at", F.row_number().over(w) - 1)
    new = F.col("type").isNotNull() & ~(F.col(label).startswith("I-") & F.col("type").eqNullSafe(F.col("before")))
    spans = marked.withColumn("span", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("type IS NOT NULL")
    return spans.groupBy(*group, "span", "type").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))


def token_windows(n: Column, size: int, stride: int) -> Column:
    """Array of (start, end): windows of ``size`` that share ``stride`` tokens; the last ends at n."""
    step = size - stride
    count = F.when(n <= size, 1).otherwise(F.ceil((n - size) / step).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i * step).cast("int").alias("s"), F.least(i * step + size, n).cast("int").alias("e")))


def merge_fragments(sorted_spans: Column, text: Column, gap: int = 4) -> Column:
    """Joins neighbours when only word characters, at most ``gap`` of them, lie between;
    the longer side gives the type."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        between = F.substring(text, last["e"] + 1, x["s"] - last["e"])
        joins = (F.size(acc) > 0) & (x["s"] >= last["e"]) & (x["s"] - last["e"] <= gap) & between.rlike("^[\\p{L}\\p{N}_]*$")
        longer = F.when(x["e"] - x["s"] > last["e"] - last["s"], x["type"]).otherwise(last["type"])
        both = F.struct(last["s"].alias("s"), x["e"].alias("e"), longer.alias("type"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(sorted_spans, F.slice(sorted_spans, 1, 0), step)


def remove_nested(mentions: DataFrame, group: str, start: str, end: str, kind: str, under: dict[str, list[str]] | None = None) -> DataFrame:
    """Without the mentions that a longer one of the same kind in the group contains, or one of
    the kinds that ``under`` names for theirs."""
    a, b = mentions.alias("a"), mentions.select(group, start, end, kind).alias("b")
    col = lambda t, c: F.col(f"{t}.{c}")
    kinds = col("a", kind) == col("b", kind)
    for lesser, greater in (under or {}).items():
        kinds = kinds | ((col("a", kind) == lesser) & col("b", kind).isin(greater))
    longer = col("b", end) - col("b", start) > col("a", end) - col("a", start)
    inside = (col("a", group) == col("b", group)) & kinds & (col("b", start) <= col("a", start)) & (col("a", end) <= col("b", end)) & longer
    return a.join(b, inside, "left_anti")


def assign_windows(windows: DataFrame, mentions: DataFrame, group: str) -> DataFrame:
    """Mentions (s, e) that lie whole in a window (ws, we) of their group, moved to its origin."""
    return windows.join(mentions, group).filter("s >= ws AND e <= we").withColumn("s", F.col("s") - F.col("ws")).withColumn("e", F.col("e") - F.col("ws"))


def order_faults(mentions: DataFrame, group: str, order: list[str], key: list[str]) -> DataFrame:
    """group, unsorted, duplicates: mentions that sort before the one ahead of them in ``order``,
    and how many times a mention comes again with the same ``key``."""
    w = Window.partitionBy(group).orderBy(*order)
    own = F.struct(*key)
    again = mentions.groupBy(group, *key).agg((F.count(F.lit(1)) - 1).alias("d")).groupBy(group).agg(F.sum("d").alias("duplicates"))
    back = mentions.withColumn("u", (own < F.lag(own).over(w)).cast("long")).groupBy(group).agg(F.coalesce(F.sum("u"), F.lit(0)).alias("unsorted"))
    return back.join(again, group).select(group, "unsorted", "duplicates")


def trimmed(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """(start, end) of a span without the white space at its ends."""
    own = F.substring(text, start + 1, end - start)
    left = F.length(F.regexp_extract(own, "(?U)^\\s*", 0))
    bare = F.regexp_replace(own, "(?U)\\s+$", "")
    return F.least(start + left, end), F.greatest(start + F.length(bare), F.least(start + left, end))
