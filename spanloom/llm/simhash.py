"""SimHash near-duplicates with BK-trees.

A document's fingerprint has bit i set if more than half of its three-word
shingles' XXH64 values have it.  Fingerprints link at three differing bits or
fewer; documents that links connect, directly or not, form a component.

Equal fingerprints collapse first, so copies cost one row.  Distinct ones are
dealt to shards that share some of their bits: cut into ``3 + k`` blocks, two
fingerprints at distance three agree in at least ``k`` of them, so each goes to
one shard for every choice of ``k`` blocks and no link is missed.  ``k`` grows
with the number of fingerprints, which keeps shards small.  A shard with over
``HOT_SHARD`` members is cut again, by one of four parts of its other bits, of
which three differing bits leave one alone, and so on, up to ``len(PARTS)`` times.

Each shard builds a BK-tree: a child hangs on the edge that bears its Hamming
distance to the parent, and a search follows only edges within the radius of
its own distance.  The tree stays with the shard's rows; the union of all trees
grows with the corpus and is never broadcast.  A shard reports only links that
join two of its groups, fewer than it has members, and stars of minimal
fingerprints spread over the links until nothing changes.  A component bears the
least id of its rows.

Defined cases: null and empty texts have fingerprint zero and link like any
other.  Fewer than three words: the whole sequence is the one shingle.  Rows
with a null id link like any other; their component_id is null if no row of the
component has an id.  Rows with the same id and other texts are documents of
their own: an id links nothing.  Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, materialize, on_plain_names, own_id, plain_id, table

RADIUS = 3
SHINGLE = 3
SEED = 42
SHARD_ROWS = 64
HOT_SHARD = 4096
#: Each cuts the 64 bits into RADIUS + 1 parts, by one base-4 digit of a bit's number.
PARTS = [[sum(1 << b for b in range(64) if b // 4**d % 4 == j) for j in range(4)] for d in range(3)]


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype="<u8")
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -SHINGLE] + 1))
        digest, seed = xxhash.xxh64_intdigest, SEED
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprint_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "tag": b["tag"], "fp": [_signed(fingerprint(t)) for t in b["text"]]})


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, tag (hash of the text), fp (the 64 bits as a signed long) of each row."""
    printed = docs.select(*plain_id(), F.xxhash64("text").alias("tag"), full_text().alias("text")).mapInPandas(_fingerprint_batches, "doc_id long, no_id boolean, tag long, fp long")
    return printed.select(own_id(), "tag", "fp")


class BKTree:
    """Distinct integers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def within(self, x: int, radius: int) -> list[int]:
        """Positions of the members at most ``radius`` from x."""
        if not self.values:
            return []
        found, todo, values, edges = [], [0], self.values, self.edges
        while todo:
            k = todo.pop()
            d = (values[k] ^ x).bit_count()
            if d <= radius:
                found.append(k)
            own = edges[k]
            if own:
                todo.extend(own[e] for e in range(d - radius, d + radius + 1) if e in own)
        return found

    def add(self, x: int) -> None:
        values, edges, k = self.values, self.edges, 0
        new = len(values)
        values.append(x)
        edges.append({})
        if not new:
            return
        while True:
            d = (values[k] ^ x).bit_count()
            if d not in edges[k]:
                edges[k][d] = new
                return
            k = edges[k][d]


def shard_links(members: list[tuple[int, int]], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of nodes that make a spanning forest of the links among (fingerprint, node)."""
    tree, top, links = BKTree(), list(range(len(members))), []

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i, (fp, node) in enumerate(members):
        for j in tree.within(fp, radius):
            a, b = find(i), find(j)
            if a != b:
                top[a] = b
                links.append((node, members[j][1]))
        tree.add(fp)
    return links


def _shard_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard; a shard may reach over several batches."""
    mask = (1 << 64) - 1
    shard, members = None, []
    for b in batches:
        links = []
        for s, fp, node in zip(b["shard"].tolist(), b["fp"].tolist(), b["node"].tolist(), strict=True):
            if s != shard:
                if len(members) > 1:
                    links += shard_links(members)
                shard, members = s, []
            members.append((fp & mask, node))
        yield pd.DataFrame(links, columns=["u", "v"], dtype="int64")
    if len(members) > 1:
        yield pd.DataFrame(shard_links(members), columns=["u", "v"], dtype="int64")


def shard_masks(n: int) -> list[int]:
    """Masks of the bits that the members of a shard share, for n fingerprints."""
    for k in (1, 2, 3, 4):
        cuts = [64 * i // (RADIUS + k) for i in range(RADIUS + k + 1)]
        blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
        masks = [sum(c) for c in combinations(blocks, k)]
        if n <= SHARD_ROWS << min(m.bit_count() for m in masks):
            break
    return masks


def finer_masks(mask: int, level: int = 0) -> list[int]:
    """``mask`` and one of the parts of all bits each: three bits that differ spare one part."""
    return [mask | part for part in PARTS[level]]


def _sharded(rows: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(_signed(m)).alias("m"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("shard")) for i, m in enumerate(masks)))
    return rows.select("fp", "node", F.explode(keys).alias("k")).select("fp", "node", "k.m", "k.shard")


def _finer(rows: DataFrame, level: int) -> DataFrame:
    def key(j: int):
        mask = F.col("m").bitwiseOR(F.lit(_signed(PARTS[level][j])))
        return F.struct(mask.alias("m"), F.xxhash64("shard", F.lit(j), F.col("fp").bitwiseAND(mask)).alias("shard"))

    return rows.select("fp", "node", F.explode(F.array(*map(key, range(RADIUS + 1)))).alias("k")).select("fp", "node", "k.m", "k.shard")


def fingerprint_links(nodes: DataFrame, hot: int = HOT_SHARD) -> DataFrame:
    """u, v: links among distinct fingerprints (columns fp, node) that connect all that is connected."""
    rest, ready = _sharded(nodes, shard_masks(nodes.count())), None
    for level in range(len(PARTS) + 1):
        sizes = materialize(rest.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
        last = level == len(PARTS) or sizes.filter(F.col("n") > hot).isEmpty()
        few = rest.join(sizes if last else sizes.filter(F.col("n") <= hot), "shard", "left_semi").select("shard", "fp", "node")
        ready = few if ready is None else ready.unionByName(few)
        if last:
            break
        rest = _finer(rest.join(sizes.filter(F.col("n") > hot), "shard", "left_semi"), level)
    return ready.repartition("shard").sortWithinPartitions("shard", "fp").mapInPandas(_shard_batches, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node that links lead to, for each node that has a link.

    Large-star and small-star in turn: a node's larger neighbours, then its
    smaller ones, are linked to the least of all.  The least neighbour comes
    from a pre-aggregated group and meets the links in a join, so a hub's links
    are never gathered in one place.
    """
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def grouped_fingerprints(printed: DataFrame) -> DataFrame:
    """f, root, first: each distinct fingerprint, the least one of its component, and of its
    rows the first: (no id, doc_id, tag), so rows without an id come last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first")
    nodes = materialize(printed.groupBy("fp").agg(first), "nodes")
    found = components(fingerprint_links(nodes.select("fp", F.col("fp").alias("node"))))
    return nodes.join(found, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("f"), F.coalesce("component", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for each row of ``docs``."""
    printed = materialize(fingerprints(docs), "fingerprints")
    grouped = materialize(grouped_fingerprints(printed), "grouped")
    ids = grouped.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    least = materialize(grouped.select("f", "root").join(ids, "root"), "components")
    return printed.join(least, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


@on_plain_names(("doc_id", "text"))
def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of its least id.

    Of several rows with that id in the component the one with the least hash of
    its text stays.  A component without any id keeps the row with the least hash.
    """
    key = lambda i, tag: (F.isnull(i).alias("__none"), F.coalesce(F.col(i).cast("long"), F.lit(0)).alias("__id"), tag.alias("__tag"))
    printed = materialize(fingerprints(docs), "fingerprints")
    keepers = materialize(grouped_fingerprints(printed).groupBy("root").agg(F.min("first").alias("first")).select("first.*").select(*key("doc_id", F.col("tag"))), "keepers")
    # equal rows of one component: the window leaves one of them, on the join's own partitions
    turn = Window.partitionBy("__none", "__id", "__tag").orderBy("__tag")
    tagged = docs.select("*", *key("doc_id", F.xxhash64("text")))
    kept = tagged.join(keepers, ["__none", "__id", "__tag"], "left_semi").withColumn("__turn", F.row_number().over(turn)).filter("__turn = 1")
    return kept.select(*(docs[c] for c in docs.columns))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
