"""Line dedup by an exact set-similarity join (native).

A line's tokens are its five-word shingles, as a set; a line of fewer words is
one token.  Two lines match if the Jaccard similarity of their sets is
``SIMILARITY`` or more.  A line goes if a line before it, in a document with a
smaller id or higher up in its own, matches it.  Lines without a word stay.

First, lines that can match no other are put aside.  Of each line the tokens with
the least hashes are written, ``EXTRA`` more than the ``n - ceil(SIMILARITY * n)
+ 1`` of n of which two matching lines share at least one, so they share so many
more.  Each such token's least and greatest line keys, combined before the
shuffle, tell whether distinct lines share it.  Only lines with enough of such
tokens go on, few in most corpora; equal lines have met by then.

Of those that go on, the first of equal ones is looked up for its whole set, and
the similarity join proper begins:

1. Their tokens are counted.  A line of which too few tokens come again can't match
   and goes no further.  A token becomes a long, its level of frequency, then its
   hash, so that plain sorting puts rare ones first.
2. A pair meets at a token in the prefixes of both.  The larger line's prefix is
   as above, the smaller one's only ``n - ceil(2s / (1 + s) * n) + 1`` long, for
   similarity s.  A token with many lines is dealt to blocks of ``BLOCK``.
3. Inside the join, a pair passes the length filter, the positional filter,
   parity bitmaps (which bound the difference of two sets) and the rule that this
   is the first token that the two share, so that it comes out once.  Hardly any
   but links leave the join; the whole sets of these decide, and links are
   combined by line at once.

Tokens are compared by 56-bit hashes and their level, lines by 64-bit hashes.

Defined cases: null and empty texts have no lines that could go.  Null ids count
as the smallest.  Rows with the same id (or none) and other texts are documents
of their own, in order of a hash of the text; rows with the same id and text are
at the same place, so they don't remove each other's lines, and lose the same.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, materialize, on_plain_names, table, word_array

SHINGLE = 5
SIMILARITY = (4, 5)
#: Tokens of a line that are written beyond the prefix.
EXTRA = 2
#: Bits of a token below its level.
HASH_BITS = 56
#: Lines of a token's posting list that one block has on its earlier side.
BLOCK = 1024
#: Slots of the filters that keep most rows out of a join; a filter has at most so many rows, each with 64 bits.
SLOTS = 1 << 20
#: Longs of a set's parity bitmap: bits that differ in two of them are no more than the tokens that only one set has.
PARITY = 4
NO_ID = -(1 << 63)
#: A line's place: id, hash of the text, number.  Structs of them compare in this order.
PLACE = ("doc", "tag", "line_no")


def prefix_length(n: str) -> str:
    """Tokens of a set of n that share one with any matching set."""
    a, b = SIMILARITY
    return f"({n} - CAST(ceil({n} * {a} / {b}) AS INT) + 1)"


def short_prefix_length(n: str) -> str:
    """As ``prefix_length``, against the prefix of a set that is no smaller."""
    return f"({n} - {overlap(n, n)} + 1)"


def overlap(n: str, m: str) -> str:
    """Tokens that sets of n and m tokens must share to match."""
    a, b = SIMILARITY
    return f"CAST(ceil(({n} + {m}) * {a} / {a + b}) AS INT)"


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _tag() -> Column:
    """Tells texts of rows with one id apart."""
    return F.xxhash64(full_text())


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, tag, line_no, line, key: each line that has a word."""
    own = docs.select(_doc().alias("doc"), _tag().alias("tag"), full_text().alias("t"))
    lines = own.select("doc", "tag", F.posexplode_outer(F.split("t", "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike("[^\\x20\\x09-\\x0D]")).withColumn("key", F.xxhash64("line"))


def shingle_set(lines: DataFrame) -> DataFrame:
    """``lines`` with raw, the distinct hashes of the runs of ``SHINGLE`` words, or of all words if there are fewer."""
    # the hashes stay in a lambda's variable: read from a column, the array would be unpacked again for each of a shingle's words
    hashed = lines.withColumn("hs", F.transform(F.array(word_array(F.col("line"))), lambda ws: F.transform(ws, lambda w: F.xxhash64(w)))).drop("line")
    more = ", ".join(f"get(h, i + {j})" for j in range(1, SHINGLE))
    raw = f"CASE WHEN size(h) < {SHINGLE} THEN array(xxhash64(h)) ELSE transform(slice(h, 1, size(h) - {SHINGLE - 1}), (x, i) -> xxhash64(x, {more})) END"
    return hashed.withColumn("raw", F.array_distinct(F.expr(f"get(transform(hs, h -> {raw}), 0)"))).drop("hs")


def by_rarity(sets: DataFrame) -> DataFrame:
    """``sets`` with tokens, rarest first, without those that share too few with all others together."""
    each = sets.select("key", F.explode("raw").alias("r"))
    counts = materialize(each.groupBy("r").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "counts")
    level = F.floor(3 * F.log2("c")).cast("long")  # under 128 for any count
    bare = lambda r: F.shiftrightunsigned(r, 64 - HASH_BITS)
    shared = each.join(counts.hint("shuffle_hash"), "r").select("key", F.shiftleft(level, HASH_BITS).bitwiseOR(bare("r")).alias("t")).groupBy("key").agg(F.collect_list("t").alias("s"))
    a, b = SIMILARITY
    alone = F.array_except(F.transform("raw", bare), F.transform("s", lambda t: t.bitwiseAND(F.lit((1 << HASH_BITS) - 1))))
    return sets.join(shared, "key").filter(F.size("s") * b >= F.col("n") * a).withColumn("tokens", F.sort_array(F.concat(alone, "s"))).drop("raw", "s")


def _slot(c) -> Column:
    """Of a hash, or of several columns."""
    return F.pmod(_hash(c), F.lit(SLOTS)).cast("int")


def _hash(c) -> Column:
    return F.xxhash64(*c) if isinstance(c, tuple) else F.col(c)


def _bit(c) -> Column:
    """One of the 64 of a slot, by other bits of the hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(_hash(c), SLOTS.bit_length() - 1).bitwiseAND(F.lit(63)).cast("int"))


def _in_slots(rows: DataFrame, wanted: DataFrame, c) -> DataFrame:
    """``rows`` without most of those whose ``c`` isn't in ``wanted``."""
    slots = wanted.select(_slot(c).alias("__slot"), _bit(c).alias("__bit")).groupBy("__slot").agg(F.bit_or("__bit").alias("__bits"))
    held = (_slot(c) == F.col("__slot")) & (F.col("__bits").bitwiseAND(_bit(c)) != 0)
    return rows.join(F.broadcast(slots), held, "left_semi")  # ``SLOTS`` rows at most


def line_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, links): key and place of each line; b, links, near: for each line (its key) that
    distinct lines before it match, how many they are and the place of the first."""
    size = "size(raw)"
    length = f"least({size}, {prefix_length(size)} + {EXTRA})"
    ours = F.expr(f"slice(sort_array(raw), 1, {length})").alias("prefix"), F.expr(f"{length} - {prefix_length(size)} + 1").alias("least")
    lines = materialize(shingle_set(lines_of(docs)).select("key", *PLACE, *ours), "lines")
    shared = materialize(lines.select("key", F.explode("prefix").alias("t")).groupBy("t").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b").select("t"), "shared")
    # equal lines have the same prefix, so a bit for each place in it counts its tokens once; those far down count as enough
    posted = lines.select("key", "least", F.posexplode("prefix").alias("i", "t"))
    seen = F.bit_or(F.expr(f"CASE WHEN i < {63 - EXTRA} THEN shiftleft(1L, i) ELSE {-(1 << (63 - EXTRA))}L END"))
    held = _in_slots(posted, shared, "t").join(shared.hint("shuffle_hash"), "t", "left_semi").groupBy("key").agg(F.max("least").alias("least"), F.bit_count(seen).alias("c"))
    keys = materialize(held.filter("c >= least").select("key"), "keys")
    # whole sets of the lines that go on, each looked up at its first place
    places = _in_slots(lines.select("key", *PLACE), keys, "key").join(keys, "key", "left_semi")
    firsts = materialize(places.groupBy("key").agg(F.min(F.struct(*PLACE)).alias("first")).select("key", "first.*"), "firsts")
    own = docs.select(_doc().alias("doc"), _tag().alias("tag"), "doc_id", "text")
    some = _in_slots(lines_of(_in_slots(own, firsts, ("doc", "tag"))), firsts, "key")
    found = some.join(firsts, ["key", *PLACE]).dropDuplicates(["key"])
    sets = materialize(shingle_set(found).withColumn("n", F.size("raw")), "sets")
    return lines.select("key", *PLACE), materialize(_matches(sets), "near")


def _matches(sets: DataFrame) -> DataFrame:
    """b, links, near: see ``line_links``."""
    parity = F.array(*(F.expr(f"aggregate(filter(tokens, t -> pmod(t, {PARITY}) = {k}), 0L, (b, t) -> b ^ shiftleft(1L, CAST(pmod(t DIV {PARITY}, 64) AS INT)))") for k in range(PARITY)))
    ordered = materialize(by_rarity(sets).withColumn("bits", parity), "ordered")
    tokens = ordered.select(F.explode(F.expr(f"slice(tokens, 1, {prefix_length('n')})")).alias("t"))
    blocks = materialize(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("t", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")), "blocks")
    columns = ("key", *PLACE, "n", "bits", "prefix")

    def listed(length: str, side: str) -> DataFrame:
        own = ordered.withColumn("prefix", F.expr(f"slice(tokens, 1, {length})")).select(F.posexplode("prefix").alias("i", "t"), *columns)
        return own.join(blocks, "t").select("t", "blocks", *(F.col(c).alias(f"{side}_{c}") for c in ("i", *columns)))

    large = listed(prefix_length("n"), "a").withColumn("s", F.pmod("a_key", F.col("blocks").cast("long")).cast("int"))
    small = listed(short_prefix_length("n"), "b").withColumnRenamed("t", "u").withColumn("v", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    before = lambda x, y: f"({x}_doc < {y}_doc OR {x}_doc = {y}_doc AND ({x}_tag < {y}_tag OR {x}_tag = {y}_tag AND {x}_line_no < {y}_line_no))"
    x, y = SIMILARITY
    need = overlap("a_n", "b_n")
    differing = " + ".join(f"bit_count(get(a_bits, {k}) ^ get(b_bits, {k}))" for k in range(PARITY))
    match = F.expr(
        f"""t = u AND s = v AND a_key <> b_key AND (a_n > b_n OR a_n = b_n AND a_key > b_key) AND {y} * b_n >= {x} * a_n
        AND least(a_n - a_i, b_n - b_i) >= {need}
        AND {differing} <= a_n + b_n - 2 * {need}
        AND NOT arrays_overlap(slice(a_prefix, 1, a_i), slice(b_prefix, 1, b_i))"""
    )
    place = lambda side: F.struct(*(F.col(f"{side}_{c}").alias(c) for c in PLACE))
    first = F.expr(before("a", "b"))
    pairs = large.drop("blocks").join(small, match).select("a_key", "b_key", F.expr(need).alias("need"), F.when(first, F.col("b_key")).otherwise(F.col("a_key")).alias("b"), F.when(first, place("a")).otherwise(place("b")).alias("place"))
    side = lambda x: ordered.select(F.col("key").alias(f"{x}_key"), F.col("tokens").alias(x))
    links = materialize(pairs, "pairs").join(side("a"), "a_key").join(side("b").withColumnRenamed("b", "other"), "b_key").filter("size(array_intersect(a, other)) >= need")
    return links.groupBy("b").agg(F.count(F.lit(1)).alias("links"), F.min("place").alias("near"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc, tag, line_no, links, first_doc: each line that goes, how many distinct lines before it
    match it, and the document of the first of all that do."""
    lines, near = line_links(docs)
    repeated = lines.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    keys = materialize(repeated.union(near.select("b")).distinct(), "repeated")
    ours = materialize(_in_slots(lines, keys, "key").join(keys, "key", "left_semi"), "ours")
    known = ours.groupBy("key").agg(F.min(F.struct(*PLACE)).alias("same")).join(near, F.col("key") == F.col("b"), "left").select("key", "same", "near", "links")
    return (
        ours.join(known, "key")
        .withColumn("first", F.coalesce(F.least("same", "near"), "same"))
        .filter(F.col("first") < F.struct(*PLACE))
        .select(*PLACE, F.coalesce("links", F.lit(0)).alias("links"), F.col("first.doc").alias("first_doc"))
        .distinct()
    )


def _with_removals(docs: DataFrame) -> DataFrame:
    """``docs`` with __gone (numbers of the lines that go), __links, __first (document)."""
    gone = removed_lines(docs).groupBy("doc", "tag").agg(F.collect_list("line_no").alias("__gone"), F.sum("links").alias("__links"), F.min("first_doc").alias("__first"))
    own = docs.withColumn("__doc", _doc()).withColumn("__tag", _tag())
    # the same plan whatever the size of ``gone``, which grows with the corpus
    return own.join(materialize(gone, "gone").hint("merge"), (F.col("__doc") == F.col("doc")) & (F.col("__tag") == F.col("tag")), "left").drop("doc", "tag")


def _with_kept(done: DataFrame) -> DataFrame:
    """``done`` (from ``_with_removals``) with __text, what is left of the text."""
    left = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone), i -> get(__lines, i)), '\n')")
    split = done.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split(full_text(), "\n")))
    return split.withColumn("__text", F.when(F.col("__gone").isNull(), full_text()).otherwise(left)).drop("__lines")


@on_plain_names(("doc_id", "text", "n_chars"))
def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that go.  Documents stay, though no line be left;
    a column n_chars follows the text."""
    done = _with_kept(_with_removals(docs))
    changed = {"text": F.when(F.col("__gone").isNull(), docs["text"]).otherwise(F.col("__text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__gone").isNull(), docs["n_chars"]).otherwise(F.length("__text")).cast(docs.schema["n_chars"].dataType)
    return done.select(*(changed.get(c, docs[c]).alias(c) for c in docs.columns))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the first document that a line of this one repeats, or itself), n_links
    (matching distinct lines before its lines), n_lines, n_removed, kept_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _with_kept(_with_removals(docs)).select(
        "doc_id",
        F.when(F.col("__first") != NO_ID, F.least("doc_id", "__first")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("__links", F.lit(0)).alias("n_links"),
        F.regexp_count(full_text(), F.lit("(?md)^[\\x20\\x09\\x0B-\\x0D]*[^\\x20\\x09-\\x0D]")).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.encode("__text", "UTF-8"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
w AS (SELECT line, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws, min({{'d': doc_id, 'l': line_no}}) AS first FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line),
s AS (
  SELECT line, first, CASE WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' '))) END AS ts FROM w),
t AS (SELECT line, first, len(ts) AS n, unnest(ts) AS t FROM s),
near AS (
  SELECT b.line, count(*) AS links, min(a) AS near FROM (
    SELECT x.line AS a_line, y.line, x.first AS a FROM t AS x JOIN t AS y USING (t) WHERE x.first < y.first
    GROUP BY x.line, y.line, x.first, x.n, y.n HAVING {SIMILARITY[0] + SIMILARITY[1]} * count(*) >= {SIMILARITY[0]} * (x.n + y.n)) AS b
  GROUP BY b.line),
g AS (
  SELECT doc_id, line_no, coalesce(links, 0) AS links, least(first, coalesce(near, first)).d AS first_doc
  FROM l JOIN s USING (line) LEFT JOIN near USING (line)
  WHERE least(first, coalesce(near, first)) < {{'d': doc_id, 'l': line_no}}),
d AS (SELECT doc_id, list(line_no) AS gone, sum(links) AS links, min(first_doc) AS first_doc, count(*) AS n_removed FROM g GROUP BY doc_id),
k AS (SELECT doc_id, count(*) FILTER (regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS n_lines, string_agg(line, chr(10) ORDER BY line_no) FILTER (g.doc_id IS NULL) AS kept FROM l LEFT JOIN g USING (doc_id, line_no) GROUP BY doc_id)
SELECT doc_id, CAST(least(doc_id, coalesce(first_doc, doc_id)) AS BIGINT) AS class_id, CAST(coalesce(links, 0) AS BIGINT) AS n_links,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN d USING (doc_id)
"""
