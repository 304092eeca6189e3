"""Substring dedup: suffix automata of reference shards and matching statistics.

A window is ``SPAN`` words in a row.  A word goes if it lies in a window whose
words also start earlier: in a document with a smaller id, or earlier in its
own.  So each repeated passage stays where it comes first.

No automaton of the whole corpus is needed, and none that every executor would
have to hold.  A window's *anchor* is the least hash among its ``GRAM``-word
runs; equal windows have equal anchors, so windows meet only where their anchor
does, and consecutive windows with one anchor travel together as one fragment.

1. Every document's anchors are counted over the corpus; fragments whose anchor
   comes once cannot repeat and are done.
2. The rest are grouped by a digest of their content.  Every fragment but the
   first of equal ones goes as a whole, so copies, however many, cost one short
   row each and are never gathered.  An anchor with one content is done.
3. The distinct fragments of an anchor are its reference shard; only for them
   the words' hashes are fetched.  Their suffix
   automaton, built in order of position, knows for each state where it ends
   first.  The fragments are streamed through it; where the matching statistics
   reach ``SPAN`` and the state's first end is earlier, the window goes.
   Anchors with over ``HOT_ANCHOR`` distinct fragments are cut into single
   windows, which group by digest and spread over all tasks.
4. Runs of windows that go make maximal spans, which are cut from the texts.

An automaton is made where its shard's fragments are, instead of broadcasting
it: the shards grow with the corpus.

Words are compared by 64-bit hashes, contents by 128 bits.

Defined cases: null, empty and short texts have no window and keep all words.
Windows are judged on the input, not on what is left of it.  A null id counts
as the smallest.  Rows with the same id and text are at the same place, so
neither removes from the other; with the same id and other text they count as
one document, and so do all rows without an id.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, long_array, materialize, table

SPAN = 20
GRAM = 8
HOT_ANCHOR = 20_000
NO_ID = -(1 << 63)
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(GRAM)], np.uint64)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray) -> np.ndarray:
    """Of each run of ``GRAM`` words."""
    n = max(len(hashes) - GRAM + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for j in range(GRAM if n else 0):
        mixed += hashes[j : j + n] * _FACTORS[j]
    return _mixed(mixed)


def fragments(grams: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of each fragment of a text."""
    width = span - GRAM + 1
    n = len(grams) - width + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    least, wide = grams, 1
    while wide < width:  # minima of ever wider runs
        step = min(wide, width - wide)
        least = np.minimum(least[:-step], least[step:])
        wide += step
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    return least[starts].view(np.int64), starts, np.diff(np.append(starts, n))


def recurring(starts: np.ndarray, sizes: np.ndarray, grams: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Fragments that may hold a window twice: a run of ``GRAM`` words comes again within them."""
    order = np.argsort(grams, kind="stable")
    again = np.full(len(grams), len(grams))  # where a run comes next
    same = grams[order[1:]] == grams[order[:-1]]
    again[order[:-1][same]] = order[1:][same]
    soonest = np.minimum.accumulate(again[::-1])[::-1]
    return np.flatnonzero(soonest[starts] < starts + sizes + span - GRAM)


class SuffixAutomaton:
    """Of a growing sequence; each state has the position where it ends first."""

    def __init__(self) -> None:
        self.next, self.link, self.length, self.first, self.last = [{}], [-1], [0], [-1], 0

    def add(self, token: int, position: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        new, p = len(nxt), self.last
        nxt.append({})
        link.append(0)
        length.append(length[p] + 1)
        first.append(position)
        while p >= 0 and token not in nxt[p]:
            nxt[p][token] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][token]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(first[q])
                while p >= 0 and nxt[p].get(token) == q:
                    nxt[p][token] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def first_ends(self, tokens: list[int], span: int) -> list[int]:
        """For each window of ``span`` tokens: where its sequence ends first, -1 if it doesn't occur."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state, n, out = 0, 0, []
        for i, t in enumerate(tokens):
            while state and t not in nxt[state]:
                state = link[state]
                n = length[state]
            if t in nxt[state]:
                state = nxt[state][t]
                n += 1
            while n >= span and length[link[state]] >= span:
                state = link[state]
            n = min(n, span)
            if i >= span - 1:
                out.append(first[state] if n == span else -1)
        return out


def shard_removals(contents: list[np.ndarray], span: int = SPAN) -> list[np.ndarray]:
    """For each fragment of a shard, in order of position: which of its windows came before."""
    automaton, at, position = SuffixAutomaton(), [], 0
    for k, c in enumerate(contents):
        at.append(position)
        for t in c.tolist():
            automaton.add(t, position)
            position += 1
        automaton.add(-1 - k - (1 << 64), position)  # parts the fragments; no word's hash
        position += 1
    out = []
    for a, c in zip(at, contents, strict=True):
        ends = np.array(automaton.first_ends(c.tolist(), span))
        out.append(ends < a + span - 1 + np.arange(len(ends)))
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, tag, text in zip(b["doc_id"].tolist(), b["tag"].tolist(), b["text"], strict=True):
            words = words_of(text)
            grams = gram_hashes(word_hashes(words))
            anchors, starts, sizes = fragments(grams)
            twice = recurring(starts, sizes, grams) if len(starts) else starts  # these count as two
            rows.append((doc_id, tag, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), np.append(anchors, anchors[twice]), np.append(starts, starts[twice])))
        yield pd.DataFrame(rows, columns=["doc_id", "tag", "n_words", "sha", "anchors", "starts"])


def _digest(own: np.ndarray) -> list[int]:
    """Of some words' hashes, as two longs."""
    return np.frombuffer(xxhash.xxh128_digest(own.tobytes()), "<i8").tolist()


def _fragments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, tag, text, wanted in zip(b["doc_id"].tolist(), b["tag"].tolist(), b["text"], b["starts"], strict=True):
            hashes, wanted = word_hashes(words_of(text)), set(wanted.tolist())
            grams = gram_hashes(hashes)
            found = fragments(grams)
            again = set(recurring(found[1], found[2], grams).tolist())
            for k, (anchor, start, n) in enumerate(zip(*(x.tolist() for x in found), strict=True)):
                if start in wanted:
                    rows.append((anchor, doc_id, tag, start, n, *_digest(hashes[start : start + n + SPAN - 1]), k in again))
        yield pd.DataFrame(rows, columns=["anchor", "doc_id", "tag", "start", "n", "c1", "c2", "again"])


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words' hashes of the fragments wanted; those of crowded anchors as single windows' digests."""
    for b in batches:
        rows = []
        for doc_id, text, wanted in zip(b["doc_id"].tolist(), b["text"], b["wanted"], strict=True):
            hashes = word_hashes(words_of(text))
            for w in wanted:
                own = hashes[w["start"] : w["start"] + w["n"] + SPAN - 1]
                key = (w["anchor"], w["c1"], w["c2"], doc_id, w["start"])
                if _digest(own) != [w["c1"], w["c2"]]:
                    continue  # another text with the same id
                if not w["crowded"]:
                    rows.append((*key, own.tobytes(), None, None, None))
                else:
                    rows += [(*key, None, j, *_digest(own[j : j + SPAN])) for j in range(w["n"])]
        columns = list(zip(*rows, strict=True)) or [()] * 9
        plain = {c: columns[k] for k, c in enumerate(("anchor", "c1", "c2", "doc_id", "start", "content"))}
        yield pd.DataFrame(plain | {c: long_array(list(columns[6 + k])) for k, c in enumerate(("j", "w1", "w2"))})


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor and position; a shard may reach over several batches."""
    columns = ["anchor", "c1", "c2", "runs"]
    shard, held = None, []

    def verdicts() -> list[tuple]:
        gone = shard_removals([np.frombuffer(c, np.uint64) for *_, c in held])
        return [(shard, c1, c2, [x for run in _runs(g) for x in run]) for (c1, c2, _), g in zip(held, gone, strict=True)]

    for b in batches:
        rows = []
        for anchor, c1, c2, content in zip(b["anchor"].tolist(), b["c1"].tolist(), b["c2"].tolist(), b["content"], strict=True):
            if anchor != shard:
                if held:
                    rows += verdicts()
                shard, held = anchor, []
            if not held or held[-1][:2] != (c1, c2):  # equal rows give a fragment twice
                held.append((c1, c2, content))
        yield pd.DataFrame(rows, columns=columns)
    if held:
        yield pd.DataFrame(verdicts(), columns=columns)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for text, starts, ends in zip(b["text"], b["starts"], b["ends"], strict=True):
            words = words_of(text)
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, starts, 1)
            np.add.at(gone, ends, -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
            rows.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
        yield pd.DataFrame({"doc_id": b["doc_id"], "tag": b["tag"], "n_removed": [r[0] for r in rows], "kept_sha256": [r[1] for r in rows], "kept_text": [r[2] for r in rows]})


FRAGMENT = "anchor long, doc_id long, tag long, start long, n long, c1 long, c2 long, again boolean"
CONTENT = "anchor long, c1 long, c2 long, doc_id long, start long, content binary, j long, w1 long, w2 long"


def repeated_spans(docs: DataFrame, surveyed: DataFrame, hot: int = HOT_ANCHOR) -> DataFrame:
    """doc_id, tag, starts, ends: the spans of words that go, for each document with some."""
    each = surveyed.select("doc_id", "tag", F.explode(F.arrays_zip("anchors", "starts")).alias("f")).select("doc_id", "tag", "f.anchors", "f.starts")
    repeated = each.groupBy("anchors").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchors")
    wanted = materialize(each.join(repeated, "anchors", "left_semi").groupBy("doc_id", "tag").agg(F.collect_set("starts").alias("starts")), "wanted")
    found = materialize(docs.join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "text", "starts").mapInPandas(_fragments, FRAGMENT), "fragments")
    content = ["anchor", "c1", "c2"]
    firsts = found.groupBy(*content).agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max("again").alias("again"), F.first("n").alias("n"))
    distinct = materialize(firsts.select(*content, F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start"), "again", "n"), "distinct")
    # an anchor with one content that holds no window twice has nothing to compare
    shards = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.max("again").alias("some")).filter("k > 1 OR some").select("anchor", (F.col("k") > hot).alias("crowded"))
    fetch = F.collect_list(F.struct(*content, F.col("first_start").alias("start"), "n", "crowded")).alias("wanted")
    places = materialize(distinct.join(shards, "anchor").groupBy(F.col("first_doc").alias("doc_id")).agg(fetch), "places")
    contents = materialize(docs.join(places, "doc_id").select("doc_id", "text", "wanted").mapInPandas(_contents, CONTENT), "contents")
    judged = contents.filter("content IS NOT NULL").repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start", "c1", "c2").select(*content, "content").mapInPandas(_judge, "anchor long, c1 long, c2 long, runs array<long>")
    # crowded anchors: their windows spread by content
    place = F.struct("doc_id", (F.col("start") + F.col("j")).alias("at"))
    single = contents.filter("content IS NULL")
    earliest = single.groupBy("anchor", "w1", "w2").agg(F.min(place).alias("earliest"))
    late = single.join(earliest, ["anchor", "w1", "w2"]).filter(F.col("earliest") < place)
    judged = judged.unionByName(late.groupBy(*content).agg(F.flatten(F.transform(F.array_sort(F.collect_set("j")), lambda j: F.array(j, j + 1))).alias("runs")))
    verdicts = materialize(judged.filter(F.size("runs") > 0), "verdicts")
    known = distinct.select(*content, "first_doc", "first_start").join(verdicts, content, "left")
    is_first = (F.col("doc_id") == F.col("first_doc")) & (F.col("start") == F.col("first_start"))
    none = F.array().cast("array<bigint>")
    runs = F.when(is_first, F.coalesce("runs", none)).otherwise(F.array(F.lit(0).cast("long"), F.col("n")))
    spans = (
        found.select(*content, "doc_id", "tag", "start", "n")
        .join(known, content)
        .select("doc_id", "tag", "start", runs.alias("r"))
        .filter(F.size("r") > 0)
        .select("doc_id", "tag", F.explode(F.expr(f"transform(sequence(0, size(r) - 2, 2), i -> struct(start + r[i] AS a, start + r[i + 1] + {SPAN - 1} AS b))")).alias("s"))
    )
    return materialize(spans.groupBy("doc_id", "tag").agg(F.collect_set("s").alias("s")).select("doc_id", "tag", F.col("s.a").alias("starts"), F.col("s.b").alias("ends")), "spans")


def substring_dedup(docs: DataFrame, hot: int = HOT_ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (null: all words stay)."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(full_text()).alias("tag"), full_text().alias("text"))
    surveyed = materialize(own.mapInPandas(_survey, "doc_id long, tag long, n_words long, sha string, anchors array<long>, starts array<long>"), "survey")
    spans = repeated_spans(own, surveyed, hot)
    cut = own.join(spans, ["doc_id", "tag"]).select("doc_id", "tag", "text", "starts", "ends").mapInPandas(_cut, "doc_id long, tag long, n_removed long, kept_sha256 string, kept_text string")
    sizes = surveyed.select("doc_id", "tag", "n_words", "sha")
    whole = sizes.join(spans.select("doc_id", "tag"), ["doc_id", "tag"], "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"))
    lengths = sizes.groupBy("doc_id", "tag").agg(F.first("n_words").alias("n_words"))
    shorter = cut.join(lengths, ["doc_id", "tag"]).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    out = whole.unionByName(shorter)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(ws) - {SPAN - 2})) AS s, unnest(list_transform(range(1, len(ws) - {SPAN - 2}), lambda i: md5(array_to_string(ws[i:i + {SPAN - 1}], ' ')))) AS c
  FROM t WHERE len(ws) >= {SPAN}),
g AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY c ORDER BY doc_id, s) > 1),
x AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, s + {SPAN})) AS p FROM g) GROUP BY doc_id),
k AS (
  SELECT doc_id, len(ws) AS n, len(ps) AS removed,
         list_transform(list_filter(list_zip(ws, coalesce(flags, [])), lambda z: NOT coalesce(z[2], FALSE)), lambda z: z[1]) AS kept
  FROM (SELECT t.doc_id, ws, ps, CASE WHEN ps IS NOT NULL THEN (SELECT list(list_contains(ps, i) ORDER BY i) FROM unnest(range(1, len(ws) + 1)) AS r(i)) END AS flags FROM t LEFT JOIN x USING (doc_id)))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""
