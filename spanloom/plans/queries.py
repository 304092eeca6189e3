"""Queries over the driver's tables, each with the SQL that must give the same rows.

The tables hold no labelled text, so words of ``documents`` stand for mentions:
a word's length gives its type and true code, and some endings give a wrong
prediction.  Lists leave as strings, so that rows compare by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import products
from spanloom.functions import text as tx
from spanloom.operators import context, datasets, extension, linking, postprocess, scoring, spans, terminology, validation

TYPES = ["DIAG", "SYM", "DRUG", "TEST", "RESULT"]
CUES = ["not", "no", "without", "des", "die"]
SIG = ["po", "bid", "mg", "qam", "prn"]
GRID = [1.0, 5.0, 10.0, 20.0, 50.0]

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- mentions

WORDS_SQL = """
w0 AS (SELECT doc_id, text AS doc_text, string_split(text, ' ') AS ws FROM documents),
w1 AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS i FROM w0),
w AS (SELECT doc_id, word, i, length(word) AS n, CAST(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(word) - 1 AS BIGINT) AS s FROM w1)
"""


def word_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, i, text, type, start_pos, end_pos, assertions, candidates, and the predicted
    p_assertions, p_candidates: a row for each blank-separated word."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("ws"))
    words = docs.select("doc_id", F.posexplode("ws").alias("i", "text"))
    w = Window.partitionBy("doc_id").orderBy("i")
    n = F.length("text")
    start = F.sum(n + 1).over(w) - n - 1
    return words.withColumn("start_pos", start).withColumn("end_pos", F.col("start_pos") + n).withColumn("type", F.element_at(F.array(*(F.lit(t) for t in TYPES)), n % 5 + 1)).withColumn(
        "candidates", F.when(n % 5 == 0, F.array(F.concat(F.lit("C"), n.cast("string")))).otherwise(F.array().cast("array<string>"))
    ).withColumn("p_candidates", F.when((n % 5 == 0) & ~F.col("text").endswith("e"), F.array(F.concat(F.lit("C"), n.cast("string")))).otherwise(F.array().cast("array<string>")))


@query(
    f"""WITH {WORDS_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, word ORDER BY s) - 1 AS occ FROM w),
v AS (SELECT doc_id, word, occ, n, CASE WHEN n % 5 = 0 THEN 'C' || n ELSE '__EMPTY__' END AS t, CASE WHEN n % 5 = 0 AND NOT ends_with(word, 'e') THEN 'C' || n ELSE '__EMPTY__' END AS p FROM o WHERE n % 5 IN (0, 2)),
j AS (SELECT doc_id, CAST(count(*) FILTER (t = p) AS DOUBLE) / (count(*) + count(*) FILTER (t <> p)) AS j, sum(CASE WHEN n % 5 = 0 THEN 2 ELSE 1 END) AS wt FROM v GROUP BY doc_id)
SELECT count(*) AS num_docs, round(coalesce(sum(j * wt) / sum(wt), 1.0), 6) AS j_candidates, CAST(sum(wt) AS BIGINT) AS weight FROM j"""
)
def weighted_score(spark, sf_dir):
    """The flagship: candidate Jaccard of coded mentions, weighted by their codes."""
    m = word_mentions(spark, sf_dir).filter(F.col("type").isin("DIAG", "DRUG"))
    truth = scoring.value_items(m, "candidates")
    predicted = scoring.value_items(m.drop("candidates").withColumnRenamed("p_candidates", "candidates"), "candidates")
    joined = scoring.set_similarity(truth, predicted).join(scoring.candidate_weights(m), "doc_id")
    return joined.agg(F.count(F.lit(1)).alias("num_docs"), F.round(scoring.weighted_mean(F.col("j"), F.col("w")), 6).alias("j_candidates"), F.sum("w").alias("weight"))


@query(
    f"""WITH {WORDS_SQL}, v AS (SELECT DISTINCT doc_id, word, CASE WHEN ends_with(word, 's') THEN 'H' ELSE '' END AS t, CASE WHEN ends_with(word, 'es') THEN 'H' ELSE '' END AS p FROM w WHERE n % 5 < 3)
SELECT doc_id, round(CAST(count(*) FILTER (t = p) AS DOUBLE) / (count(*) + count(*) FILTER (t <> p)), 6) AS j FROM v GROUP BY doc_id"""
)
def jaccard_assertions(spark, sf_dir):
    """Assertion Jaccard without occurrence numbers, by document."""
    m = word_mentions(spark, sf_dir).filter(F.col("type").isin("DIAG", "SYM", "DRUG"))
    none, flag = F.array().cast("array<string>"), F.array(F.lit("H"))
    truth = scoring.value_items(m.withColumn("a", F.when(F.col("text").endswith("s"), flag).otherwise(none)), "a", by_occurrence=False)
    predicted = scoring.value_items(m.withColumn("a", F.when(F.col("text").endswith("es"), flag).otherwise(none)), "a", by_occurrence=False)
    return scoring.set_similarity(truth, predicted).select("doc_id", F.round("j", 6).alias("j"))


@query(f"""WITH {WORDS_SQL} SELECT doc_id, word AS text, i, row_number() OVER (PARTITION BY doc_id, word ORDER BY s) - 1 AS occ FROM w""")
def occurrence_index(spark, sf_dir):
    m = word_mentions(spark, sf_dir)
    return scoring.with_occurrence(m, ["doc_id", "text", "type"], ["start_pos", "end_pos"]).select("doc_id", "text", F.col("i").cast("long").alias("i"), F.col("occ").cast("long").alias("occ"))


@query()
def wer_by_doc(spark, sf_dir):
    """Word error rate of a part's name and brand against its name and type."""
    parts = table(spark, sf_dir, "part")
    ref, hyp = F.split(F.concat_ws(" ", "p_name", "p_type"), " "), F.split(F.concat_ws(" ", "p_name", "p_brand"), " ")
    return parts.select("p_partkey", F.round(scoring.word_error_rate(ref, hyp), 6).alias("wer"))


# ------------------------------------------------------------- vocabularies


@query("""WITH c AS (SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY ALL)
SELECT p_name, max_by(p_brand, (n, p_brand)) AS p_brand, max(n) AS n, count(*) AS n_codes FROM c GROUP BY p_name""")
def term_mode_code(spark, sf_dir):
    return terminology.mode_code(table(spark, sf_dir, "part"), "p_name", "p_brand")


@query("""WITH c AS (SELECT p_name, p_type, count(*) AS n FROM part GROUP BY ALL)
SELECT p_name, max_by(p_type, (n, p_type)) AS p_type, max(n) AS n, count(*) AS n_codes FROM c GROUP BY p_name HAVING count(*) > 1""")
def term_conflicts(spark, sf_dir):
    return terminology.conflicts(table(spark, sf_dir, "part"), "p_name", "p_type")


def _parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return [p.filter(f"p_size {c}").select("p_name", "p_brand").distinct() for c in ("<= 2", "<= 10", "> 10")]


_PARTS_SQL = "u AS (SELECT DISTINCT p_name, p_brand, k AS prio FROM part, (VALUES (0), (1), (2)) AS v(k) WHERE CASE k WHEN 0 THEN p_size <= 2 WHEN 1 THEN p_size <= 10 ELSE p_size > 10 END)"


@query(f"WITH {_PARTS_SQL} SELECT p_name, prio, p_brand FROM u QUALIFY prio = min(prio) OVER (PARTITION BY p_name)")
def term_priority_union(spark, sf_dir):
    return terminology.priority_union(_parts(spark, sf_dir), "p_name")


@query("""WITH n AS (SELECT s_name AS k, max(CAST(s_nationkey AS VARCHAR)) AS c FROM supplier WHERE s_acctbal > 2000 GROUP BY 1),
o AS (SELECT s_name AS k, max(CAST(s_suppkey AS VARCHAR)) AS c FROM supplier WHERE s_acctbal < 6000 GROUP BY 1)
SELECT coalesce(n.k, o.k) AS s_name, coalesce(o.c, n.c) AS code, CASE WHEN o.k IS NULL THEN 'rebuilt' WHEN n.k IS NULL THEN 'orphan' ELSE 'kept' END AS origin FROM n FULL JOIN o ON n.k = o.k""")
def carry_over_override(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    rebuilt = s.filter("s_acctbal > 2000").select("s_name", F.col("s_nationkey").cast("string").alias("code"))
    kept = s.filter("s_acctbal < 6000").select("s_name", F.col("s_suppkey").cast("string").alias("code"))
    return terminology.carry_over(rebuilt, kept, "s_name", "code")


def _codes(spark, sf_dir):
    """Dotted codes of parts and a catalog of those with small sizes."""
    p = table(spark, sf_dir, "part")
    code = F.concat(F.lpad(F.regexp_extract("p_brand", "([0-9]+)", 1), 3, "B"), F.lit("."), F.col("p_size").cast("string"))
    return p.select(code.alias("code")).distinct(), p.filter("p_size < 10").select(code.alias("code")).union(p.filter("p_size = 3").select(F.substring_index(code, ".", 1).alias("code"))).distinct()


_CODES_SQL = """
c0 AS (SELECT DISTINCT lpad(regexp_extract(p_brand, '([0-9]+)', 1), 3, 'B') AS cat, p_size FROM part),
codes AS (SELECT DISTINCT cat || '.' || p_size AS code FROM c0),
catalog AS (SELECT DISTINCT cat || '.' || p_size AS code FROM c0 WHERE p_size < 10 UNION SELECT DISTINCT cat FROM c0 WHERE p_size = 3),
pre AS (SELECT code, rtrim(substr(code, 1, l), '.') AS p FROM (SELECT code, unnest(range(3, length(code) + 1)) AS l FROM codes)),
anc AS (SELECT codes.code, f.found FROM codes LEFT JOIN (SELECT pre.code, max_by(p, length(p)) AS found FROM pre JOIN catalog ON catalog.code = p GROUP BY pre.code) AS f ON f.code = codes.code)
"""


@query(f"WITH {_CODES_SQL} SELECT code, found FROM anc")
def ancestor_code(spark, sf_dir):
    return terminology.nearest_ancestor(*_codes(spark, sf_dir))


@query(
    f"""WITH {_CODES_SQL},
kids AS (SELECT split_part(code, '.', 1) AS category, coalesce(min(code) FILTER (ends_with(code, '.9')), min(code)) AS child FROM catalog WHERE contains(code, '.') GROUP BY 1),
a AS (SELECT x.code, kids.child, catalog.code IS NOT NULL AS known, found FROM (SELECT code FROM codes UNION SELECT split_part(code, '.', 1) FROM codes) AS x LEFT JOIN kids ON kids.category = x.code LEFT JOIN catalog ON catalog.code = x.code LEFT JOIN anc ON anc.code = x.code)
SELECT code, CASE WHEN child IS NOT NULL THEN 'promote' WHEN known THEN 'keep' WHEN found IS NOT NULL THEN 'ancestor' ELSE 'review' END AS action,
       CASE WHEN child IS NOT NULL THEN child WHEN known THEN code ELSE found END AS proposed FROM a"""
)
def recode_audit(spark, sf_dir):
    codes, catalog = _codes(spark, sf_dir)
    return terminology.audit_codes(codes.union(codes.select(F.substring_index("code", ".", 1))).distinct(), catalog)


@query("""WITH m AS (SELECT p_name AS k, count(*) AS f FROM part WHERE p_size > 25 GROUP BY 1), t AS (SELECT p_name AS k, max(p_brand) AS c FROM part WHERE p_size < 5 GROUP BY 1)
SELECT coalesce(m.k, t.k) AS p_name, coalesce(f, 0) AS freq, c AS code, c IS NOT NULL AS in_terms FROM m FULL JOIN t ON m.k = t.k""")
def recode_worklist(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return terminology.worklist(p.filter("p_size > 25").select("p_name"), p.filter("p_size < 5").groupBy("p_name").agg(F.max("p_brand").alias("code")), "p_name")


@query("""SELECT CASE WHEN p_size < 5 THEN 'short' WHEN p_type = 'SMALL' THEN 'chapter' WHEN p_brand = 'Brand#7' THEN 'duplicate' ELSE 'kept' END AS reason, count(*) AS n FROM part GROUP BY 1""")
def skip_reasons(spark, sf_dir):
    rules = [("short", F.col("p_size") < 5), ("chapter", F.col("p_type") == "SMALL"), ("duplicate", F.col("p_brand") == "Brand#7")]
    return terminology.drop_reasons(table(spark, sf_dir, "part"), rules).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_name, p_partkey, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) = 1")
def first_row(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("k", F.lower("p_name"))
    return terminology.first_row(p, ["k"], [F.col("p_partkey")]).select("p_name", "p_partkey", "p_brand")


_VOTE_SQL = """WITH m AS (SELECT user_id, props, count(*) AS members FROM events GROUP BY ALL HAVING count(*) >= 2), c AS (SELECT user_id, props, event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL)
SELECT user_id, props, event_type, n, members FROM c JOIN m USING (user_id, props) WHERE """


@query(_VOTE_SQL + "2 * n > members")
def majority_vote(spark, sf_dir):
    return terminology.vote(table(spark, sf_dir, "events"), ["user_id", "props"], "event_type")


@query(_VOTE_SQL + "n > 0")
def union_vote(spark, sf_dir):
    return terminology.vote(table(spark, sf_dir, "events"), ["user_id", "props"], "event_type", majority=False)


# ------------------------------------------------------------------ linking


def _terms(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size < 20").select(tx.norm_term("p_name", composed=True).alias("term"), F.col("p_brand").alias("code")).distinct()


def _keys(spark, sf_dir):
    shown = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")))).otherwise(F.concat("p_name", F.lit(" 5mg")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), tx.norm_term(shown, composed=True).alias("key"))


_TERMS_SQL = """terms AS (SELECT DISTINCT lower(p_name) AS term, p_brand AS code FROM part WHERE p_size < 20),
keys AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 2 THEN lower(p_name) || ' 5 mg' ELSE lower(p_name) END AS key FROM part)"""


@query(f"WITH {_TERMS_SQL} SELECT id, coalesce(string_agg(DISTINCT code, '|' ORDER BY code), '') AS codes FROM keys LEFT JOIN terms ON term = key GROUP BY id")
def exact_link(spark, sf_dir):
    return linking.exact_link(_keys(spark, sf_dir), _terms(spark, sf_dir)).select("id", F.array_join("codes", "|").alias("codes"))


@query(
    f"""WITH {_TERMS_SQL}, c AS (SELECT term, string_agg(code, '|' ORDER BY code) AS codes FROM terms GROUP BY term),
x AS (SELECT id, key, a.codes AS c1, b.codes AS c2 FROM keys LEFT JOIN c AS a ON a.term = key LEFT JOIN c AS b ON b.term = regexp_replace(key, ' 5 mg$', ''))
SELECT id, coalesce(c1, c2, '') AS codes, CASE WHEN c1 IS NOT NULL THEN 'exact' WHEN c2 IS NOT NULL THEN 'core' ELSE 'none' END AS tier FROM x"""
)
def tiered_link(spark, sf_dir):
    terms = _terms(spark, sf_dir)
    core = lambda m: linking.exact_link(m.withColumn("key", F.regexp_replace("key", " 5 mg$", "")), terms)
    linked = linking.tiered_link(_keys(spark, sf_dir), [("exact", lambda m: linking.exact_link(m, terms)), ("core", core)])
    return linked.select("id", F.array_join("codes", "|").alias("codes"), "tier")


@query(
    """WITH q AS (SELECT p_partkey AS id, unnest(list_distinct(string_split(p_name || ' ' || lower(p_type), ' '))) AS t, len(list_distinct(string_split(p_name || ' ' || lower(p_type), ' '))) AS n FROM part),
t AS (SELECT code, unnest(ts) AS t, len(ts) AS m FROM (SELECT DISTINCT p_name || '/' || p_type || '/' || p_brand AS code, list_distinct(string_split(p_name || ' ' || lower(p_type) || ' ' || lower(p_brand), ' ')) AS ts FROM part)),
h AS (SELECT id, code, any_value(n) AS n, any_value(m) AS m FROM q JOIN t USING (t) GROUP BY id, code HAVING count(*) = any_value(n) AND any_value(n) >= 2)
SELECT id, min_by(code, (m - n, code)) AS code FROM h GROUP BY id"""
)
def subset_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    tokens = lambda *c: F.array_distinct(F.split(F.concat_ws(" ", *c), " "))
    queries = p.select(F.col("p_partkey").alias("id"), tokens("p_name", F.lower("p_type")).alias("tokens"))
    titles = p.select(F.concat_ws("/", "p_name", "p_type", "p_brand").alias("code"), tokens("p_name", F.lower("p_type"), F.lower("p_brand")).alias("tokens")).distinct()
    return linking.subset_link(queries, titles)


@query(
    """WITH p AS (SELECT DISTINCT p_name || ' ' || p_size || ' mg ' || lower(p_type) AS text, p_brand AS code, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'ECONOMY' THEN 1 ELSE 4 END AS tier FROM part),
h AS (SELECT id, code, min((tier, length(text), text)) AS k FROM (SELECT p_partkey AS id, p_name || ' ' || p_size AS core FROM part) JOIN p ON starts_with(text, core || ' ') GROUP BY id, code),
r AS (SELECT id, code, row_number() OVER (PARTITION BY id ORDER BY k, code) AS r FROM h)
SELECT id, string_agg(code, '|' ORDER BY r) AS codes FROM r WHERE r <= 3 GROUP BY id"""
)
def prefix_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    products = p.select(F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.lit("mg"), F.lower("p_type")).alias("text"), F.col("p_brand").alias("code"), "p_type").distinct()
    tiers = F.when(F.col("p_type") == "SMALL", 0).when(F.col("p_type") == "ECONOMY", 1).otherwise(4)
    cores = p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("core"))
    return linking.prefix_link(cores, products, tiers).select("id", F.array_join("codes", "|").alias("codes"))


@query(
    """WITH q AS (SELECT p_partkey AS id, string_split(p_name || ' ' || lower(p_type) || ' ' || p_size, ' ') AS ts FROM part),
p AS (SELECT DISTINCT p_name || '/' || p_type AS code, string_split(p_name || ' ' || lower(p_type), ' ') AS ts FROM part),
h AS (SELECT id, code, len(list_intersect(list_distinct(q.ts[2:]), list_distinct(p.ts[2:]))) AS o FROM q JOIN p ON q.ts[1] = p.ts[1])
SELECT id, min_by(code, (-o, code)) AS code FROM h WHERE o > 0 GROUP BY id"""
)
def overlap_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    queries = p.select(F.col("p_partkey").alias("id"), F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), F.col("p_size").cast("string")), " ").alias("tokens"))
    products = p.select(F.concat_ws("/", "p_name", "p_type").alias("code"), F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("tokens")).distinct()
    return linking.overlap_link(queries, products)


@query(
    """WITH t AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_size < 3),
k AS (SELECT p_partkey AS id, lower(p_type) || ' ' || p_name || ' ' || lower(p_brand) AS key FROM part)
SELECT id, min_by(term, (-length(term), term)) AS term FROM k JOIN t ON length(term) >= 5 AND contains(' ' || key || ' ', ' ' || term || ' ') GROUP BY id"""
)
def containment_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    terms = p.select(F.explode(F.split("p_name", " ")).alias("term")).union(p.filter("p_size < 3").select("p_name"))
    keys = p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", F.lower("p_type"), "p_name", F.lower("p_brand")).alias("key"))
    return linking.containment_link(keys, terms)


def _lexicon(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.lower(F.substring("n_name", 1, 2)).alias("phrase")).union(table(spark, sf_dir, "region").select(F.lit("de la"))).union(table(spark, sf_dir, "region").select(F.lit("the"))).distinct()


@query(
    """WITH l AS (SELECT DISTINCT lower(substr(n_name, 1, 2)) AS phrase FROM nation UNION SELECT 'de la' UNION SELECT 'the'),
s AS (SELECT doc_id, text, unnest(range(0, length(text))) AS start FROM documents),
x AS (SELECT doc_id, text, start, unnest([2, 3, 5]) AS n FROM s WHERE start = 0 OR NOT regexp_matches(substr(text, start, 1), '[\\p{L}\\p{N}_]'))
SELECT doc_id, phrase, count(*) AS n, min(start) AS first FROM x JOIN l ON phrase = lower(substr(text, start + 1, n)) AND length(phrase) = n
WHERE start + n <= length(text) AND NOT regexp_matches(substr(text, start + n + 1, 1), '[\\p{L}\\p{N}_]') GROUP BY doc_id, phrase"""
)
def phrase_occurrences(spark, sf_dir):
    found = linking.phrase_occurrences(table(spark, sf_dir, "documents"), _lexicon(spark, sf_dir))
    return found.groupBy("doc_id", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min("start").cast("long").alias("first"))


@query()
def fuzzy_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    keys = p.select("p_name").distinct().select(F.col("p_name").alias("id"), F.concat("p_name", F.lit("s")).alias("key"))
    return linking.fuzzy_link(keys, p.select(F.col("p_name").alias("term")).distinct())


# -------------------------------------------------------------------- spans


@query(
    """WITH b AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
  CASE event_type WHEN 'click' THEN 'B-A' WHEN 'view' THEN 'I-A' WHEN 'error' THEN 'I-B' ELSE 'O' END AS label FROM events),
k AS (SELECT *, CASE WHEN label <> 'O' THEN label[3:] END AS type FROM b),
n AS (SELECT *, type IS NOT NULL AND NOT (label LIKE 'I-%' AND type IS NOT DISTINCT FROM lag(type) OVER (PARTITION BY user_id ORDER BY pos)) AS new FROM k),
s AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY user_id ORDER BY pos) AS span FROM n)
SELECT user_id, CAST(span AS BIGINT) AS span, type, min(pos) AS first, max(pos) AS last, count(*) AS n FROM s WHERE type IS NOT NULL GROUP BY user_id, span, type"""
)
def bio_decode(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    label = F.when(F.col("event_type") == "click", "B-A").when(F.col("event_type") == "view", "I-A").when(F.col("event_type") == "error", "I-B").otherwise("O")
    found = spans.decode_bio(e.withColumn("label", label), ["user_id"], ["ts", "event_id"])
    return found.select("user_id", "span", "type", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "n")


@query("SELECT user_id, event_type, round(avg(value), 6) AS mean, avg(value) >= 50 AS holds FROM events GROUP BY ALL")
def assertion_mean(spark, sf_dir):
    mean = F.avg("value")
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.round(mean, 6).alias("mean"), (mean >= 50).alias("holds"))


_WINDOWS_SQL = """x AS (SELECT doc_id, n_chars, CASE WHEN n_chars <= 512 THEN 1 ELSE CAST(ceil((n_chars - 512) / 448.0) AS BIGINT) + 1 END AS c FROM documents),
win AS (SELECT doc_id, i * 448 AS ws, least(i * 448 + 512, n_chars) AS we FROM (SELECT *, unnest(range(0, c)) AS i FROM x))"""


def _windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(spans.token_windows(F.col("n_chars"), 512, 64)).alias("w")).select("doc_id", F.col("w.s").cast("long").alias("ws"), F.col("w.e").cast("long").alias("we"))


@query(f"WITH {_WINDOWS_SQL} SELECT doc_id, ws, we FROM win")
def sliding_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


@query(f"WITH {_WINDOWS_SQL}, {WORDS_SQL} SELECT doc_id, ws, count(*) AS n, CAST(sum(s - ws) AS BIGINT) AS moved FROM win JOIN w USING (doc_id) WHERE s >= ws AND s + n <= we GROUP BY doc_id, ws")
def window_assign(spark, sf_dir):
    m = word_mentions(spark, sf_dir).select("doc_id", F.col("start_pos").alias("s"), F.col("end_pos").alias("e"))
    return spans.assign_windows(_windows(spark, sf_dir), m, "doc_id").groupBy("doc_id", "ws").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("moved"))


@query(
    """WITH c AS (SELECT role, length(text) % 97 AS k, conv_id * 1000 + turn AS o, [chr(CAST(97 + length(text) % 5 AS INT)), chr(CAST(97 + turn % 3 AS INT))] AS tags, turn % 2 = 0 AS edge FROM conversations),
g AS (SELECT role, k, bool_and(edge) AS edge, min(o) AS o FROM c GROUP BY ALL),
t AS (SELECT DISTINCT role, k, unnest(tags) AS t FROM c JOIN g USING (role, k) WHERE g.edge OR NOT c.edge)
SELECT g.role, g.k, g.edge, g.o, string_agg(t, '|' ORDER BY t) AS tags FROM g JOIN t USING (role, k) GROUP BY ALL"""
)
def dedupe_edge(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    letter = lambda n: F.chr((97 + n).cast("int"))
    m = c.select("role", (F.length("text") % 97).cast("long").alias("k"), (F.col("conv_id") * 1000 + F.col("turn")).alias("o"), F.array(letter(F.length("text") % 5), letter(F.col("turn") % 3)).alias("tags"), (F.col("turn") % 2 == 0).alias("edge"))
    return spans.dedupe_edge(m, ["role", "k"], "o", "tags", "edge").select("role", "k", "edge", "o", F.array_join("tags", "|").alias("tags"))


_INTERVALS_SQL = "l AS (SELECT l_orderkey AS g, l_partkey % 50 AS s, l_partkey % 50 + CAST(l_quantity AS BIGINT) % 17 AS e, l_linenumber AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_partkey % 50) - (l_partkey % 50 + CAST(l_quantity AS BIGINT) % 17), l_partkey % 50, l_linenumber, l_suppkey) AS r FROM lineitem)"


def _intervals(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = F.col("l_partkey") % 50
    return li.select(F.col("l_orderkey").alias("g"), s.alias("s"), (s + F.col("l_quantity").cast("long") % 17).alias("e"), F.col("l_linenumber").alias("k"), "l_suppkey")


@query(
    f"""WITH RECURSIVE {_INTERVALS_SQL},
f AS (
  SELECT g, r, [{{'s': s, 'e': e, 'k': k}}] AS kept FROM l WHERE r = 1
  UNION ALL
  SELECT l.g, l.r, CASE WHEN len(list_filter(f.kept, lambda x: greatest(x.s, l.s) < least(x.e, l.e))) > 0 THEN f.kept ELSE list_append(f.kept, {{'s': l.s, 'e': l.e, 'k': l.k}}) END FROM f JOIN l ON l.g = f.g AND l.r = f.r + 1),
z AS (SELECT g, unnest(max_by(kept, r)) AS x FROM f GROUP BY g)
SELECT g, x.s AS s, x.e AS e, x.k AS k FROM z"""
)
def greedy_resolve(spark, sf_dir):
    """Per order, the longest intervals first, without those that overlap a kept one."""
    m = _intervals(spark, sf_dir)
    return spans.resolve_overlaps(m, "g", [F.col("s") - F.col("e"), F.col("s"), F.col("k"), F.col("l_suppkey")], ["s", "e", "k"])


@query(
    f"""WITH {_INTERVALS_SQL}, o AS (SELECT g, s, e, lead(s) OVER w AS s2, lead(e) OVER w AS e2 FROM l WINDOW w AS (PARTITION BY g ORDER BY s, e, k, r))
SELECT g, count(*) AS n FROM o WHERE greatest(s, s2) < least(e, e2) GROUP BY g"""
)
def adjacent_overlap(spark, sf_dir):
    w = Window.partitionBy("g").orderBy("s", "e", "k", "l_suppkey")
    m = _intervals(spark, sf_dir).withColumn("s2", F.lead("s").over(w)).withColumn("e2", F.lead("e").over(w))
    return m.filter(tx.overlaps(F.col("s"), F.col("e"), F.col("s2"), F.col("e2"))).groupBy("g").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_INTERVALS_SQL}, y AS (SELECT *, k % 2 AS t FROM l) SELECT g, s, e, k, t FROM y AS a WHERE NOT EXISTS (SELECT 1 FROM y AS b WHERE b.g = a.g AND b.t = a.t AND b.s <= a.s AND a.e <= b.e AND b.e - b.s > a.e - a.s)""")
def remove_nested(spark, sf_dir):
    m = _intervals(spark, sf_dir).withColumn("t", F.col("k") % 2)
    return spans.remove_nested(m, "g", "s", "e", "t").select("g", "s", "e", "k", "t")


# ------------------------------------------------- filters, context, records


@query(
    f"""WITH {WORDS_SQL}, d AS (SELECT *, lower(word) IN ('the', 'der', 'la', 'de') AS stop FROM w)
SELECT doc_id, count(*) FILTER (stop) AS denied, count(*) FILTER (NOT stop AND n <= 4 AND n % 5 <> 0) AS short, count(*) FILTER (NOT stop AND NOT (n <= 4 AND n % 5 <> 0)) AS kept FROM d GROUP BY doc_id"""
)
def noise_filter(spark, sf_dir):
    m = word_mentions(spark, sf_dir)
    rules = [("denied", F.lower("text").isin("the", "der", "la", "de")), ("short", (F.length("text") <= 4) & (F.length("text") % 5 != 0))]
    reason = F.coalesce("reason", F.lit("kept"))
    return terminology.drop_reasons(m, rules).groupBy("doc_id").agg(*(F.count_if(reason == r).alias(r) for r in ("denied", "short", "kept")))


@query(f"WITH {WORDS_SQL} SELECT w.doc_id, count(*) AS n, count(*) FILTER (substr(doc_text, s + 1 + CASE WHEN i % 7 = 3 THEN 1 ELSE 0 END, n) = word) AS right FROM w JOIN w0 USING (doc_id) GROUP BY w.doc_id")
def span_validate(spark, sf_dir):
    """How many spans hold their own text; every seventh is a character off."""
    off = F.when(F.col("i") % 7 == 3, 1).otherwise(0)
    m = word_mentions(spark, sf_dir).select("doc_id", F.col("text").alias("word"), (F.col("start_pos") + off).alias("s"), (F.col("end_pos") + off).alias("e"))
    return validation.span_counts(table(spark, sf_dir, "documents"), m)


_HEADERS = {"history": "license|apache", "family": "the of rend"}


@query(
    """WITH l AS (SELECT doc_id, length(text) AS n, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
p AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start FROM l),
k AS (SELECT *, CASE WHEN length(line) <= 120 AND regexp_matches(lower(line), 'license|apache') THEN 'history' WHEN length(line) <= 120 AND regexp_matches(lower(line), 'the of rend') THEN 'family' WHEN ends_with(rtrim(line), ':') THEN 'other' END AS kind FROM p)
SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY i), n) AS BIGINT) AS "end" FROM k WHERE kind IS NOT NULL"""
)
def sections(spark, sf_dir):
    found = context.sections(table(spark, sf_dir, "documents"), _HEADERS)
    return found.select("doc_id", "kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


def _negation_sql() -> str:
    """The last occurrence of each cue in turn, as the SURVEY's Q7 has it."""
    out = "h0 AS (SELECT *, -1 AS h FROM l)"
    for k, cue in enumerate(CUES):
        begins = f"CASE WHEN contains(w, '{cue}') THEN length(w) - strpos(reverse(w), '{cue[::-1]}') + 1 - {len(cue)} ELSE -1 END"
        out += f", h{k + 1} AS (SELECT conv_id, turn, w, CASE WHEN {begins} > h THEN {begins} + {len(cue)} ELSE h END AS h FROM h{k})"
    return out


@query(
    f"""WITH t AS (SELECT conv_id, turn, text, unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS i FROM conversations),
p AS (SELECT *, sum(length(word) + 1) OVER (PARTITION BY conv_id, turn ORDER BY i) - length(word) - 1 AS pos FROM t),
l AS (SELECT conv_id, turn, lower(substr(text, CAST(greatest(pos - 60, 0) + 1 AS BIGINT), CAST(least(pos, 60) AS BIGINT))) AS w FROM p), {_negation_sql()}
SELECT conv_id, turn, count(*) AS n, count(*) FILTER (h >= 0 AND NOT contains(w, 'not only') AND NOT regexp_matches(substr(w, h + 1), '[,.;:\\n]|(^|[^\\p{{L}}\\p{{N}}_])(but|und)($|[^\\p{{L}}\\p{{N}}_])')) AS negated
FROM h{len(CUES)} GROUP BY conv_id, turn"""
)
def negation_scope(spark, sf_dir):
    """Words in the scope of a negation, for every word of every turn."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.posexplode(F.split("text", " ")).alias("i", "word"))
    w = Window.partitionBy("conv_id", "turn").orderBy("i")
    at = (F.sum(F.length("word") + 1).over(w) - F.length("word") - 1).cast("int")
    placed = c.withColumn("at", at)
    return placed.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.count_if(context.negated(F.col("text"), F.col("at"), CUES, ("not only",), ("but", "und"), whole=False)).alias("negated"))


@query(
    """WITH m AS (SELECT conv_id, turn, text, length(text) // 2 AS pos FROM conversations)
SELECT conv_id, turn, pos - length(regexp_extract(substr(text, 1, pos), '[^.;?!\\n]*$')) AS head, pos + length(regexp_extract(substr(text, pos + 1), '^[^.;?!\\n]*')) AS tail FROM m"""
)
def sentence_context(spark, sf_dir):
    at = F.floor(F.length("text") / 2).cast("int")
    head, tail = context.sentence_bounds(F.col("text"), at)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", head.cast("long").alias("head"), tail.cast("long").alias("tail"))


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(2 + CASE WHEN l_returnflag = 'A' THEN 1 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END ELSE 0 END AS INT) AS tail FROM lineitem"""
)
def drug_tail_extend(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") == "A", "po").otherwise("then")
    status = F.when(F.col("l_linestatus") == "F", "qam:prn").otherwise("daily")
    tokens = F.split(F.concat_ws(" ", F.lit("drug"), F.col("l_quantity").cast("int").cast("string"), F.lit("mg"), flag, status, F.lit("for")), " ")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", context.sig_tail(tokens, F.lit(0), SIG).alias("tail"))


@query(
    """SELECT conv_id * 1000 + turn AS doc_id, CASE WHEN turn % 5 = 4 THEN -1 ELSE 0 END AS idx, unnest(CASE WHEN turn % 5 = 4 THEN ['bad_json'] ELSE list_filter([
  CASE WHEN role NOT IN ('user', 'assistant') OR turn % 3 = 1 THEN 'bad_type' END, CASE WHEN 4 > length(text) THEN 'bad_range' END, CASE WHEN turn % 2 = 1 THEN 'bad_text' END], lambda x: x IS NOT NULL) END) AS code FROM conversations"""
)
def validate_issues(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    head = F.substring("text", 1, 4)
    entity = F.struct(F.when(F.col("turn") % 2 == 1, F.concat(head, F.lit("?"))).otherwise(head).alias("text"), F.when(F.col("turn") % 3 == 1, "odd").otherwise(F.col("role")).alias("type"), F.lit(0).alias("start"), F.lit(4).alias("end"))
    payload = F.when(F.col("turn") % 5 == 4, "[{").otherwise(F.to_json(F.array(entity)))
    return validation.record_issues(c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text", payload.alias("payload")), ["user", "assistant"])


@query(
    """WITH c AS (SELECT conv_id * 10 + turn AS doc_id, text, length(text) AS n, turn % 5 AS f, turn % 2 = 1 AS back FROM conversations),
r AS (SELECT doc_id, text, f, 0 AS nr, CASE WHEN back THEN 1 ELSE 0 END AS idx, 0 AS s, 4 AS e, 'DIAG' AS type FROM c
  UNION ALL SELECT doc_id, text, f, 1, CASE WHEN back THEN 0 ELSE 1 END, 2, n + CASE WHEN f = 1 THEN 1 ELSE 0 END, 'TEST' FROM c),
i AS (
  SELECT doc_id, idx, 'error' AS level, 'missing_field' AS code FROM r WHERE f = 2 AND nr = 0
  UNION ALL SELECT doc_id, idx, 'error', 'bad_position' FROM r WHERE f = 3 AND nr = 0
  UNION ALL SELECT doc_id, idx, 'error', 'out_of_bounds' FROM r WHERE f = 1 AND nr = 1
  UNION ALL SELECT doc_id, idx, 'warning', 'needless_assertions' FROM r WHERE nr = 1
  UNION ALL SELECT doc_id, idx, 'error', 'unknown_assertion' FROM r WHERE f = 4 AND nr = 0
  UNION ALL SELECT doc_id, idx, 'error', 'no_candidates' FROM r WHERE f = 0 AND nr = 0
  UNION ALL SELECT doc_id, idx, 'warning', 'short_embedded' FROM r WHERE nr = 0 AND f NOT IN (2, 3) AND regexp_matches(substr(text, 5, 1), '[\\p{L}\\p{N}_]')
  UNION ALL SELECT doc_id, idx, 'warning', 'overlap' FROM r WHERE nr = 1 AND f <> 3
  UNION ALL SELECT doc_id, -1, 'warning', 'unsorted' FROM c WHERE back AND f NOT IN (2, 3))
SELECT doc_id, CAST(idx AS BIGINT) AS idx, level, code FROM i"""
)
def entity_issues(spark, sf_dir):
    """All faults of two entities in each turn: its first four characters and all after the second."""
    c = table(spark, sf_dir, "conversations").withColumn("f", F.col("turn") % 5)
    f, n, own = F.col("f"), F.length("text"), lambda *x: F.array(*x)
    strings = F.array().cast("array<string>")

    def entity(text, kind, position, assertions, candidates):
        return F.struct(text.alias("text"), F.lit(kind).alias("type"), position.alias("position"), assertions.alias("assertions"), candidates.alias("candidates"))

    head = entity(
        F.when(f != 2, F.substring("text", 1, 4)), "DIAG", F.when(f == 3, own(F.lit(0))).otherwise(own(F.lit(0), F.lit(4))),
        F.when(f == 4, own(F.lit("isOdd"))).otherwise(strings), F.when(f != 0, strings),
    )
    rest = entity(tx.slice_text("text", F.lit(2), n), "TEST", own(F.lit(2), n + (f == 1).cast("int")), own(F.lit("isNegated")), F.lit(None).cast("array<string>"))
    payload = F.to_json(F.when(F.col("turn") % 2 == 1, own(rest, head)).otherwise(own(head, rest)))
    records = c.select((F.col("conv_id") * 10 + F.col("turn")).alias("doc_id"), "text", payload.alias("payload"))
    return validation.entity_issues(records, TYPES, ["DIAG", "SYM", "DRUG"], ["DIAG", "DRUG"], ["isNegated", "isHistorical", "isFamily"])


@query(
    """WITH f AS (SELECT DISTINCT doc_id FROM labels WHERE doc_id IS NOT NULL), x AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 7 <> 0 AND doc_id IS NOT NULL)
SELECT doc_id, 'error' AS level, 'missing_output' AS code FROM x WHERE doc_id NOT IN (SELECT doc_id FROM f)
UNION ALL SELECT doc_id, 'warning', 'unexpected_output' FROM f WHERE doc_id NOT IN (SELECT doc_id FROM x)
UNION ALL SELECT -1, 'error', 'file_count' WHERE (SELECT count(*) FROM f) <> (SELECT count(*) FROM x)"""
)
def file_issues(spark, sf_dir):
    """Labelled documents against those that a run was to cover, all but every seventh; the row of the counts has id -1."""
    found = validation.file_issues(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").filter("doc_id % 7 <> 0"))
    return found.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long")))


@query(
    """SELECT p_partkey, lower(p_name) || ' ' || p_size || ' mg' || CASE p_partkey % 4 WHEN 1 THEN ' mg/ml' WHEN 2 THEN ' tab senna' ELSE '' END AS core,
  CASE p_partkey % 4 WHEN 0 THEN 'injectable,injection,oral' WHEN 1 THEN '' WHEN 2 THEN '' ELSE 'inhalation,tablet' END AS hints, true AS dose FROM part"""
)
def product_core(spark, sf_dir):
    """Parts as a prescriber would write them, without what isn't the product."""
    tail = F.element_at(F.array(*(F.lit(x) for x in ("po/iv", "mg/ml daily", "tab,senna", "viên;nhồi qam:prn"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    key = F.concat(F.lower("p_name"), F.lit(" "), F.col("p_size"), F.lit(" mg ("), F.lower("p_brand"), F.lit(" 5 mg bid) "), tail)
    core, hints = products.product_core(key)
    return table(spark, sf_dir, "part").select("p_partkey", core.alias("core"), F.array_join(hints, ",").alias("hints"), products.has_dose(key).alias("dose"))


@query(
    f"""WITH t AS (SELECT doc_id, list_filter(list_distinct(regexp_extract_all(lower(text), '[0-9a-zà-ỹ]+')), lambda x: NOT list_contains({products.TITLE_STOPWORDS!r}, x)) AS ts FROM documents)
SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, md5(array_to_string(list_sort(ts), ' ')) AS tokens FROM t"""
)
def title_tokens(spark, sf_dir):
    """Tokens of whole documents, read as titles."""
    ts = products.title_tokens(F.lower("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(ts).cast("long").alias("n"), F.md5(F.array_join(F.array_sort(ts), " ")).alias("tokens"))


@query("""SELECT doc_id, CASE WHEN h < 1500 THEN 'holdout' ELSE 'train' END AS split, h % 5 AS fold FROM (SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 AS h FROM documents)""")
def split_folds(spark, sf_dir):
    return datasets.split_folds(table(spark, sf_dir, "documents"), "doc_id", 15, 5)


@query("""SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2""")
def dataset_summary(spark, sf_dir):
    return datasets.summarize(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN d.doc_id IS NULL THEN 'orphan' ELSE 'both' END AS status FROM documents AS d FULL JOIN (SELECT DISTINCT doc_id FROM labels) AS l ON d.doc_id = l.doc_id""")
def id_reconcile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("d"))
    l = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("l")).distinct()  # noqa: E741
    return d.join(l, "doc_id", "full").select("doc_id", F.when(F.col("l").isNull(), "unlabelled").when(F.col("d").isNull(), "orphan").otherwise("both").alias("status"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_remainder(spark, sf_dir):
    return datasets.remainder(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    """WITH s AS (SELECT event_type, value AS v, user_id % 2 = 0 AS y, unnest([1.0, 5.0, 10.0, 20.0, 50.0]) AS threshold FROM events),
r AS (SELECT event_type, threshold, sum(CAST((v >= threshold) = y AS BIGINT)) AS n FROM s GROUP BY ALL)
SELECT event_type, CAST(max_by(threshold, (n, -threshold)) AS DOUBLE) AS threshold, CAST(max(n) AS BIGINT) AS "right" FROM r GROUP BY event_type"""
)
def threshold_sweep(spark, sf_dir):
    return datasets.threshold_sweep(table(spark, sf_dir, "events"), "event_type", "value", F.col("user_id") % 2 == 0, GRID)


@query("""SELECT p_partkey, lower(regexp_replace(regexp_replace(p_name || p_size || 'mg', '([0-9])([a-zA-ZÀ-ỹ])', '\\1 \\2', 'g'), '([a-zA-ZÀ-ỹ])([0-9])', '\\1 \\2', 'g')) AS term FROM part""")
def norm_term(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tx.norm_term(F.concat("p_name", F.col("p_size").cast("string"), F.lit("mg"))).alias("term"))


@query("SELECT conv_id, turn, md5(trim(lower(regexp_replace(text, '\\s+', ' ', 'g')))) AS digest FROM conversations")
def norm_ws(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(tx.norm_ws("text")).alias("digest"))


# ------------------------------------------------------- lexicons and reports


@query(
    """WITH c AS (SELECT p_type AS type, lower(p_name) AS text, count(*) AS n FROM part GROUP BY ALL)
SELECT * FROM c WHERE length(text) >= 9 AND text NOT IN ('red bolt', 'blue widget') AND (contains(text, ' ') OR n >= 2)"""
)
def phrase_lexicon(spark, sf_dir):
    return terminology.phrase_lexicon(table(spark, sf_dir, "part").select(F.col("p_type").alias("type"), F.col("p_name").alias("text")), 9, ["red bolt", "blue widget"], [])


@query("""SELECT lower(p_name) AS text, p_type AS type, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS codes FROM part WHERE p_size < 5 AND length(p_name) >= 9 GROUP BY ALL""")
def coded_lexicon(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_size < 5")
    return terminology.coded_lexicon(p.select(F.col("p_name").alias("text"), F.col("p_type").alias("type"), F.col("p_brand").alias("code")), 9, []).withColumn("codes", F.array_join("codes", "|"))


@query(
    """WITH f AS (SELECT p_name, p_type, count(*) AS n, min(p_partkey) AS o FROM part GROUP BY ALL),
b AS (SELECT p_name, CAST(sum(n) AS BIGINT) AS freq, max_by(p_type, (n, -o)) AS p_type FROM f GROUP BY p_name),
c AS (SELECT p_name, p_brand, min(p_partkey) AS o FROM part GROUP BY ALL),
r AS (SELECT p_name, string_agg(p_brand, '|' ORDER BY o, p_brand) AS contexts FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY o, p_brand) <= 2) GROUP BY p_name)
SELECT p_name, freq, p_type, contexts FROM b JOIN r USING (p_name)"""
)
def surface_forms(spark, sf_dir):
    return terminology.surface_forms(table(spark, sf_dir, "part"), "p_name", "p_type", "p_brand", "p_partkey").withColumn("contexts", F.array_join("contexts", "|"))


@query("SELECT p_type, count(*) AS n, count(*) FILTER (p_size > 25) AS n_seen, count(*) FILTER (NOT p_brand < 'Brand#2') AS n_uncoded FROM part GROUP BY 1")
def coverage_by_type(spark, sf_dir):
    return terminology.coverage_by_type(table(spark, sf_dir, "part"), "p_type", F.col("p_size") > 25, F.col("p_brand") < "Brand#2")


@query(
    """WITH t AS (SELECT DISTINCT p_name || ' ' || p_size AS term, p_brand AS code FROM part)
SELECT term, min(code) AS code FROM t WHERE length(term) >= 6 AND term NOT IN (SELECT p_name || ' ' || p_size FROM part WHERE p_type = 'SMALL') GROUP BY term HAVING count(DISTINCT code) = 1"""
)
def unambiguous_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    term = F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("term")
    return terminology.unambiguous(p.select(term, F.col("p_brand").alias("code")), p.filter("p_type = 'SMALL'").select(term))


@query("""SELECT p_partkey, p_name FROM part WHERE p_size < 3 UNION ALL SELECT p_partkey, upper(p_name) FROM part WHERE p_size >= 45 AND p_name NOT IN (SELECT p_name FROM part WHERE p_size < 3)""")
def supplement_append(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return terminology.supplement(p.filter("p_size < 3").select("p_partkey", "p_name"), p.filter("p_size >= 45").select("p_partkey", F.upper("p_name").alias("p_name")), "p_name", tx.norm_ws)


@query(
    """WITH e AS (SELECT p_name, p_type, count(*) - 1 AS again FROM part GROUP BY ALL)
SELECT p_name, (SELECT count(DISTINCT p_brand) FROM part AS q WHERE q.p_name = e.p_name) AS n_codes, count(*) AS n_groups, CAST(sum(again) AS BIGINT) AS repeats FROM e GROUP BY p_name HAVING n_codes > 1"""
)
def text_inconsistency(spark, sf_dir):
    return terminology.text_inconsistency(table(spark, sf_dir, "part"), "p_name", "p_brand", "p_type")


@query(
    f"""WITH {_INTERVALS_SQL}, o AS (SELECT g, k, s, e, (s, e) < lag((s, e)) OVER (PARTITION BY g ORDER BY k, s, e) AS u FROM l),
d AS (SELECT g, sum(c - 1) AS d FROM (SELECT g, s, e, count(*) AS c FROM l GROUP BY ALL) GROUP BY g)
SELECT g, CAST(count(*) FILTER (u) AS BIGINT) AS unsorted, CAST(any_value(d) AS BIGINT) AS duplicates FROM o JOIN d USING (g) GROUP BY g"""
)
def order_faults(spark, sf_dir):
    return spans.order_faults(_intervals(spark, sf_dir), "g", ["k", "s", "e"], ["s", "e"])


@query("""WITH t AS (SELECT DISTINCT lower(p_type) AS kind, p_name FROM part UNION SELECT 'name', s_name FROM supplier) SELECT kind, count(*) AS n, md5(string_agg(p_name, '|' ORDER BY p_name)) AS pool FROM t GROUP BY kind""")
def text_pools(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.lower("p_type").alias("kind"), "p_name")
    names = table(spark, sf_dir, "supplier").select(F.lit("name").alias("kind"), F.col("s_name").alias("p_name"))
    return datasets.text_pools([parts, names], "kind", "p_name").withColumn("pool", F.md5(F.array_join("pool", "|").cast("binary")))


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) <= 25")
def hash_sample(spark, sf_dir):
    """A sampling operator: 25 documents of each source."""
    return datasets.hash_sample(table(spark, sf_dir, "documents"), "source", "doc_id", 25)


@query("SELECT p_partkey, 'Take ' || p_name || ' daily.' AS text, 5 AS s, 5 + length(p_name) AS e FROM part")
def fill_template(spark, sf_dir):
    text, s, e = datasets.fill_template(F.lit("take {x} daily."), "{x}", F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text"), s.cast("long").alias("s"), e.cast("long").alias("e"))


@query("""SELECT p_partkey AS id, min_by(c, (length(c), o)) AS code FROM part JOIN (SELECT lower(p_name) AS t, p_brand || '/' || p_size AS c, p_partkey AS o FROM part WHERE p_size < 30) ON t = p_name GROUP BY 1""")
def title_link(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    titles = p.filter("p_size < 30").select(F.lower("p_name").alias("title"), F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("code"), F.col("p_partkey").alias("ord"))
    return linking.title_link(p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("key")), titles)


@query("""WITH e AS (SELECT p_name AS term, min(p_partkey) AS ord FROM part WHERE p_size < 3 GROUP BY 1) SELECT p_partkey AS id, min_by(term, ord) AS code FROM part JOIN e ON contains(' ' || lower(p_type) || ' ' || p_name || ' ', ' ' || term || ' ') GROUP BY 1""")
def first_contained(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    entries = p.filter("p_size < 3").groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("ord")).withColumn("code", F.col("term"))
    return linking.first_contained(p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", F.lower("p_type"), "p_name").alias("key")), entries)


@query("""WITH t AS (SELECT p_partkey, '  ' || p_name || chr(9) AS x FROM part) SELECT p_partkey, 2 AS s, 2 + length(p_name) AS e FROM t JOIN part USING (p_partkey)""")
def trimmed_spans(spark, sf_dir):
    x = F.concat(F.lit("  "), F.col("p_name"), F.lit("\t"))
    s, e = spans.trimmed(x, F.lit(0), F.length(x))
    return table(spark, sf_dir, "part").select("p_partkey", s.cast("long").alias("s"), e.cast("long").alias("e"))


@query(
    f"""WITH {WORDS_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, word ORDER BY s) - 1 AS occ FROM w WHERE n % 5 IN (0, 2)),
v AS (SELECT doc_id, CASE WHEN n % 5 = 0 THEN 'C' || n ELSE '__EMPTY__' END AS t, CASE WHEN n % 5 = 0 AND NOT ends_with(word, 'e') THEN 'C' || n ELSE '__EMPTY__' END AS p FROM o)
SELECT doc_id, round(CAST(count(*) FILTER (t = p) AS DOUBLE) / (count(*) + count(*) FILTER (t <> p)), 6) AS j FROM v GROUP BY doc_id"""
)
def jaccard_candidates(spark, sf_dir):
    """Candidate Jaccard of coded mentions, by document and occurrence."""
    m = word_mentions(spark, sf_dir).filter(F.col("type").isin("DIAG", "DRUG"))
    predicted = m.drop("candidates").withColumnRenamed("p_candidates", "candidates")
    return scoring.set_similarity(scoring.value_items(m, "candidates"), scoring.value_items(predicted, "candidates")).select("doc_id", F.round("j", 6).alias("j"))


@query(f"WITH {WORDS_SQL} SELECT doc_id, count(*) AS n, md5(string_agg(['DIAG', 'SYM', 'DRUG', 'TEST', 'RESULT'][n % 5 + 1] || ':' || word, ' ' ORDER BY s)) AS digest FROM w WHERE word <> '' AND NOT regexp_matches(word, '\\s') GROUP BY doc_id")
def word_streams(spark, sf_dir):
    m = word_mentions(spark, sf_dir).filter((F.col("text") != "") & ~F.col("text").rlike("\\s"))
    return scoring.word_stream(m).select("doc_id", F.size("words").cast("long").alias("n"), F.md5(F.replace(F.array_join("words", " "), F.lit("\t"), F.lit(":")).cast("binary")).alias("digest"))


@query()
def final_score(spark, sf_dir):
    """All shares of the final score over orders: their lines are mentions, and every third prediction is off."""
    li = table(spark, sf_dir, "lineitem")
    start = F.col("l_linenumber") * 10
    flag, none = F.array("l_returnflag"), F.array().cast("array<string>")
    truth = li.select(F.col("l_orderkey").alias("doc_id"), F.concat_ws(" ", "l_returnflag", F.col("l_partkey").cast("string")).alias("text"), F.when(F.col("l_linestatus") == "F", "DRUG").otherwise("SYM").alias("type"), start.alias("start_pos"), (start + 5).alias("end_pos"), F.when(F.col("l_partkey") % 2 == 0, flag).otherwise(none).alias("assertions"), F.when(F.col("l_linestatus") == "F", flag).otherwise(none).alias("candidates"))
    wrong = F.col("start_pos") % 30 == 0
    predicted = truth.withColumn("text", F.when(wrong, F.concat("text", F.lit(" x"))).otherwise(F.col("text"))).withColumn("assertions", F.when(wrong, none).otherwise(F.col("assertions")))
    found = scoring.score_documents(truth, predicted, ("DRUG", "SYM"), ("DRUG",))
    return found.select("num_scored", *(F.round(c, 6).alias(c) for c in ("wer", "j_assertions", "j_candidates", "final")))


# ------------------------------------------------------- after recognition


@query(
    f"""WITH {_INTERVALS_SQL}, y AS (SELECT *, CAST(k % 3 AS VARCHAR) AS t FROM l)
SELECT g, s, e, k, t FROM y AS a WHERE NOT EXISTS (SELECT 1 FROM y AS b WHERE b.g = a.g AND (b.t = a.t OR a.t = '0' AND b.t IN ('1', '2')) AND b.s <= a.s AND a.e <= b.e AND b.e - b.s > a.e - a.s)"""
)
def remove_nested_under(spark, sf_dir):
    m = _intervals(spark, sf_dir).withColumn("t", (F.col("k") % 3).cast("string"))
    return spans.remove_nested(m, "g", "s", "e", "t", under={"0": ["1", "2"]}).select("g", "s", "e", "k", "t")


@query(
    """WITH c AS (SELECT role, length(text) % 97 AS k, conv_id * 1000 + turn AS o, chr(CAST(97 + length(text) % 5 AS INT)) AS tag, turn % 2 = 0 AS edge FROM conversations),
g AS (SELECT role, k, bool_and(edge) AS edge, min(o) AS o, min_by(edge, o) AS first_edge, min_by(tag, o) AS first_tag FROM c GROUP BY ALL),
t AS (SELECT role, k, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM c JOIN g USING (role, k) WHERE g.edge OR NOT c.edge GROUP BY ALL)
SELECT role, k, o, CASE WHEN role = 'user' THEN first_edge ELSE edge END AS edge, CASE WHEN role = 'user' THEN first_tag ELSE tags END AS tags FROM g JOIN t USING (role, k)"""
)
def dedupe_plain_types(spark, sf_dir):
    """One role's rows stand for types without assertions, of which the first stays."""
    c = table(spark, sf_dir, "conversations")
    tags = F.array(F.chr((97 + F.length("text") % 5).cast("int")))
    m = c.select("role", (F.length("text") % 97).cast("long").alias("k"), (F.col("conv_id") * 1000 + F.col("turn")).alias("o"), tags.alias("tags"), (F.col("turn") % 2 == 0).alias("edge"))
    found = spans.dedupe_edge(m, ["role", "k"], "o", "tags", "edge", plain=F.col("role") == "user")
    return found.select("role", "k", "edge", "o", F.array_join("tags", "|").alias("tags"))


@query(
    f"""WITH {WORDS_SQL}, c AS (SELECT doc_id, s, n, i, word, CASE WHEN i % 3 = 0 AND n > 1 THEN substr(word, 1, n - 1) ELSE word END AS text, CASE WHEN i % 3 = 0 AND n > 1 THEN substr(word, n) ELSE ' ' END AS next FROM w WHERE regexp_full_match(word, '[a-z]+')),
r AS (SELECT doc_id, CASE WHEN text IN ('the', 'der') THEN 'denied' WHEN n % 5 = 0 AND ends_with(word, 'e') THEN 'uncoded' WHEN n % 5 <> 0 AND length(text) <= 4 AND next <> ' ' THEN 'embedded' WHEN length(text) <= 2 AND text <> 'la' THEN 'short' ELSE 'kept' END AS reason FROM c)
SELECT doc_id, reason, count(*) AS n FROM r GROUP BY ALL"""
)
def noise_reasons(spark, sf_dir):
    """Every third word is cut before its last letter; words of one length class are coded mentions."""
    m = word_mentions(spark, sf_dir).filter(F.col("text").rlike("^[a-z]+$"))
    cut = F.when((F.col("i") % 3 == 0) & (F.length("text") > 1), 1).otherwise(0)
    kind = F.when(F.length("text") % 5 == 0, "DRUG").otherwise("SYM")
    spoken = m.select("doc_id", F.col("start_pos").alias("start"), (F.col("end_pos") - cut).alias("end"), kind.alias("type"), F.substring("text", F.lit(1), F.length("text") - cut).alias("text"), F.col("p_candidates").alias("candidates"))
    options = postprocess.NoiseOptions(tuple((k, t) for k in ("DRUG", "SYM") for t in ("the", "der")), (("SYM", "la"), ("DRUG", "la")), drop_short=True)
    found = postprocess.noise_reasons(spoken, table(spark, sf_dir, "documents"), options)
    return found.groupBy("doc_id", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_TAILS = [" 5 mg PO bid, for pain", " 3 apples", " po điều trị ho", ":prn po"]


@query(
    """SELECT l_orderkey AS doc_id, l_linenumber, l_partkey, l_suppkey, 'n' || l_partkey || [' 5 mg PO bid', '', ' po', ''][l_linenumber % 4 + 1] AS text, 1 + length(CAST(l_partkey AS VARCHAR)) + [12, 0, 3, 0][l_linenumber % 4 + 1] AS "end" FROM lineitem"""
)
def product_directions(spark, sf_dir):
    """Each line of an order is a product's name with other words after it."""
    li = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("n"), F.col("l_partkey").cast("string"))
    tail = F.get(F.array(*(F.lit(t) for t in _TAILS)), (F.col("l_linenumber") % 4).cast("int"))
    end = extension.extended_end(F.col("doc"), F.lit(0), F.length("name")).cast("long")
    said = li.select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", "l_partkey", "l_suppkey", name.alias("name"), F.concat(name, tail).alias("doc"))
    return said.withColumn("end", end).select("doc_id", "l_linenumber", "l_partkey", "l_suppkey", F.substring("doc", F.lit(1), F.col("end").cast("int")).alias("text"), "end")


@query(
    """WITH m AS (SELECT *, count(*) OVER g AS n, count(*) FILTER (l_linenumber = 1) OVER g AS c FROM lineitem WINDOW g AS (PARTITION BY l_orderkey, l_returnflag, l_linestatus))
SELECT l_orderkey AS doc_id, 20 + l_linenumber AS start, l_returnflag AS text, CASE WHEN l_linestatus = 'F' THEN 'DRUG' ELSE 'DIAG' END AS type,
concat_ws('|', CASE WHEN l_orderkey % 3 = 0 THEN 'isFamily' END, CASE WHEN l_orderkey % 3 = 1 AND l_linestatus = 'F' THEN 'isHistorical' END, CASE WHEN n = 1 AND l_linenumber = 1 OR n > 1 AND 2 * c > n THEN 'isNegated' END) AS assertions,
'A10.' || l_linenumber || CASE WHEN l_linestatus = 'F' THEN '' ELSE '|A10.9' END AS candidates FROM m"""
)
def context_chain(spark, sf_dir):
    """Sections, majority and hedge over orders, whose header is a family history, a drug list or something else."""
    li = table(spark, sf_dir, "lineitem")
    header = F.get(F.array(F.lit("family history"), F.lit("home drugs"), F.lit("other things:")), (F.col("doc_id") % 3).cast("int"))
    docs = li.select(F.col("l_orderkey").alias("doc_id")).distinct().withColumn("text", F.concat(header, F.lit("\n" + "x" * 40)))
    said = F.when(F.col("l_linenumber") == 1, F.array(F.lit("isNegated"))).otherwise(F.array().cast("array<string>"))
    kind = F.when(F.col("l_linestatus") == "F", "DRUG").otherwise("DIAG")
    start = (20 + F.col("l_linenumber")).cast("long")
    mentions = li.select(F.col("l_orderkey").alias("doc_id"), start.alias("start"), (start + 1).alias("end"), kind.alias("type"), F.col("l_returnflag").alias("text"), said.alias("assertions"), F.array(F.concat(F.lit("A10."), F.col("l_linenumber").cast("string"))).alias("candidates"))
    words = postprocess.ContextWords({"family": "family history", "drug_history": "home drugs"})
    done = postprocess.post_process(mentions, docs, postprocess.ContextOptions(sections=True, consistency="majority", hedge="all"), words)
    return done.select("doc_id", "start", "text", "type", F.array_join("assertions", "|").alias("assertions"), F.array_join("candidates", "|").alias("candidates"))


def _plain_words(spark, sf_dir):
    m = word_mentions(spark, sf_dir).filter(F.col("text") != "")
    return m.select("doc_id", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "type", "text"), table(spark, sf_dir, "documents")


@query(
    f"""WITH {WORDS_SQL}, c AS (SELECT w.*, lower(substr(doc_text, CAST(greatest(s - 7, 0) + 1 AS BIGINT), CAST(s + n + 7 - greatest(s - 7, 0) AS BIGINT))) AS near FROM w JOIN w0 USING (doc_id) WHERE word <> '')
SELECT doc_id, count(*) AS n, CAST(sum(n) AS BIGINT) AS chars FROM c WHERE NOT (n % 5 IN (0, 1) AND (lower(word) = 'license' AND contains(near, 'license') OR lower(word) = 'under' AND contains(near, 'under t'))) GROUP BY doc_id"""
)
def without_false_positives(spark, sf_dir):
    m, docs = _plain_words(spark, sf_dir)
    kept = postprocess.without_false_positives(m, docs, (("license", "license", None, None), ("under", "under t", 7, 7)))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).cast("long").alias("chars"))


@query(
    f"""WITH {WORDS_SQL}, c AS (SELECT w.doc_id, n, starts_with(substr(doc_text, CAST(s + n + 1 AS BIGINT)), ' the') AS clipped, count(*) OVER (PARTITION BY w.doc_id, lower(word)) AS repeats FROM w JOIN w0 USING (doc_id) WHERE regexp_full_match(word, '[a-zA-Z]+'))
SELECT doc_id, count(*) FILTER (n <= 3) AS short, count(*) FILTER (clipped) AS clipped, count(*) FILTER (repeats > 1) AS repeated FROM c GROUP BY doc_id"""
)
def suspects(spark, sf_dir):
    m, docs = _plain_words(spark, sf_dir)
    found = postprocess.suspects(m.filter(F.col("text").rlike("^[a-zA-Z]+$")), docs, (" the",))
    return found.groupBy("doc_id").agg(F.count_if("short").alias("short"), F.count_if("clipped").alias("clipped"), F.count_if(F.col("repeats") > 1).alias("repeated"))
