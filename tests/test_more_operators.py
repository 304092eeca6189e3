"""Vocabulary builders, alignment, context gates and the stream wrapper on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import context, linking, terminology, validation
from spanloom.plans.queries import QUERIES
from spanloom.streaming import document_stream, run_available


def test_categories_resolve_to_unspecified(spark):
    catalog = spark.createDataFrame([("J96", "x"), ("J96.09", "y"), ("J96.9", "z"), ("K00", "x"), ("K00.1", "Unspecified thing"), ("L01", "x")], "code string, title string")
    linked = spark.createDataFrame([(1, "J96"), (2, "K00"), (3, "L01")], "id int, code string")
    assert {r["id"]: r["code"] for r in linking.resolve_categories(linked, catalog).collect()} == {1: "J96.9", 2: "K00.1", 3: "L01"}


def test_alignment_takes_occurrences_in_order(spark):
    raw = spark.createDataFrame([(1, "ho sốt ho HO")], "doc_id long, text string")
    items = spark.createDataFrame([(1, 0, "ho"), (1, 1, "sốt"), (1, 2, "ho"), (1, 3, "ho"), (1, 4, "gone")], "doc_id long, idx int, text string")
    got = {r["idx"]: (r["start"], r["end"]) for r in linking.align_texts(raw, items).collect()}
    assert got == {0: (0, 2), 1: (3, 6), 2: (7, 9), 3: (10, 12)}


def test_concept_index_prefers_current_atoms(spark):
    cols = "code string, kind string, text string, ord long"
    current = spark.createDataFrame([("1", "SCD", "A 5mg", 5), ("1", "SY", "a 5 mg", 6)], cols)
    archive = spark.createDataFrame([("1", "OLD", "A 5 mg", 0), ("2", "OLD", "A 5 MG", 1)], cols)
    got = terminology.concept_index(current, archive, lambda c: tx.norm_term(c, composed=True))
    assert sorted(tuple(r) for r in got.collect()) == [("a 5 mg", "1", "SCD", "rrf_current"), ("a 5 mg", "2", "OLD", "rrf_archive")]


def test_prescribable_names_keep_the_first_spelling(spark):
    atoms = spark.createDataFrame([("1", "IN", "Aspirin", 1), ("2", "BN", "ASPIRIN", 2), ("3", "SCD", "aspirin 5", 3), ("4", "IN", "a b c d e", 4)], "code string, kind string, text string, ord long")
    assert [r["text"] for r in terminology.prescribable_names(atoms).collect()] == ["Aspirin"]


def test_expansion_reasons(spark):
    titles = spark.createDataFrame([("A00.1", "one two three"), ("A00.2", "one two three"), ("Z00.1", "one two four"), ("A00", "one two five"), ("A01.1", "one"), ("A01.2", "have it now")], "code string, term string")
    have = spark.createDataFrame([("have it now",)], "term string")
    got = {r["code"]: r["reason"] for r in terminology.expansion_reasons(titles, have).collect()}
    assert got == {"A00.1": None, "A00.2": "known", "Z00.1": "chapter", "A00": "level", "A01.1": "short", "A01.2": "known"}


def test_proposals_must_be_in_the_catalog(spark):
    terms = spark.createDataFrame([("a", "D", "A00"), ("b", "D", "B00")], "term string, type string, code string")
    proposals = spark.createDataFrame([("a", "D", "A00.9"), ("b", "D", "zz"), ("b", "D", "Q99")], "term string, type string, proposed string")
    catalog = spark.createDataFrame([("A00.9",), ("zz",)], "code string")
    got = {r["term"]: (r["code"], r["origin"]) for r in terminology.apply_proposals(terms, proposals, r"^[A-Z]\d{2}([.]\d+)?$", catalog).collect()}
    assert got == {"a": ("A00.9", "recoded"), "b": ("B00", "kept")}


def test_catalog_names(spark):
    raw = spark.createDataFrame([(1, "A00", "Tả", "A00.1", "Tả x"), (2, "A00", "tả", "", "none")], "ord long, c1 string, n1 string, c2 string, n2 string")
    assert [tuple(r) for r in terminology.catalog_names(raw, [("c1", "n1"), ("c2", "n2")]).collect()] == [("A00", "Tả"), ("A00.1", "Tả x")]


def test_hedge_and_salvage(spark):
    df = spark.createDataFrame([(["A00.1"],), (["A00.9"],), (["A00"],), (["A00.1", "B00.1"],)], "c array<string>")
    assert [r[0] for r in df.select(context.hedge_codes(F.col("c"))).collect()] == [["A00.1", "A00.9"], ["A00.9"], ["A00"], ["A00.1", "B00.1"]]
    raw = spark.createDataFrame([('text [{"a": "x"}] more',), ("none",), ("[oops",), (None,)], "r string")
    assert [[x["a"] for x in r[0]] for r in raw.select(context.salvage_list(F.col("r"), "array<struct<a:string>>")).collect()] == [["x"], [], [], []]


def test_family_gate(spark):
    df = spark.createDataFrame([(["isFamily", "isNegated"], None, "x"), (["isFamily"], "family", "x"), (["isFamily"], None, "His Mother had it")], "tags array<string>, kind string, sentence string")
    assert [r["tags"] for r in context.family_gate(df, "mother|father").collect()] == [["isNegated"], ["isFamily"], ["isFamily"]]


def test_candidates_merge_products_first(spark):
    df = spark.createDataFrame([(1, "a", "IN", 9.0, 0), (1, "b", "SCD", 1.0, 1), (1, "a", "BN", 3.0, 2)], "id int, code string, kind string, score double, ord int")
    assert [(r["code"], r["kind"], r["score"]) for r in linking.merge_candidates(df).orderBy("rank").collect()] == [("b", "SCD", 1.0), ("a", "IN", 9.0)]


def test_stream_appends_what_is_new(spark, tmp_path):
    schema = "doc_id long, text string"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    step = lambda d: linking.exact_link(d.select(F.col("doc_id").alias("id"), F.col("text").alias("key")), d.sparkSession.createDataFrame([("a", "1")], "term string, code string"))
    for i, t in enumerate(["a", "b"]):
        spark.createDataFrame([(i, t)], schema).write.mode("append").parquet(source)
        run_available(document_stream(spark, source, schema), step, out, str(tmp_path / "state"))
    assert {r["id"]: r["codes"] for r in spark.read.parquet(out).collect()} == {0: ["1"], 1: []}


def test_truth_against_itself_scores_one(spark):
    from spanloom.operators import scoring

    data = [(1, "a b", "DRUG", 0, 3, ["isNegated"], ["7"]), (1, "a b", "DRUG", 9, 12, [], []), (2, "c", "SYM", 0, 1, [], [])]
    m = spark.createDataFrame(data, "doc_id long, text string, type string, start_pos int, end_pos int, assertions array<string>, candidates array<string>")
    same = scoring.score_documents(m, m, ("DRUG", "SYM"), ("DRUG",)).first()
    assert (same["num_scored"], same["wer"], same["j_assertions"], same["j_candidates"], same["final"]) == (2, 0.0, 1.0, 1.0, 1.0)
    none = scoring.score_documents(m, m.filter("doc_id = 2"), ("DRUG", "SYM"), ("DRUG",)).first()
    assert none["num_scored"] == 2 and none["wer"] == 0.5 and none["j_candidates"] == 0.0 and none["j_assertions"] == 0.5


def test_negation_ends_at_clauses_and_is_vetoed(spark):
    from pyspark.sql import functions as F
    from spanloom.operators import context

    cases = [("no pain", 3, True), ("no pain, fever", 9, False), ("no pain but fever", 12, False), ("cannot rule out fever", 16, False), ("fever", 0, False), ("no butter", 3, True)]
    df = spark.createDataFrame([(t, a, w) for t, a, w in cases], "t string, a int, w boolean")
    got = df.select(context.negated(F.col("t"), F.col("a"), ["no", "rule out"], ("cannot rule",), ("but",)).alias("g"), "w").collect()
    assert [r["g"] for r in got] == [r["w"] for r in got]


@pytest.mark.parametrize(
    ("key", "core", "hints"),
    [
        ("clonazepam 0.5 mg po qam:prn", "clonazepam 0.5 mg", ["oral"]),
        ("prograf (dose decreased from 5mg bid", "prograf", []),
        ("a 5 mg/ml iv/po", "a 5 mg/ml", ["injectable", "injection", "oral"]),
        ("b iv/x/c đường", "b iv/x/c", []),
        ("c po,zinc -- !", "c po zinc", ["oral"][:0]),
        ("  ", "", []),
        (None, None, None),
    ],
)
def test_product_core(spark, key, core, hints):
    from spanloom.functions import products

    row = spark.createDataFrame([(key,)], "k string").select(*products.product_core(F.col("k"))).first()
    assert tuple(row) == (core, hints)


def test_title_tokens_and_doses(spark):
    from spanloom.functions import products

    rows = spark.createDataFrame([("viêm gan b, của viêm gan",), ("the",), ("5 mg",), ("10/20",), ("mg 5",), ("x 3g",), ("3 grams",)], "t string")
    got = [tuple(r) for r in rows.select(products.title_tokens(F.col("t")), products.has_dose(F.col("t"))).collect()]
    assert [sorted(g[0]) for g in got[:2]] == [["b", "gan", "viêm"], []]
    assert [g[1] for g in got[2:]] == [True, True, False, True, False]


def test_spelled_out_keys_are_never_broadcast(spark):
    """Before, whichever side Spark took for the smaller was: keys, whose runs it doesn't count."""
    mentions = spark.range(100).select("id", F.lit("cold small plate now").alias("key"))
    terms = spark.createDataFrame([(f"plate {i} of a longer vocabulary", "C", i) for i in range(5000)] + [("small plate", "A", 7), ("plate", "B", 9)], "term string, code string, ord long")
    for linked, want in ((linking.containment_link(mentions, terms), "small plate"), (linking.first_contained(mentions, terms), "A")):
        # runs of words are the only Generate; BuildLeft would make them the side that is broadcast
        assert "BuildLeft" not in linked._jdf.queryExecution().sparkPlan().toString()
        assert {tuple(r) for r in linked.collect()} == {(i, want) for i in range(100)}


def test_spans_are_judged_in_their_documents_row(spark):
    """Before, each span carried its whole text through the join and walked it from the beginning."""
    long = "é😀\n" * 300  # 900 code points, several blocks
    docs = spark.createDataFrame([(1, long), (2, ""), (3, None), (4, "ab"), (4, "xb"), (None, "ab")], "doc_id long, text string")
    spans = [(1, 0, 900, long), (1, 255, 258, long[255:258]), (1, 256, 512, long[256:512]), (1, 511, 513, "?😀"), (1, 899, 901, "\n"), (1, 900, 900, ""), (1, 2000, 2000, ""), (1, 2000, 2001, "x"), (1, -1, 2, "é"), (1, 2, 1, ""), (1, None, 1, "é")]
    spans += [(2, 0, 0, ""), (2, 0, 1, "a"), (3, 0, 0, ""), (4, 0, 1, "a"), (4, 1, 2, "b"), (9, 0, 1, "a"), (None, 0, 1, "a")]
    counted = validation.span_counts(docs, spark.createDataFrame(spans, "doc_id long, s long, e long, word string"))
    # of a null text no slice is equal to anything
    assert {r["doc_id"]: (r["n"], r["right"]) for r in counted.collect()} == {1: (11, 6), 2: (2, 1), 3: (1, 0), 4: (4, 3)}
    assert "substring(text" not in QUERIES["span_validate"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
