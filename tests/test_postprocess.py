"""Directions after products, the noise filter and the chain of context rules, on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from spanloom import sources
from spanloom.operators import extension, spans
from spanloom.operators.postprocess import ContextOptions, ContextWords, NoiseOptions, noise_reasons, post_process, suspects, without_false_positives

MENTION = "doc_id long, start long, end long, type string, text string, assertions array<string>, candidates array<string>"


DIRECTIONS = [
    ("aspirin 5 mg po bid, for pain", "aspirin", "aspirin 5 mg po bid"),
    ("suboxone 3 then", "suboxone", "suboxone"),
    ("zosyn 8", "zosyn", "zosyn"),
    ("codeine ml po q6h:prn điều trị ho", "codeine ml po q6", "codeine ml po q6h:prn"),
    ("atenololtrong po", "atenololt", "atenololt"),
    ("senna po\nbid", "senna", "senna po"),
    ("senna po bid tid qid prn stat once ac", "senna", "senna po bid tid qid prn stat"),
    ("senna 1. po", "senna", "senna"),
    ("senna PO; 3-4 viên.", "senna", "senna PO; 3-4"),
    ("senna PO; 3-4 viên", "senna", "senna PO; 3-4 viên"),
    ("senna", "senna", "senna"),
    ("senna : po", "senna", "senna"),
]


def test_directions(spark):
    df = spark.createDataFrame([(i, t, len(own)) for i, (t, own, _) in enumerate(DIRECTIONS)], "i int, t string, e int")
    ends = {r[0]: r[1] for r in df.select("i", extension.extended_end(F.col("t"), F.lit(0), F.col("e"))).collect()}
    assert [t[: ends[i]] for i, (t, _, _) in enumerate(DIRECTIONS)] == [want for _, _, want in DIRECTIONS]


def test_first_seen_row_of_plain_types(spark):
    rows = [(1, "TEST", 2, ["b"], False), (1, "TEST", 1, ["c"], True), (1, "SYM", 1, ["c"], True), (1, "SYM", 2, ["b"], False)]
    df = spark.createDataFrame(rows, "k int, type string, o int, tags array<string>, edge boolean")
    got = spans.dedupe_edge(df, ["k", "type"], "o", "tags", "edge", plain=F.col("type") == "TEST").collect()
    assert sorted((r["type"], r["tags"], r["edge"], r["o"]) for r in got) == [("SYM", ["b"], False, 1), ("TEST", ["c"], True, 1)]


def test_nested_under_other_types(spark):
    rows = [(1, 0, 9, "DIAG"), (1, 0, 9, "SYM"), (1, 2, 4, "SYM"), (1, 2, 4, "TEST"), (2, 2, 4, "SYM")]
    df = spark.createDataFrame(rows, "g int, s int, e int, t string")
    got = spans.remove_nested(df, "g", "s", "e", "t", under={"SYM": ["DIAG", "DRUG"]}).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 9, "DIAG"), (1, 0, 9, "SYM"), (1, 2, 4, "TEST"), (2, 2, 4, "SYM")]


def test_extension_hits_no_other_mention(spark):
    docs = spark.createDataFrame([(1, "senna po bid ho"), (2, "senna po bid ho")], "doc_id long, text string")
    rows = [(1, 0, 5, "DRUG", "senna", [], []), (2, 0, 5, "DRUG", "senna", [], []), (2, 9, 12, "SYM", "bid", [], []), (3, 0, 5, "DRUG", "senna", [], [])]
    got = extension.extend_products(spark.createDataFrame(rows, MENTION), docs).collect()
    assert sorted((r["doc_id"], r["end"], r["text"]) for r in got) == [(1, 12, "senna po bid"), (2, 5, "senna"), (2, 12, "bid"), (3, 5, "senna")]


def test_noise_rules_in_order(spark):
    docs = spark.createDataFrame([(1, "cay xyz ab no")], "doc_id long, text string")
    rows = [
        (1, 0, 3, "SYM", "Cay", [], []), (1, 4, 6, "SYM", "xy", [], []), (1, 4, 6, "DRUG", "xy", [], ["c"]), (1, 4, 7, "DRUG", "xyz", [], None),
        (1, 8, 10, "SYM", "ab", [], []), (1, 11, 13, "SYM", "no", [], []), (1, 4, 7, "SYM", "xyz", [], []),
    ]
    options = NoiseOptions(denied=(("SYM", "cay"),), short_allowed=(("SYM", "no"), ("DRUG", "xy")), drop_short=True)
    got = noise_reasons(spark.createDataFrame(rows, MENTION), docs, options).collect()
    assert sorted((r["start"], r["end"], r["type"], r["reason"] or "") for r in got) == [
        (0, 3, "SYM", "denied"), (4, 6, "DRUG", ""), (4, 6, "SYM", "embedded"), (4, 7, "DRUG", "uncoded"), (4, 7, "SYM", ""), (8, 10, "SYM", "short"), (11, 13, "SYM", ""),
    ]


WORDS = ContextWords({"family": "family history", "drug_history": "home drugs"}, ("no ",), ("no longer",), ("but",), "mother")


def chain(spark, options, curated=None):
    docs = spark.createDataFrame([(1, "home drugs\nsenna ho\nend:\nno ho but ho. mother ho"), (2, "ho")], "doc_id long, text string")
    rows = [
        (1, 11, 16, "DRUG", "senna", [], ["x"]), (1, 17, 19, "SYM", "ho", [], []), (1, 28, 30, "SYM", "ho", ["isFamily"], []),
        (1, 35, 37, "SYM", "ho", [], []), (1, 46, 48, "SYM", "ho", ["isFamily", "isFamily"], []), (2, 0, 2, "DIAG", "Ho", None, ["A00.1"]), (3, 0, 2, "TEST", "t", ["b", "a"], []),
    ]
    got = post_process(spark.createDataFrame(rows, MENTION), docs, options, WORDS, curated).collect()
    return {(r["doc_id"], r["start"]): (r["assertions"], r["candidates"]) for r in got}


def test_chain_steps(spark):
    none = chain(spark, ContextOptions())
    assert none[1, 46] == (["isFamily"], []) and none[3, 0] == (["b", "a"], []) and none[2, 0] == ([], ["A00.1"])
    some = chain(spark, ContextOptions(sections=True, negation=True, family_gate=True))
    assert [some[1, p][0] for p in (11, 17, 28, 35, 46)] == [["isHistorical"], [], ["isNegated"], [], ["isFamily"]]
    union = chain(spark, ContextOptions(negation=True, family_gate=True, consistency="union"))
    assert union[1, 17][0] == union[1, 46][0] == ["isFamily", "isNegated"] and union[1, 11][0] == []
    assert chain(spark, ContextOptions(negation=True, consistency="majority"))[1, 28][0] == ["isFamily"]
    assert chain(spark, ContextOptions(hedge="all"))[2, 0][1] == ["A00.1", "A00.9"]
    assert chain(spark, ContextOptions(hedge="uncurated"), spark.createDataFrame([(" ho",)], "text string"))[2, 0][1] == ["A00.1"]
    with pytest.raises(ValueError):
        ContextOptions(hedge="some")


def test_false_positives_and_suspects(spark):
    docs = spark.createDataFrame([(1, "Ban đầu có ban. Viêm gan, viêm")], "doc_id long, text string")
    rows = [(1, 0, 3, "SYM", "Ban", [], []), (1, 0, 3, "DRUG", "Ban", [], []), (1, 11, 14, "SYM", "ban", [], []), (1, 16, 20, "DIAG", "Viêm", [], []), (1, 26, 30, "DIAG", "viêm", [], []), (2, 0, 3, "SYM", "ban", [], [])]
    df = spark.createDataFrame(rows, MENTION)
    assert sorted((r["doc_id"], r["start"], r["type"]) for r in without_false_positives(df, docs).collect()) == [(1, 0, "DRUG"), (1, 11, "SYM"), (1, 16, "DIAG"), (1, 26, "DIAG"), (2, 0, "SYM")]
    got = {(r["doc_id"], r["start"], r["type"]): (r["short"], r["clipped"], r["repeats"]) for r in suspects(df, docs).collect()}
    assert got == {(1, 0, "SYM"): (True, False, 2), (1, 0, "DRUG"): (True, False, 1), (1, 11, "SYM"): (True, False, 2), (1, 16, "DIAG"): (False, True, 2), (1, 26, "DIAG"): (False, False, 2), (2, 0, "SYM"): (True, False, 1)}


def test_append_to_a_vocabulary(spark, tmp_path):
    base = spark.createDataFrame([("b", "1"), ("d", "2")], "code string, title string")
    more = spark.createDataFrame([("x", "c", "3"), ("x", "b", "other"), ("x", "c", "3")], "note string, code string, title string")
    read = lambda name: [tuple(r) for r in sources.vocabulary(spark, str(tmp_path / name), "code title").orderBy("code", "title").collect()]
    sources.append_sorted(base, more, str(tmp_path / "again"), ["code"], resume=True)
    assert read("again") == [("b", "1"), ("c", "3"), ("d", "2")]
    sources.append_sorted(base, more, str(tmp_path / "all"), ["code"])
    assert read("all") == [("b", "1"), ("b", "other"), ("c", "3"), ("c", "3"), ("d", "2")]
    sources.append_sorted(base.limit(0), more.limit(0), str(tmp_path / "none"), ["code"], resume=True)
    assert read("none") == []
