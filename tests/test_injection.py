"""Lexicon injection, guarded merges, label projection and windowed inference."""

import pandas as pd
from pyspark.sql import functions as F

from spanloom.operators import injection
from spanloom.plans import inference

ARRAY = f"array<{injection.MENTION}>"


def mention(s, e, t="DRUG", tags=(), codes=()):
    return (s, e, t, list(tags), list(codes))


def fold(spark, f, own, matches, *more):
    df = spark.createDataFrame([(own, matches)], f"own {ARRAY}, m {ARRAY}")
    return sorted((x["s"], x["e"], x["type"], tuple(x["tags"])) for x in df.select(f(F.col("own"), F.col("m"), *more)).first()[0])


def test_injection_replaces_contained_and_stops_at_conflicts(spark):
    own = [mention(0, 4), mention(10, 14), mention(20, 24, "SYM")]
    got = fold(spark, injection.inject_terms, own, [mention(0, 4), mention(0, 8), mention(12, 18), mention(19, 25)])
    assert got == [(0, 8, "DRUG", ()), (10, 14, "DRUG", ()), (19, 25, "DRUG", ()), (20, 24, "SYM", ())]


def test_extension_needs_containment(spark):
    own = [mention(0, 4, "SYM", ["n"]), mention(6, 8, "SYM", ["h"]), mention(20, 24, "TEST", ["n"])]
    matches = [mention(0, 10, "SYM", codes=["a b"]), mention(22, 30, "TEST", codes=["x"]), mention(40, 43, "TEST", codes=["ecg"]), mention(50, 53, "TEST", codes=["zzz"])]
    got = fold(spark, injection.extend_phrases, own, matches, F.array(F.lit("ecg")))
    assert got == [(0, 10, "SYM", ("h", "n")), (20, 24, "TEST", ("n",)), (40, 43, "TEST", ())]


def test_guard_keeps_two_drugs_apart(spark):
    rows = [(64, "ciproflagyl", 0, 5, "DRUG", ["x"]), (64, "ciproflagyl", 5, 11, "DRUG", []), (65, "opioid", 0, 4, "DRUG", ["a"]), (65, "opioid", 4, 6, "SYM", ["b"]), (66, "Insulin glargine", 0, 7, "DRUG", []), (66, "Insulin glargine", 8, 16, "DRUG", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, s int, e int, type string, tags array<string>")
    codes = {"cipro": ["203563"], "flagyl": ["202866"]}
    got = injection.merge_guarded(df, lambda kind, text: codes.get(text, []), ("DRUG", "DIAG")).collect()
    assert sorted((r["doc_id"], r["s"], r["e"], r["type"], tuple(r["tags"])) for r in got) == [(64, 0, 5, "DRUG", ("x",)), (64, 5, 11, "DRUG", ()), (65, 0, 6, "DRUG", ("a", "b")), (66, 0, 7, "DRUG", ()), (66, 8, 16, "DRUG", ())]


def test_expansion_takes_tags(spark):
    own = spark.createDataFrame([(1, 0, 2, "D", ["a"]), (1, 3, 5, "D", ["b"]), (1, 9, 11, "D", []), (1, 0, 2, "S", [])], "doc_id long, s int, e int, type string, tags array<string>")
    got = injection.expand_spans(own, spark.createDataFrame([(1, 0, 6, "D")], "doc_id long, s int, e int, type string")).collect()
    assert sorted((r["s"], r["e"], r["type"], tuple(r["tags"])) for r in got) == [(0, 2, "S", ()), (0, 6, "D", ("a", "b")), (9, 11, "D", ())]


def test_labels_and_special_tokens(spark):
    tokens = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 0, 3), (1, 2, 3, 5), (1, 3, 6, 8)], "doc_id long, tok int, ts int, te int")
    got = injection.project_labels(tokens, spark.createDataFrame([(1, 1, 5, "D")], "doc_id long, s int, e int, type string")).orderBy("tok").collect()
    assert [r["label"] for r in got] == [None, "B-D", "I-D", "O"]


def test_clauses_move_spans(spark):
    df = spark.createDataFrame([([("Ho ra", 0, 2), ("sốt", 0, 3)],)], "c array<struct<text:string,s:int,e:int>>")
    got = df.select(injection.join_clauses(F.col("c"))).first()[0]
    assert got["text"] == "Ho ra. sốt" and [tuple(x) for x in got["spans"]] == [(0, 2), (7, 10)]


def test_windowed_inference_prefers_whole_spans(spark):
    tokens = spark.createDataFrame([(1, i, 2 * i, 2 * i + 1) for i in range(20)], "doc_id long, tok int, ts int, te int")
    truth = {3: "B-A", 4: "I-A", 7: "B-B", 8: "I-B", 9: "I-B", 15: "B-A"}
    predict = lambda w: pd.Series([truth.get(t, "O") for t in w["tok"]])
    got = inference.infer(tokens, predict, 10, 5).collect()
    assert sorted((r["s"], r["e"], r["type"]) for r in got) == [(6, 9, "A"), (14, 19, "B"), (30, 31, "A")]
