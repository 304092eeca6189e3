"""Operators against hand-made cases and plain-Python specifications."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import context, datasets, linking, scoring, spans, terminology, validation


def one(df):
    return df.first()[0]


def test_norm_term_spacing_and_composition(spark):
    df = spark.createDataFrame([("  500mg ệ5\n X ",), ("ét",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.norm_term("t")).collect()] == ["500 mg ệ 5 x", "ét", None]


def test_norm_is_idempotent(spark):
    df = spark.createDataFrame([("Ab12c  D",), ("  x  ",)], "t string").select(tx.norm_term("t").alias("a"))
    assert df.filter(tx.norm_term("a") != F.col("a")).count() == 0


def test_norm_synonyms_in_order(spark):
    df = spark.createDataFrame([("Typ II x",)], "t string")
    assert one(df.select(tx.norm_synonyms("t", [(" typ ", " type "), (" type ii ", " t2 ")]))) == "t2 x"


@pytest.mark.parametrize(("c", "is_word"), [("ố", True), ("_", True), ("५", True), ("²", True), ("-", False), ("", False)])
def test_word_char(spark, c, is_word):
    assert one(spark.range(1).select(tx.is_word_char(F.lit(c)))) is is_word


def test_jaccard_edges(spark):
    a = spark.createDataFrame([([], []), ([], ["x"]), (["x", "y"], ["y", "z"])], "a array<string>, b array<string>")
    assert [r[0] for r in a.select(scoring.jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, pytest.approx(1 / 3)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_matches_a_table(spark):
    r = random.Random(1)
    rows = [([r.choice("abc") for _ in range(r.randrange(7))], [r.choice("abc") for _ in range(r.randrange(7))]) for _ in range(200)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", scoring.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [(x["a"], x["b"], x["d"]) for x in got] == [(a, b, levenshtein(a, b)) for a, b in rows]


def test_word_error_rate_edges(spark):
    df = spark.createDataFrame([([], []), ([], ["x"]), (["x"], ["y", "z"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(scoring.word_error_rate(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, 2.0]


def test_truth_against_itself_scores_one(spark):
    m = spark.createDataFrame([(1, "a", "DRUG", 0, 1, ["C1"]), (1, "a", "DRUG", 5, 6, []), (2, "b", "DIAG", 0, 1, ["C2", "C3"])], "doc_id long, text string, type string, start_pos int, end_pos int, candidates array<string>")
    items = scoring.value_items(m, "candidates")
    assert {r["j"] for r in scoring.set_similarity(items, items).collect()} == {1.0}
    assert {r["doc_id"]: r["w"] for r in scoring.candidate_weights(m).collect()} == {1: 3, 2: 3}


def greedy(xs):
    kept = []
    for s, e in xs:
        if not any(max(s, a) < min(e, b) for a, b in kept):
            kept.append((s, e))
    return kept


def test_greedy_resolution_matches_a_loop(spark):
    r = random.Random(2)
    rows = [(g, s, s + r.randrange(6), i) for g in range(40) for i in range(8) for s in [r.randrange(20)]]
    df = spark.createDataFrame(rows, "g int, s int, e int, i int")
    got = spans.resolve_overlaps(df, "g", [F.col("s") - F.col("e"), F.col("s"), F.col("i")], ["s", "e"]).collect()
    want = [(g, *x) for g in range(40) for x in greedy([(s, e) for _, s, e, _ in sorted((q for q in rows if q[0] == g), key=lambda q: (q[1] - q[2], q[1], q[3]))])]
    assert sorted(tuple(x) for x in got) == sorted(want)


def test_dedupe_prefers_spans_not_cut(spark):
    df = spark.createDataFrame([("k", 1, ["a"], True), ("k", 2, ["b"], False), ("l", 1, ["a"], True), ("l", 2, ["c"], True)], "k string, o int, tags array<string>, edge boolean")
    assert {r["k"]: (r["tags"], r["edge"]) for r in spans.dedupe_edge(df, ["k"], "o", "tags", "edge").collect()} == {"k": (["b"], False), "l": (["a", "c"], True)}


def test_bio_orphans_open_spans(spark):
    tags = ["I-A", "I-A", "O", "B-A", "I-B", "I-B", "B-B"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], "d int, i int, label string")
    got = sorted((r["type"], r["first"], r["last"]) for r in spans.decode_bio(df, ["d"], ["i"]).collect())
    assert got == [("A", 0, 1), ("A", 3, 3), ("B", 4, 5), ("B", 6, 6)]


@pytest.mark.parametrize(("n", "want"), [(0, [(0, 0)]), (10, [(0, 10)]), (11, [(0, 10), (7, 11)]), (17, [(0, 10), (7, 17)])])
def test_token_windows(spark, n, want):
    got = one(spark.range(1).select(spans.token_windows(F.lit(n), 10, 3)))
    assert [tuple(x) for x in got] == want


def test_fragments_merge_inside_words_only(spark):
    df = spark.createDataFrame([("opioid use x", [(0, 4, "DRUG"), (4, 6, "SYM"), (7, 10, "SYM"), (11, 12, "SYM")])], "t string, xs array<struct<s:int,e:int,type:string>>")
    assert [tuple(x) for x in one(df.select(spans.merge_fragments(F.col("xs"), F.col("t"))))] == [(0, 6, "DRUG"), (7, 10, "SYM"), (11, 12, "SYM")]


def test_remove_nested(spark):
    df = spark.createDataFrame([(1, 0, 9, "S"), (1, 2, 4, "S"), (1, 2, 4, "D")], "g int, s int, e int, t string")
    assert sorted(tuple(r) for r in spans.remove_nested(df, "g", "s", "e", "t").collect()) == [(1, 0, 9, "S"), (1, 2, 4, "D")]


def test_exact_and_tiered_links(spark):
    terms = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "term string, code string")
    m = spark.createDataFrame([(1, "a"), (2, "b x"), (3, "z")], "id int, key string")
    core = lambda d: linking.exact_link(d.withColumn("key", F.substring_index("key", " ", 1)), terms)
    got = linking.tiered_link(m, [("exact", lambda d: linking.exact_link(d, terms)), ("core", core)]).collect()
    assert {r["id"]: (r["codes"], r["tier"]) for r in got} == {1: (["1", "2"], "exact"), 2: (["3"], "core"), 3: ([], "none")}


def test_phrases_overlap_and_respect_words(spark):
    docs = spark.createDataFrame([(1, "a a a ba A"), (2, ""), (3, None)], "doc_id long, text string")
    lex = spark.createDataFrame([("a a",), ("a",)], "phrase string")
    got = sorted((r["phrase"], r["start"]) for r in linking.phrase_occurrences(docs, lex).collect())
    assert got == [("a", 0), ("a", 2), ("a", 4), ("a", 9), ("a a", 0), ("a a", 2)]


def test_fuzzy_link_against_all_pairs(spark):
    import difflib

    r = random.Random(3)
    word = lambda: "".join(r.choice("ab ") for _ in range(r.randrange(4, 12)))
    keys, terms = sorted({word() for _ in range(30)}), sorted({word() for _ in range(30)})
    got = {x["id"]: x["term"] for x in linking.fuzzy_link(spark.createDataFrame([(k, k) for k in keys], "id string, key string"), spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    want = {}
    for k in keys:
        best = max(((difflib.SequenceMatcher(None, k, t).ratio(), t) for t in terms), key=lambda x: x[0])
        if best[0] >= 0.86:
            want[k] = best[1]
    assert got == want


def test_prefix_link_prefers_tier_then_length(spark):
    p = spark.createDataFrame([("a b long", "1", "X"), ("a b", "2", "X"), ("a bc", "3", "X"), ("a b zz", "4", "Y")], "text string, code string, tty string")
    got = linking.prefix_link(spark.createDataFrame([(1, "a b")], "id int, core string"), p, F.when(F.col("tty") == "Y", 0).otherwise(1))
    assert [tuple(r) for r in got.collect()] == [(1, ["4", "1"])]


def test_mode_takes_the_greatest_on_ties(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x"), ("b", "z")], "k string, c string")
    assert {r["k"]: (r["c"], r["n_codes"]) for r in terminology.mode_code(df, "k", "c").collect()} == {"a": ("y", 2), "b": ("x", 2)}


def test_ancestor_and_audit(spark):
    catalog = spark.createDataFrame([("S06",), ("S06.4",), ("I48",), ("I48.9",), ("I48.0",), ("J96",)], "code string")
    codes = spark.createDataFrame([("S06.4X9A",), ("I48",), ("Q00.1",), ("J96",)], "code string")
    got = {r["code"]: (r["action"], r["proposed"]) for r in terminology.audit_codes(codes, catalog).collect()}
    assert got == {"S06.4X9A": ("ancestor", "S06.4"), "I48": ("promote", "I48.9"), "Q00.1": ("review", None), "J96": ("keep", "J96")}


def test_votes(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x")], "k string, v string")
    assert [(r["k"], r["v"]) for r in terminology.vote(df, ["k"], "v").collect()] == [("a", "x")]
    assert sorted((r["k"], r["v"]) for r in terminology.vote(df, ["k"], "v", majority=False).collect()) == [("a", "x"), ("a", "y")]


def test_sections_close_at_the_next_mark(spark):
    docs = spark.createDataFrame([(1, "x\nPast History\nab\nother:\nc")], "doc_id long, text string")
    got = [(r["kind"], r["start"], r["end"]) for r in context.sections(docs, {"history": "history"}).orderBy("start").collect()]
    assert got == [("history", 2, 18), ("other", 18, 26)]


@pytest.mark.parametrize(("text", "negated"), [("no sign of fever", True), ("no pain. fever", False), ("known fever", False)])
def test_negation_scope(spark, text, negated):
    assert one(spark.range(1).select(context.negated(F.lit(text), F.lit(text.index("fever")), ["no"]))) is negated


def test_drug_tail_stops_at_prose(spark):
    tokens = F.split(F.lit("senna 8.6 mg po bid:prn for cough"), " ")
    assert one(spark.range(1).select(context.sig_tail(tokens, F.lit(0), ["mg", "po", "bid", "prn"]))) == 4


def test_issues(spark):
    rows = [(1, "abcd", '[{"text":"ab","type":"T","start":0,"end":2},{"text":"x","type":"?","start":2,"end":9}]'), (2, "a", "[{")]
    got = validation.record_issues(spark.createDataFrame(rows, "doc_id long, text string, payload string"), ["T"]).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, "bad_range"), (1, 1, "bad_text"), (1, 1, "bad_type"), (2, -1, "bad_json")]


def test_entity_issues(spark):
    import json

    good = {"text": "ab", "type": "D", "position": [0, 2], "assertions": [], "candidates": ["1"]}
    odd = [
        good | {"type": "?"}, good | {"position": [0, 9]}, good | {"text": "xy"}, good | {"assertions": ["odd"]}, good | {"assertions": "x"}, good | {"candidates": [1]},
        {k: v for k, v in good.items() if k != "candidates"}, good | {"type": "T", "assertions": ["neg"]}, {"text": "ab"}, 7, None, good | {"text": 3}, good | {"position": [0, 1.5]},
        good | {"position": [0]}, good | {"candidates": None}, good | {"assertions": ["neg", None]},
    ]
    rows = [(i, "ab cd", json.dumps([x])) for i, x in enumerate(odd)]
    rows += [(100, None, "[]"), (101, "ab", "[{"), (102, "ab", "{}"), (103, "ab", None), (104, "", "[]"), (105, "abc", json.dumps([good])), (None, "ab", "7")]
    second = good | {"text": "b c", "position": [1, 4]}
    rows += [(106, "ab cd", json.dumps([second, good, good]))]
    got = validation.entity_issues(spark.createDataFrame(rows, "doc_id long, text string, payload string"), ["D", "T"], ["D"], ["D"], ["neg"]).collect()
    codes = "bad_type out_of_bounds span_mismatch unknown_assertion bad_assertions bad_candidates no_candidates needless_assertions missing_field not_object not_object text_not_string bad_position bad_position".split()
    warn = {"needless_assertions", "short_embedded"}
    want = [(i, 0, "warning" if c in warn else "error", c) for i, c in enumerate(codes)] + [(15, 0, "error", "bad_assertions")]
    want += [(100, -1, "error", "no_input"), (101, -1, "error", "bad_json"), (102, -1, "error", "not_list"), (103, -1, "error", "bad_json"), (105, 0, "warning", "short_embedded"), (None, -1, "error", "not_list")]
    want += [(106, 0, "warning", "short_embedded"), (106, -1, "warning", "unsorted"), (106, -1, "warning", "duplicates"), (106, 2, "warning", "overlap"), (106, 0, "warning", "overlap")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_file_issues(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "doc_id long")
    got = lambda a, b: sorted(map(str, map(tuple, validation.file_issues(a, b).collect())))
    assert got(ids(1, 1, None), ids(1)) == []
    assert got(ids(1, 3), ids(1, 2)) == sorted(map(str, [(2, "error", "missing_output"), (3, "warning", "unexpected_output")]))
    assert got(ids(1), ids(1, 2)) == sorted(map(str, [(2, "error", "missing_output"), (None, "error", "file_count")]))


def test_substitution_moves_later_spans(spark):
    df = spark.createDataFrame([("ab cd ef", [(0, 2), (3, 5), (6, 8)])], "t string, xs array<struct<s:int,e:int>>")
    text, moved = datasets.substitute(F.col("t"), F.col("xs"), F.lit(2), F.lit("xyz"))
    r = df.select(text.alias("t"), moved.alias("m")).first()
    assert r["t"] == "ab xyz ef" and [tuple(x) for x in r["m"]] == [(0, 2), (3, 6), (7, 9)]


def test_sources_keep_line_ends(spark, tmp_path):
    from spanloom import sources

    (tmp_path / "7.txt").write_bytes("a\r\nốb".encode())
    (tmp_path / "x.txt").write_bytes(b"skipped")
    (tmp_path / "7.json").write_text('[{"text":"a","type":"T","position":[0,1],"assertions":[],"candidates":["1"]}]')
    (tmp_path / "8.json").write_text("oops")
    assert [tuple(r) for r in sources.corpus(spark, str(tmp_path)).collect()] == [(7, "a\r\nốb")]
    got = sources.labels(spark, str(tmp_path))
    assert got.filter("entities IS NULL").count() == 1
    assert [(r["doc_id"], r["start_pos"], r["candidates"]) for r in sources.mentions(got.filter("entities IS NOT NULL")).collect()] == [(7, 0, ["1"])]


def test_pipe_fields_pick_by_position(spark, tmp_path):
    from spanloom import sources

    line = "|".join(str(i) for i in range(16))
    (tmp_path / "a.rrf").write_text(line.replace("|11|", "|RXNORM|") + "\n" + line + "\nshort|line\n")
    assert [tuple(r) for r in sources.concept_atoms(spark, str(tmp_path / "a.rrf")).collect()] == [("0", "12", "14")]


def test_overlap_link_counts_tokens_beyond_a_thousand(spark):
    many = [f"w{i}" for i in range(1200)]
    queries = spark.createDataFrame([(1, ["h", *many])], "id int, tokens array<string>")
    products = spark.createDataFrame([("a", ["h", *many[:1000]]), ("b", ["h", *many])], "code string, tokens array<string>")
    assert [tuple(r) for r in linking.overlap_link(queries, products).collect()] == [(1, "b")]


def test_writers(spark, tmp_path):
    import zipfile

    from spanloom import sources

    records = spark.createDataFrame([(2, '[{"text":"ố"}]'), (1, "[]"), (3, None), (None, "[]")], "doc_id long, payload string")
    sources.write_documents(records, str(tmp_path / "out"))
    sources.write_documents(records, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["1.json", "2.json"]
    assert (tmp_path / "out" / "2.json").read_text(encoding="utf-8") == '[\n  {\n    "text": "ố"\n  }\n]'

    terms = spark.createDataFrame([("b", '1,"x"'), ("a", None), ("a b", "2")], "text string, code string")
    sources.write_sorted(terms, str(tmp_path / "v"), ["text"])
    assert [tuple(r) for r in sources.vocabulary(spark, str(tmp_path / "v"), "text code").orderBy("text").collect()] == [("a", None), ("a b", "2"), ("b", '1,"x"')]
    sources.write_records(terms, str(tmp_path / "l"))
    assert sources.records(spark, str(tmp_path / "l"), "text string, code string").count() == 3

    none = spark.createDataFrame([(1, "warning")], "doc_id long, level string")
    whole = records.filter("doc_id < 3")
    at = str(tmp_path / "o.zip")
    assert sources.package(whole, none, at) == 2
    with zipfile.ZipFile(at) as z:
        assert z.namelist() == ["output/1.json", "output/2.json"] and z.read("output/1.json") == b"[]"
    for bad in ((whole, none.withColumn("level", F.lit("error"))), (records, none), (whole.union(whole), none)):
        with pytest.raises(ValueError):
            sources.package(*bad, str(tmp_path / "p.zip"))
    assert not (tmp_path / "p.zip").exists()
