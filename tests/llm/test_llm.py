"""The operators of spanloom.llm against brute force, round trips and odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import gif, linededup, mixing, packing, quality, simhash, substring, tokenbits, tokens, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, line string, words int, u int"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


def corpus(seed=1, n=40):
    """Copies, near copies, repeats, nulls, empty and long texts, odd characters."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randrange(1, 6))) for _ in range(300)]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = say(60)
    texts = [None, "", " \t\n", "one", "Two words", "a " * 3000, "ha " * 50, " x   y", passage]
    for _ in range(n):
        t = "\n".join(say(r.randrange(1, 40)) for _ in range(r.randrange(1, 6)))
        texts.append(t)
        if r.random() < 0.3:
            texts.append(t)
        if r.random() < 0.3:
            texts.append(t + " more")
        if r.random() < 0.3:
            texts.append(say(5) + "\n" + passage + "\n" + say(5))
    return [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "k", "l", i, 0) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup_against_brute_force(docs, rows, none):
    seen, want = set(), {}
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            c = tuple(w[k : k + 20])
            if c in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(c)
        want[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    for hot in (substring.HOT_ANCHOR, 1):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.substring_dedup(docs, hot).collect()}
        assert got == want
    assert substring.substring_dedup(none).count() == 0


def test_suffix_automaton_finds_first_ends():
    r = random.Random(4)
    for _ in range(50):
        s = [r.randrange(3) for _ in range(60)]
        a = substring.SuffixAutomaton()
        for i, t in enumerate(s):
            a.add(t, i)
        q = [r.randrange(3) for _ in range(30)]
        ends = [next((e for e in range(3, 60) if s[e - 3 : e + 1] == q[i : i + 4]), -1) for i in range(27)]
        assert a.first_ends(q, 4) == ends


def test_mixing_meets_targets_and_bounds(spark, docs, none):
    sized = docs.select("doc_id", "source", mixing.text_size(docs["text"]).alias("size")).fillna({"size": 0})
    got = mixing.mix_sources(sized).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in got)
    weights = dict(zip(sorted((s for s in by if s is not None)) + [None], [5, 2, 1] * 9, strict=False))
    target, capped = {}, set()
    while True:
        left = total - sum(3 * sum(r["size"] for r in by[s]) for s in capped)
        free = sum(weights[s] for s in by if s not in capped)
        target = {s: 3.0 * sum(r["size"] for r in by[s]) if s in capped else left * weights[s] / free for s in by}
        over = {s for s in by if target[s] > 3 * sum(r["size"] for r in by[s]) + 1e-9}
        if not over:
            break
        capped |= over
    for s, own in by.items():
        assert own[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["copies"] * r["size"] for r in own) - target[s]) <= max(r["size"] for r in own)
    again = mixing.mix_sources(sized.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_documents(none).count() == 0


def test_mixing_tree_keeps_words(spark):
    r = random.Random(5)
    data = [(i, "a", r.randrange(1, 50), 0.37) for i in range(3000)]
    out = mixing.pivotal_rounding(spark.createDataFrame(data, "key long, source string, size long, p double"), bucket=16).collect()
    assert len(out) == 3000 and {x["p"] for x in out} == {0.0, 1.0}
    assert abs(sum(x["p"] * x["size"] for x in out) - sum(0.37 * d[2] for d in data)) <= 25
    share = sum(x["p"] for x in out) / 3000
    assert 0.33 < share < 0.41


def test_mix_documents_repeats_rows(docs):
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    assert got.groupBy("doc_id").count().filter("count > 3").count() == 0


def test_warc_round_trip(spark):
    page = "x" * 100
    data = [(1, "http://b.org/a", page), (2, "http://a.org", page), (2, "http://a.org", page), (None, None, None), (5, "http://[bad", "y"), (4, "w", "y"), (9, "http://www.B.org/a?Q#f", "é" * 50)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", warc.F.lit("clash"))
    got = warc.read_records(warc.materialize(warc.merged_index(warc.write_archives(df)), "index")).orderBy("history_order").collect()
    assert [r["history_order"] for r in got] == list(range(7))
    assert [(r["url_key"], r["captured"]) for r in got] == sorted((r["url_key"], r["captured"]) for r in got)
    kinds = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got}
    assert kinds == {(1, "response", None, 100), (2, "revisit", 1, 100), (None, "response", None, 0), (5, "response", None, 1), (4, "response", None, 1), (9, "response", None, 100)}
    assert warc.read_records(warc.merged_index(warc.write_archives(df.limit(0)))).count() == 0


def test_loser_tree_merges():
    r = random.Random(6)
    for k in range(9):
        runs = [sorted(r.randrange(50) for _ in range(r.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for y in runs for x in y)


def test_toxicity_learns_and_generalises():
    r = random.Random(7)
    plain = ["".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 8))) for _ in range(400)]
    bad = ["horrid", "stupid", "vermin"]

    def make(toxic, own):
        w = [r.choice(plain) for _ in range(r.randrange(30, 200))]
        for _ in range(3 * toxic):
            w[r.randrange(len(w))] = r.choice(own)
        return " ".join(w)

    labels = [i % 2 for i in range(200)]
    model = toxicity.fit([make(y, bad) for y in labels], labels)
    margins = toxicity.WordMargins(model.margins())
    call = lambda t: model.slope * toxicity.most_toxic(np.array([margins[w] for w in toxicity.words_of(t)]))[0] + model.shift >= 0
    assert np.mean([call(make(y, bad)) == bool(y) for y in labels]) > 0.9
    assert np.mean([call(make(1, ["horridd", "stupidd", "verminn"])) for _ in range(50)]) > 0.7  # never seen


def test_toxicity_scores_odd_inputs(spark, docs, none):
    model = toxicity.fit([], [])
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {1 / (1 + np.exp(30.0))}
    assert toxicity.score(none, model).count() == 0
    assert toxicity.fit(["a b"], [1]).shift > 0


def test_line_dedup_against_all_pairs(docs, rows, none):
    lines, want = [], {}
    for i, t, *_ in rows:
        for k, line in enumerate((t or "").split("\n")):
            if w := words(line):
                s = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])
                lines.append((i, k, line, s))
    for i, k, line, s in lines:
        before = {b: (a, c) for a, c, b, z in lines if (a, c) < (i, k) and (b == line or 5 * len(s & z) >= 4 * len(s | z))}
        if before:
            want.setdefault(i, set()).add(k)
    got = {r["doc_id"]: set(r["__gone"]) for r in linededup._with_removals(docs).collect() if r["__gone"]}
    assert got == want
    kept = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    for i, t, *_ in rows:
        assert kept[i] == (t if i not in want else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]))
    assert linededup.dedup_lines(docs).columns == docs.columns
    assert linededup.dedup_lines(none).count() == 0


def test_line_dedup_filters_hold_back_more_than_their_slots_tell(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SLOTS", 16)
    rows = spark.range(5000).select(F.xxhash64("id").alias("t"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    wanted = rows.filter("a < 100")
    for c in ("t", ("a", "b")):
        got = {r["a"] for r in linededup._in_slots(rows, wanted, c).collect()}
        assert set(range(100)) <= got and len(got) < 1000  # by slots alone, all go on


def test_line_dedup_of_lines_with_long_prefixes(spark):
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(words), " ".join([*words[:450], "x", *words[451:]]), " ".join(f"v{i}" for i in range(900)), " ".join([*words[:400], *(f"y{i}" for i in range(500))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()} == {0: texts[0], 1: "", 2: texts[2], 3: texts[3]}


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    data = [(None, "one a\ntwo b\nthree c\ntwo b"), (None, "four d\nfive e\nsix f\nseven g"), (3, "u v\nw x\nw x"), (3, "y z\na a\nb b"), (3, "y z\na a\nb b"), (4, "five e\nnew n")]
    got = linededup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    want = [(None, "one a\ntwo b\nthree c"), (None, "four d\nfive e\nsix f\nseven g"), (3, "u v\nw x"), (3, "y z\na a\nb b"), (3, "y z\na a\nb b"), (4, "new n")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    shared = spark.createDataFrame([(None, "p q\nsame s"), (None, "same s\nr t")], "doc_id long, text string")
    texts = [r["text"] for r in linededup.dedup_lines(shared).collect()]
    assert sorted("\n".join(texts).split("\n")) == ["p q", "r t", "same s"]


@pytest.mark.parametrize("size", [0, 1, 10, 3836, 3837, 3838, 3839, 8192, 8193, 70000])
def test_lzw_round_trip(size):
    r = random.Random(size)
    for data in (bytes(r.randrange(256) for _ in range(size)), bytes(r.randrange(2) for _ in range(size)), b"\0" * size):
        assert gif.lzw_decode(gif.lzw_encode(data), 8, size) == data


def test_gif_payloads(docs, rows):
    stored = gif.store_media(docs)
    got = {r["doc_id"]: r for r in gif.media_columns(stored).collect()}
    media = {r["doc_id"]: bytes(r["media"]) for r in stored.collect()}
    shown = {}
    for r in gif.media_frames(stored).collect():
        shown.setdefault(r["doc_id"], []).append(r)
    for i, t, *_ in rows:
        raw = (t or "").encode()
        padded = raw + bytes(64 - len(raw) if len(raw) < 64 else -len(raw) % 64)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media[i]), hashlib.sha256(media[i]).hexdigest())
        bins = [0] * gif.BINS
        for x in padded:
            bins[(299 * x + 587 * x + 114 * x) // 1000 * gif.BINS // 256] += 1
        assert r["feature"] == ",".join(map(str, bins))
        own = sorted(shown[i], key=lambda f: f["frame"])
        assert len(own) == r["n_frames"] == -(-len(padded) // (64 * 1024)) and [f["at_ms"] for f in own] == [40 * k for k in range(len(own))]
        assert [sum(f["histogram"][b] for f in own) for b in range(gif.BINS)] == bins and sum(f["height"] for f in own) == len(padded) // 64
        assert own[0]["canvas_histogram"] == own[0]["histogram"]


def test_gif_disposal_and_transparency():
    head = b"GIF89a" + bytes([2, 0, 1, 0, 0x80, 0, 0]) + bytes([0, 0, 0, 255, 255, 255])

    def frame(pixels, disposal, clear):
        flags = disposal << 2 | (clear is not None)
        codes = [4, *pixels, 5]  # least code size 2: clear 4, end 5
        bits = "".join(f"{c:03b}"[::-1] for c in codes)
        data = bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))
        return bytes([0x21, 0xF9, 4, flags, 7, 0, clear or 0, 0, 0x2C, 0, 0, 0, 0, 2, 0, 1, 0, 0, 2, len(data)]) + data + b"\0"

    data = head + frame([1, 1], 1, None) + frame([0, 1], 3, 1) + frame([0, 1], 2, 0) + frame([1, 1], 0, 1) + b"\x3b"
    w, h, _, own = gif.frames(data)
    seen = [c[0, :, :].tolist() for c in gif.canvases(w, h, own)]
    black, white, empty = [0, 0, 0, 255], [255, 255, 255, 255], [0, 0, 0, 0]
    assert seen == [[white, white], [black, white], [white, white], [empty, empty]]
    assert [f["delay_ms"] for f in gif.frame_rows(data)] == [70] * 4


@pytest.mark.parametrize("bits", [1, 3, 8, 15, 16, 17, 31, 32])
def test_bit_packing_and_random_access(bits):
    import io

    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_000, dtype=np.uint64).astype(np.uint32)
    assert (tokenbits.unpack_bits(tokenbits.pack_bits(ids, bits), bits, len(ids)) == ids).all()
    f = tokenbits.BitFile(io.BytesIO(tokenbits.write_file([5, None], [ids[:7000], ids[7000:]], bits)))
    assert f.doc_ids == [5, None] and f.sizes.tolist() == [7000, 3000]
    assert (f.ids(4090, 20) == ids[4090:4110]).all() and (f.ids(0, 10_000) == ids).all() and len(f.ids(3, 0)) == 0


@pytest.mark.parametrize(("file", "cut"), [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")])
def test_token_memory_equals_the_library(rows, file, cut):
    import public_tokenizers
    from tokenizers import Tokenizer

    r = random.Random(8)
    letters = "aAbéÉßİıŉǅÅñ .,'s!?\n\t0١ﬁ字Σς́ -_#\x1c\x85  "
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|ENDOFTEXT|>y <|startoftext|>"] + [t or "" for _, t, *_ in rows] + ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(1500)]
    library = Tokenizer.from_file(public_tokenizers.path(file))
    want = [e.ids + [9] for e in library.encode_batch(texts, add_special_tokens=False)]
    own = tokens.TokenMemory(public_tokenizers.path(file), cut)
    assert [x.tolist() for x in own.encode(texts, 9)] == want
    own._keep_used()
    assert [x.tolist() for x in own.encode(texts, 9)] == want


def test_token_files(docs, rows, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = tokenbits.read_tokens(tokenbits.write_tokens(docs, tokenbits.byte_tokenizer(), "spaces", tokenbits.BYTE_VOCABULARY, 0)).orderBy("doc_id").collect()
    at = 0
    for r, (i, t, *_) in zip(got, rows, strict=True):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert tuple(r) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tokenbits.read_tokens(tokenbits.write_tokens(none, tokenbits.byte_tokenizer(), "spaces", tokenbits.BYTE_VOCABULARY, 0)).count() == 0


def test_simhash_against_all_pairs(docs, rows, none):
    import xxhash

    def brute(t):
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(t)]
        s = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: brute(t) for i, t, *_ in rows}
    top = {i: i for i in fp}
    for _ in fp:
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 3:
                    top[a] = top[b] = min(top[a], top[b])
        if all(top[top[i]] == top[i] for i in top):
            break
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (fp[i], top[i]) for i in fp}
    kept = simhash.keep_first(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(top.values())) and kept.columns == docs.columns
    assert simhash.near_duplicates(none).count() == 0


def test_near_dedup_keeps_one_of_each_component_whatever_its_ids(spark):
    r = random.Random(14)
    a, b, c, d = (" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)) for _ in range(4))
    data = [(None, a, 1), (None, a, 2), (None, b, 3), (7, b, 4), (5, c, 5), (5, d, 6), (9, c, 7), (9, d, 8)]
    assert all((simhash.fingerprint(x) ^ simhash.fingerprint(y)).bit_count() > 3 for x in (a, b, c, d) for y in (a, b, c, d) if x != y)
    docs = spark.createDataFrame(data, "doc_id long, text string, n int")
    got = simhash.keep_first(docs)
    kept = [(x["doc_id"], x["text"]) for x in got.collect()]
    assert sorted(kept, key=str) == sorted([(None, a), (7, b), (5, c), (5, d)], key=str) and got.columns == docs.columns
    near = {(x["doc_id"], x["fp"]): x["component_id"] for x in simhash.near_duplicates(docs).collect()}
    own = {t: simhash._signed(simhash.fingerprint(t)) for t in (a, b, c, d)}
    assert near == {(None, own[a]): None, (None, own[b]): 7, (7, own[b]): 7, (5, own[c]): 5, (5, own[d]): 5, (9, own[c]): 5, (9, own[d]): 5}


def test_bk_tree_and_crowded_shards(spark):
    r = random.Random(9)
    values = sorted({base ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for base in (r.getrandbits(64) for _ in range(20)) for _ in range(15)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert sorted(tree.values[k] for k in tree.within(v, 3)) == [x for x in values if (x ^ v).bit_count() <= 3]
    nodes = spark.createDataFrame([(simhash._signed(v), i) for i, v in enumerate(values)], "fp long, node long")
    top = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for a in range(len(values)):
            for b in range(a):
                if (values[a] ^ values[b]).bit_count() <= 3 and top[a] != top[b]:
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    want = {i: t for i, t in enumerate(top) if top.count(t) > 1}
    for hot in (2, 4096):
        got = {x["node"]: x["component"] for x in simhash.components(simhash.fingerprint_links(nodes, hot)).collect()}
        assert {**{t: t for t in want.values()}, **got} == want


def test_shard_masks_miss_nothing():
    r = random.Random(10)
    for n in (10, 1 << 30, 1 << 36):
        masks = simhash.shard_masks(n)
        for _ in range(200):
            v = r.getrandbits(64)
            w = v ^ sum(1 << b for b in r.sample(range(64), 3))
            hit = [m for m in masks if v & m == w & m]
            assert hit and any(v & f == w & f for f in simhash.finer_masks(hit[0]))


BIG = 1 << 60


def test_ids_beyond_floating_point_null_and_repeated(spark):
    """Every operator gives each row its own id back, exactly."""
    r = random.Random(15)
    say = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    page, other = say(60), say(80)
    data = [(BIG + 1, page, "s"), (BIG + 3, page, "s"), (None, other, "s"), (None, None, None), (7, "", "t"), (7, other + " x", "t"), (7, other + " x", "t"), (BIG + 5, say(70), None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(2)
    ids = sorted((i for i, *_ in data), key=str)
    of = lambda df, c="doc_id": sorted((x[c] for x in df.select(c).collect()), key=str)
    assert of(substring.substring_dedup(docs)) == ids
    gone = {x["doc_id"]: x["n_removed"] for x in substring.substring_dedup(docs).collect() if x["doc_id"] and x["doc_id"] > 7}
    assert gone == {BIG + 1: 0, BIG + 3: 60, BIG + 5: 0}
    sized = docs.select("doc_id", "source", mixing.text_size(mixing.full_text()).alias("size"))
    assert of(mixing.mix_sources(sized), "key") == ids
    assert of(toxicity.score(docs, toxicity.fit([], []))) == ids
    assert of(linededup._with_removals(docs)) == ids and of(linededup.dedup_lines(docs)) == ids
    assert of(gif.media_columns(gif.store_media(docs))) == ids
    assert of(tokenbits.read_tokens(tokenbits.write_tokens(docs, tokenbits.byte_tokenizer(), "spaces", tokenbits.BYTE_VOCABULARY, 0))) == ids
    near = {(x["doc_id"], x["component_id"]) for x in simhash.near_duplicates(docs).collect()}
    assert of(simhash.near_duplicates(docs)) == ids and (BIG + 3, BIG + 1) in near and (BIG + 5, BIG + 5) in near
    assert of(simhash.keep_first(docs)) == sorted([BIG + 1, 7, 7, BIG + 5], key=str)  # an id may stand in two components
    pieces = packing.pack_documents(docs, packing.word_tokenizer())
    assert of(pieces.filter("start = 0")) == ids
    assert of(quality.quality_scores(docs)) == ids
    pages = spark.createDataFrame([(BIG + 1, "u", "h" * 200), (BIG + 3, "v", "h" * 200), (None, "w", "h" * 200)], "page_id long, url string, html string")
    read = {(x["page_id"], x["refers_to"]) for x in warc.read_records(warc.merged_index(warc.write_archives(pages))).collect()}
    assert {(BIG + 1, None), (BIG + 3, BIG + 1)} <= read and {i for i, _ in read} == {BIG + 1, BIG + 3, None}


def test_operators_take_an_empty_table(spark, none):
    assert gif.media_columns(gif.store_media(none)).count() == 0 and gif.media_frames(gif.store_media(none)).count() == 0
    assert mixing.mix_sources(none.select("doc_id", "source", mixing.text_size(none["text"]).alias("size"))).count() == 0


def test_toxicity_query_reads_labels_of_its_fold_only(spark, tmp_path):
    r = random.Random(16)
    say = lambda bad: " ".join(r.choice("alpha beta gamma delta omega kappa".split()) for _ in range(40)) + " vermin" * bad
    docs = [(i, say(i % 2)) for i in range(300)]
    held = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = [(i, i % 2 if i not in held else 1 - i % 2) for i in range(300)]  # wrong ones where they mustn't be read
    labels += [(0, 0), (1, 0), (1, 1)]  # a conflict counts as toxic
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = toxicity.training_rows(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert sorted(rows) == sorted((t, i % 2) for i, t in docs if i not in held)
    for x in toxicity.op4_toxicity(spark, str(tmp_path)).collect():
        assert x["held_out"] == (x["doc_id"] in held) and x["predicted"] == (x["score"] >= 0.5) == x["doc_id"] % 2


def test_packing(docs, rows, none):
    got = [r.asDict() for r in packing.pack_documents(docs, packing.word_tokenizer(), with_ids=True).collect()]
    by_doc, by_window = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_doc) == [i for i, *_ in rows]
    for own in by_doc.values():
        own.sort(key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"] and own[-1]["ids"][-1] == 1
    for own in by_window.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1]) and sum(r["length"] for r in own) <= 2048
        assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in own)
    assert packing.pack_documents(none, packing.word_tokenizer()).count() == 0


def test_differencing_balances():
    r = random.Random(11)
    sizes = [r.randrange(1, 1024) for _ in range(400)]
    groups = packing.balanced(sizes)
    assert sorted(k for g in groups for k in g) == list(range(400))
    assert max(sum(sizes[k] for k in g) for g in groups) <= 2048
    assert len(groups) <= -(-sum(sizes) // 2048) * 1.03 + 1


def test_quality_counts_against_brute_force(docs, rows, none):
    got = {r["doc_id"]: r for r in quality.quality_scores(docs).collect()}
    for i, t, *_ in rows:
        w = words(t)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.keep_quality(docs).columns == docs.columns
    assert quality.keep_quality(none).count() == 0


def test_weak_supervision_recovers_accuracies():
    r = random.Random(12)
    true, counts = [0.95, 0.85, 0.75, 0.65], {}
    for _ in range(20_000):
        y = r.random() < 0.7
        v = tuple(None if r.random() < 0.2 else int(y if r.random() < a else not y) for a in true)
        counts[v] = counts.get(v, 0) + 1
    good, accuracy = quality.fit_votes(sorted(counts.items(), key=str))
    assert good == pytest.approx(0.7, abs=0.05)
    assert accuracy == pytest.approx(true, abs=0.05)


def test_quality_stage_rejects_symbol_junk(spark):
    r = random.Random(13)
    say = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 8))) for _ in range(k))
    clean = [say(150) for _ in range(220)]
    symbols = [" ".join(w + (" #*" if i % 3 == 0 else "") for i, w in enumerate(say(150).split())) for _ in range(18)]
    repeats = ["\n".join([say(40)] * 4) for _ in range(12)]
    short = [say(20) for _ in range(10)]
    data = list(enumerate(clean + symbols + repeats + short))
    kept = {x["doc_id"] for x in quality.keep_quality(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert kept == set(range(len(clean)))


def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline

    names = []
    for start in (docs, none):
        got = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = quality.materialize(stage(spark, got, ""), name)
            assert got.columns == docs.columns
            names.append(name)
        corpus_pipeline.STAGES[-1][1](spark, got, "").count()
    assert len(names) == 8
