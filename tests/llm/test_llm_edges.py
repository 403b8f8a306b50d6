"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from oreflow.llm import bpe, chats, licenses, mixing, passages, pii, quality, shingles, simhash, urls, vectors
from oreflow.llm.automaton import SuffixAutomaton
from oreflow.llm.crf import shapes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"w{i}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
DOCS = [
    (1, f"one {PASSAGE} end", "a", "en"),
    (2, f"two {PASSAGE} other", "a", "en"),
    (2, f"two {PASSAGE} other", "a", "en"),
    (3, None, None, None),
    (4, "", "b", None),
    (5, LONG, "b", "x"),
    (6, " \t\n\x0b\x0c\r ", "a", "x"),
    (None, f"no id {PASSAGE}", "a", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns that the operators use inside, or return, must not disturb them.
    extra = [(*d, 7, 7, 7, "k", 7) for d in DOCS]
    return spark.createDataFrame(
        extra, "doc_id bigint, text string, source string, lang string, n_words int, size int, fp int, kept string, target int"
    )


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_quality(spark, docs):
    got = quality.quality_rules(docs).collect()
    assert len(got) == len(DOCS)
    r = by_id(got)
    assert r[3]["n_words"] == r[4]["n_words"] == r[6]["n_words"] == 0 and r[3]["base_failed"] and not r[3]["kept"]
    assert r[5]["n_words"] == 60_000 and r[5]["n_repeat_words"] == 0
    twice = spark.createDataFrame([(1, "a b c d e f a b c d e f x")], "doc_id bigint, text string")
    assert quality.quality_rules(twice).first()["n_repeat_words"] == 12
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_passages(spark, docs):
    got = passages.remove_repeats(docs).collect()
    assert len(got) == len(DOCS)
    r = by_id(got)
    assert r[1]["n_removed"] == 0 and r[5]["n_removed"] == 0 and r[None]["n_removed"] == 0
    assert all(x["n_removed"] == 60 and x["kept"] == "two other" for x in got if x["doc_id"] == 2)
    assert (r[3]["n_words"], r[3]["kept"]) == (0, "")
    assert passages.remove_repeats(docs.limit(0)).count() == 0


def test_passages_against_brute_force_with_hot_shards(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    seen: dict = {}
    want = {}
    for i, text in rows:
        ws, gone = text.split(), set()
        for k in range(len(ws) - 12):
            if seen.setdefault(tuple(ws[k : k + 13]), i) < i:
                gone |= set(range(k, k + 13))
        want[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    for hot in (passages.HOT_RUNS, 3):
        monkeypatch.setattr(passages, "HOT_RUNS", hot)
        got = passages.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == want


def test_passages_repeated_inside_one_document(spark, monkeypatch):
    rng = random.Random(7)
    line = " ".join(f"l{i}" for i in range(15))
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(13, 18))) for _ in range(12)]
    rows = [(1, f"x y {line} z"), (2, " ".join([line] * 6)), (2, " ".join([line] * 6))]
    for i in range(3, 60):
        parts = [rng.choice(lines) for _ in range(rng.randint(1, 3))]
        rows.append((i, " ".join(f"{p} {rng.choice('xyz')}" if rng.random() < 0.5 else p for p in parts * rng.randint(1, 4))))
    seen: dict = {}
    want = []
    for i, text in rows:
        ws, gone = text.split(), set()
        for k in range(len(ws) - 12):
            if seen.setdefault(tuple(ws[k : k + 13]), i) < i:
                gone |= set(range(k, k + 13))
        want.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    assert want[1][2] == 90
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for hot, size in ((passages.HOT_RUNS, batch), (3, "3")):
            monkeypatch.setattr(passages, "HOT_RUNS", hot)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = passages.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
            assert sorted(map(tuple, got)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_automaton_matches_brute_force():
    rng = random.Random(2)
    automaton, texts = SuffixAutomaton(), []
    for label in range(60):
        text = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        want = []
        for k in range(len(text) - 4):
            piece = text[k : k + 5]
            want.append(next((n for n, t in enumerate(texts) if any(t[j : j + 5] == piece for j in range(len(t)))), None))
        assert automaton.first_seen(text, 5) == want
        automaton.insert(text, label)
        texts.append(text)


def test_urls(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/e")]
    cases = [
        ("http://A.example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("x://a.net/english", "a.net", "/english", "net/e", "block"),
        ("x://a.net?e/en/", "a.net", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "old") for i, c in enumerate(cases)], "page_id int, url string, rule string")
    got = urls.filter_urls(df, rules).orderBy("page_id").select("url", "host", "path", "rule", "verdict").collect()
    assert [tuple(r) for r in got] == cases
    assert urls.filter_urls(df.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        urls.build_trie([("allow", "nopath")])


def test_bpe(spark, docs):
    got = bpe.tokenize(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(DOCS)
    for r in got:
        text = next(d[1] for d in DOCS if d[0] == r["doc_id"]) or ""
        assert r["decoded"] == text and bool(r["ids"]) == bool(text)
    assert bpe.tokenize(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_survives_small_caches_and_long_words(spark, monkeypatch):
    texts = ["ab cd ef " * 9, "x" * 3_000, " " * 2_000 + "z", "ab cd", "日本語🙂" * 90, "ab cd ef gh ij"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    want = {r["doc_id"]: list(r["ids"]) for r in bpe.tokenize(df, PATH, public_tokenizers.PATTERN).collect()}
    v = bpe.Vocabulary(PATH)
    merges = v.merges()
    split = bpe.regex.compile(public_tokenizers.PATTERN).findall
    for i, t in enumerate(texts):
        assert want[i] == [x for w in split(t) for x in bpe.merge_long(w.encode(), v.bytes, merges)]
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    again = {r["doc_id"]: list(r["ids"]) for r in bpe.tokenize(df, PATH, public_tokenizers.PATTERN).collect()}
    assert again == want


def test_first_cells_of_words():
    """Each byte with its place, its id and the rank of its merge with the next; words have a cell more at both ends."""
    merges = {10 << 17 | 11: 300}
    id_of = np.arange(256) + 10
    cells = bpe.first_cells(np.array([0, 1, 1], np.uint8), np.array([2, 1]), id_of, bpe.byte_pairs(id_of.tolist(), merges))
    none = bpe.NO_RANK << 25
    end = none | bpe.OUTSIDE
    assert cells.tolist() == [end, 300 << 25 | 10, none | 1 << 17 | 11, end, end, none | 11, end]
    assert not len(bpe.first_cells(np.zeros(0, np.uint8), np.zeros(0, np.int64), id_of, np.zeros(65_536, np.int64)))


def test_bpe_plan_stays_short(spark, docs):
    """The driver keeps descriptions of plans; the rank map is in none of them, and no step copies it per row."""
    made = bpe.tokenize(docs, PATH, public_tokenizers.PATTERN)
    plan = made._jdf.queryExecution().toString()
    assert len(plan) < 100_000
    assert len(re.findall(r"Project \[doc_id#\d+L, codes", plan.split("== Physical Plan ==")[1])) == 1


def test_groups_are_found_anew_only_after_links(spark, monkeypatch):
    """A round whose pairs are no links leaves the groups as they are."""
    shared = " ".join(f"s{j}" for j in range(24))
    texts = spark.createDataFrame([(i, f"{shared} " + " ".join(f"w{i}x{j}" for j in range(10))) for i in range(9)], "name bigint, text string")
    printed = shingles.prints(texts)
    sizes, met, components = [], [], shingles.components

    def counted(links):
        sizes.append(links.count())
        return components(links)

    def everything(pairs, printed):  # as if all sketches looked alike
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(shingles, "components", counted)
    monkeypatch.setattr(shingles, "alike", everything)
    assert shingles.connected(printed, texts).count() == 0
    assert any(met[1:]) and len(sizes) == 2  # operator 8's groups, and the first links


def test_vectors(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal(64)
    near = a + 0.02 * rng.standard_normal(64)
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, a.tolist()), (3, (2 * near).tolist()), (9, a.tolist()), (7, (-a).tolist()), (8, None), (10, []),
        (11, [0.0] * 64), (12, [nan] + [1.0] * 63), (13, [None] + [1.0] * 63), (14, [inf] * 64), (15, [1.0, 1.0]),
        (16, [2.0, 2.0]), (None, a.tolist()),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1)).withColumn("cid", F.lit(1))
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_vectors(df).collect()}
    assert got[5] == got[9] == (3, 3, False) and got[3] == (3, 3, True) and got[None] == (3, 3, False)
    assert all(got[i] == (0, i, True) for i in (7, 8, 10, 11, 12, 13, 14))
    assert got[15] == (1, 15, True) and got[16] == (1, 15, False)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vector_filters_reach_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1_500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    code = vectors.Code(64, 100_000)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert np.mean(met) > 0.99
    apart = [sum(int(w).bit_count() for w in s.view(np.uint64)) for s in code.sketch(x) ^ code.sketch(y)]
    assert max(apart) <= vectors.sketch_limit(0.95)


def test_chats(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "<|im_start|", "<", "", None, "a\nb<|im_end|>\n", "<r\\r"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, None, "x"), (2, 0, "us\ner<|r", "y"), (2, 0, "us\ner<|r", "y"), (None, None, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("source", F.lit(1))
    got = {r["conv_id"]: r for r in chats.format_chats(df).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [(r[2], r[3] or "") for r in rows if r[0] == 1]
    assert [tuple(t) for t in got[2]["turns"]] == [("", "x"), ("us\ner<|r", "y"), ("us\ner<|r", "y")]
    assert got[None]["formatted"] == "<|im_start|>assistant\nz<|im_end|>\n"
    for r in got.values():
        assert sum(m["chars"] for m in r["mask"]) == len(r["formatted"])
        at, loss = 0, []
        for m in r["mask"]:
            loss += [r["formatted"][at : at + m["chars"]]] if m["loss"] else []
            at += m["chars"]
        plain = [re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in loss]
        assert plain == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
    assert chats.format_chats(df.limit(0)).count() == 0


def test_mix(spark, docs):
    got = mixing.mix_plan(docs).collect()
    assert len(got) == len(DOCS) and all(r["taken"] <= 3 * r["size"] for r in got)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(r"\S+", r["text"] or "")) for r in mixed.collect()) == sum(r["taken"] for r in got)
    assert mixing.mix_plan(docs.limit(0)).count() == 0 and mixing.mix_documents(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "s", "a b c")] * 500 + [(2, "t", "a b")] * 4, "doc_id bigint, source string, text string")
    taken = mixing.mix_plan(same).groupBy("doc_id").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(abs(r["n"] - r["t"]) <= 3 for r in taken)


def test_simhash(spark, docs):
    got = simhash.group_near_copies(docs).collect()
    assert len(got) == len(DOCS)
    r = by_id(got)
    assert r[3]["fp"] == r[4]["fp"] == r[6]["fp"] == 0 and r[6]["component_id"] == 3
    kept = simhash.keep_one(docs.drop("fp")).collect()
    assert sorted(x["doc_id"] or 0 for x in kept if x["doc_id"] not in (1, 2)) == [0, 3, 5]
    assert sum(x["doc_id"] == 2 for x in kept) <= 1
    assert simhash.group_near_copies(docs.limit(0)).count() == 0


def test_simhash_pairs_match_brute_force(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for n in (1, 2, 4, 5):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), n)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = simhash.similar_pairs(spark.createDataFrame(signed, "fp bigint")).collect()
    want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_near_copies_keep_every_distinct_text(spark, docs):
    def kept(rows, schema="doc_id bigint, text string"):
        return sorted(map(tuple, shingles.keep_one(spark.createDataFrame(rows, schema).repartition(3)).collect()), key=repr)

    a, b = "alpha " + PASSAGE, "beta two three four five six seven"
    # One id with two texts keeps both; the copy of the second under another id goes.
    assert kept([(1, a), (1, b), (2, b)]) == [(1, a), (1, b)]
    assert kept([(None, a), (None, b), (3, b), (None, a)]) == sorted([(None, a), (3, b)], key=repr)
    assert kept([(9, None), (8, ""), (7, " \t\n"), (7, "x")]) == [(7, " \t\n"), (7, "x")]
    assert kept([(5, LONG), (4, LONG + " end"), (6, LONG.upper())]) == [(4, LONG + " end")]
    # Equal rows but for other columns, with names that the operator uses: the first by these.
    schema = "doc_id bigint, text string, key int, name string, `_nth` int, `_head` string"
    assert kept([(1, a, 2, "y", 1, "h"), (1, a, 1, "z", 1, "h"), (1, a, 1, "z", 1, "h")], schema) == [(1, a, 1, "z", 1, "h")]
    assert shingles.keep_one(docs.limit(0)).count() == 0
    assert len(shingles.keep_one(docs).collect()) == 3 and shingles.keep_one(docs).columns == docs.columns


def test_sketches_do_not_lose_linked_texts():
    """Pairs at a similarity of just 0.8 look alike in far more bytes than the limit asks."""
    rng = np.random.default_rng(3)
    for n in (9, 90, 900, 9_000):
        whole = rng.integers(-(2**63), 2**63, n, np.int64)
        one, two = whole[n // 9 :], whole[: n - n // 9]
        alike = sum(x == y for x, y in zip(*(np.array(shingles.sketch(np.sort(s))).view(np.uint8) for s in (one, two)), strict=True))
        assert alike >= shingles.LEAST_ALIKE + 6
    far = [np.array(shingles.sketch(rng.integers(-(2**63), 2**63, 500, np.int64))).view(np.uint8) for _ in range(2)]
    assert sum(far[0] == far[1]) < 8


def test_licenses(spark, docs):
    assert len(licenses.scan_licenses(docs).collect()) == len(DOCS)
    # Texts that share an id, or have none, are documents of their own; repeated rows come back.
    shared = [(i, t) for i in (7, None) for t in ("the general x x", "q general public", "z z public license", "z z public license")]
    shared += [(None, "mit license"), (7, "a mit license")]
    found = licenses.scan_licenses(spark.createDataFrame(shared, "doc_id bigint, text string").repartition(3)).collect()
    assert len(found) == len(shared)
    assert sorted((r["doc_id"] or 0, r["n_base"], r["first_word"]) for r in found if r["n_base"]) == [(0, 1, 0), (7, 1, 1)]
    long = " ".join(f"word{i} of{i % 7}" for i in range(100))
    text = "x y " + long.replace("word50 ", "other ") + " z"
    [row] = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), [("long", long, False)]).collect()
    assert row["labels"] == "long" and 0.98 < row["score"] < 1
    rows = [
        (1, "Released under the MIT\nLicense. mit-license"),
        (2, "licensed under the new Apache License, version 2.0"),
        (3, "mit LICENSED general public license general public license"),
        (4, "mit élicense the mit liKense"),
        (5, "redistribution and use in the source and binary forms with or without modification are permitted"),
    ]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert tuple(got[1])[1:] == (7, 2, 3, 5, "mit", "mit", 1.0)
    assert (got[2]["n_base"], got[2]["labels"]) == (1, "apache")
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"], got[3]["labels"]) == (2, 2, 5, "gpl")
    assert (got[4]["n_base"], got[4]["labels"], got[4]["first_word"]) == (0, "", None)
    assert (got[5]["base_labels"], got[5]["labels"]) == ("", "bsd") and 0.8 <= got[5]["score"] < 1
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_pii(spark, docs):
    rows = [(1, "a.b@c.d.e, +1 (389) 555-5010 or (389) 555-5010."), (2, None), (3, ""), (4, "1" * 20_000 + "@" * 5_000), (5, "x" * 50_000 + "@a.b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii", F.lit(1))
    got = by_id(pii.find_pii(df).collect())
    assert [tuple(s)[:3] for s in got[1]["pii"] if s["base"]] == [("email", 0, 9), ("phone", 11, 28)]
    assert [tuple(s) for s in got[1]["pii"] if not s["base"]] == [("phone", 32, 46, False)]
    assert not got[2]["pii"] and not got[3]["pii"] and not got[4]["pii"] and len(got[5]["pii"]) == 1
    text = by_id(pii.redact_pii(df).collect())
    assert text[1]["text"] == "[EMAIL], [PHONE] or [PHONE]." and text[2]["text"] is None
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_random_field_on_held_out_rows():
    model, right, total = pii.trained(), 0, 0
    for text, spans in pii.labelled_rows(200, seed=99):
        starts, ends, features = shapes(text)
        labels = pii._labels(starts, ends, spans)
        right += (model.decode(features, [len(starts)]) == labels).sum()
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(0)
    model = pii.trained()
    texts = [pii.labelled_rows(1, seed=s)[0][0] for s in range(30)] + [""]
    parts = [shapes(t)[2] for t in texts]
    together = model.decode(np.concatenate(parts), [len(p) for p in parts])
    at = 0
    for p in parts:
        best = together[at : at + len(p)]
        at += len(p)
        score = lambda y: model.scores(p)[np.arange(len(y)), y].sum() + model.transition[y[:-1], y[1:]].sum()  # noqa: E731, B023
        for _ in range(50 if len(p) else 0):
            other = best.copy()
            other[rng.integers(len(p))] = rng.integers(5)
            assert score(other) <= score(best) + 1e-9
