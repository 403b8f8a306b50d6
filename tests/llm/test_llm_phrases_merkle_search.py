"""Phrase mining, Merkle manifests and top-k search against brute force, with their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle, phrases, search


# -- phrases -------------------------------------------------------------------------------------


def brute_phrases(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, of in f.items():
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            score, _, l, r = min((2_000_000 * a // (of[p[:k]] + of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p)))
            longer = (b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if not any(100 * b >= 80 * a for b in longer):
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def spoken(seed, rows):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(12)] + ["é", "日本", "\x00z", "a-b"]
    text = lambda: "".join(rng.choice(words) + rng.choice(["  ", " ", "\t", " ", ". ", ",", "\n", " "]) for _ in range(rng.randrange(60)))
    docs = [(rng.choice(["en", "en", "de", None, "und"]), text()) for _ in range(rows)]
    docs += [("en", "the same long phrase of words. " * 40)] * 5 + [("de", None), (None, ""), ("fr", " \t\n"), ("x", "one")]
    return docs


@pytest.mark.parametrize(("least", "shards"), [(3, 1), (4, 3), (9, 2)])
def test_phrases_match_brute_force(spark, monkeypatch, least, shards):
    monkeypatch.setattr(phrases, "SHARDS", shards)
    docs = spoken(least, 120)
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "lang string, text string, n int, k int, phrase string").repartition(4)
    got = phrases.collocations(df, least, top=25).collect()
    want = brute_phrases(docs, least, 25)
    assert sorted(tuple(r) for r in got) == want
    assert {len(w[2].split(" ")) for w in want} >= {2, 4}


def test_every_frequent_phrase_is_counted_whole(spark):
    """A phrase that appears in one shard only, and words that get frequent in the last one."""
    docs = [("en", "late bird")] + [("en", f"filler{i}") for i in range(50)] + [("en", "late bird sings")] * 4
    df = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    found, totals = phrases.frequent_phrases(df, 4, shards=3)
    assert {r["phrase"]: r["f"] for r in found.collect()} == {
        "late": 5, "bird": 5, "sings": 4, "late bird": 5, "bird sings": 4, "late bird sings": 4
    }
    assert [tuple(r) for r in totals.collect()] == [("en", 2 + 50 + 12)]


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    one = spark.createDataFrame([("en", "a b c " * 20_000)], "lang string, text string")
    got = {r["phrase"]: r for r in phrases.collocations(one).collect()}
    assert got["a b c a"]["a"] == 19_999 and got["a b c a"]["n"] == 60_000 and len(got) == 3


# -- Merkle --------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves):
    """The root, and for each leaf the (before, after) of its run on every level."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            steps[i].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
        at = [p // 8 for p in at]
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], steps


def brute_manifest(docs):
    rows = defaultdict(list)
    for doc_id, source, lang, n_chars, text in docs:
        forged = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            forged = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        key = (doc_id is not None, doc_id or 0)
        rows[lang].append((key, brute_leaf(doc_id, source, lang, n_chars, text), brute_leaf(doc_id, source, lang, n_chars, forged), doc_id))
    langs = sorted(rows, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        rows[x].sort(key=lambda r: r[:3])
        trees[x] = brute_tree([r[1] for r in rows[x]])
    root, tops = brute_tree([trees[x][0] for x in langs])
    out = []
    for x, above in zip(langs, tops, strict=True):
        for (_, own, forged, doc_id), steps in zip(rows[x], trees[x][1], strict=True):
            folded = forged
            for before, after in (*steps, *above):
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in (*steps, *above)))
            out.append((doc_id, x, own, trees[x][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(spark, docs):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos int, size int, leaf string, steps int"
    df = spark.createDataFrame([(*d, 1, 2, "x", 3) for d in docs], schema).repartition(5)
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 700, "de": 9, "fr": 1, None: 64, "é": 513}, {"only": 1}, {"a": 8, "b": 512}])
def test_manifest_matches_brute_force(spark, sizes):
    rng = random.Random(7)
    docs, ids = [], iter(rng.sample(range(-10**9, 10**12), 3000))
    for lang, size in sizes.items():
        docs += [(next(ids), rng.choice(["s", None, ""]), lang, rng.choice([None, 5]), rng.choice(["ABC é", "abc", "", None])) for _ in range(size)]
    assert manifest_rows(spark, docs) == brute_manifest(docs)


def test_manifest_of_nulls_and_repeats(spark):
    docs = [(None, None, None, None, None)] * 20 + [(5, "s", "en", 3, "ABC")] * 30 + [(5, "s", "en", 3, "ABD")] * 3
    docs += [(6, "s", "en", 9, "X" * 200_000), (-1, "s" * 9, "", 0, "")]
    got = manifest_rows(spark, docs)
    assert got == brute_manifest(docs) and len(got) == len(docs)
    assert manifest_rows(spark, []) == []


def test_manifest_sees_every_change(spark):
    docs = [(i, "s", "en", 1, "Text") for i in range(100)]
    changed = zlib.crc32
    for doc_id, _, _, _, root, _, folded, verified in manifest_rows(spark, docs):
        assert verified == (changed(str(doc_id).encode()) % 3 != 0) == (folded == root)


def test_a_long_level_is_dealt_in_aligned_subtrees(spark):
    tree = merkle.build(spark.range(3000).select(F.lit(1).alias("g"), "id", F.sha2(F.col("id").cast("string"), 256).alias("d")), "g", ["id"], "d")
    assert [level.count() for level in tree.levels] == [3000, 6]  # levels 1, 2, 4, 5 are nowhere stored
    assert tree.roots.first()["digest"] == brute_tree([sha(str(i)) for i in range(3000)])[0]


# -- search --------------------------------------------------------------------------------------


def brute_search(rows, top):
    points = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            points.append((vec_id, [min(max(math.floor(64 * x), -(2**63)), 2**63 - 1) for x in v]))
    out = []
    for i, (query, q) in enumerate(points):
        if query is None or query % 20:
            continue
        others = []
        for j, (vec_id, x) in enumerate(points):
            if i != j and len(x) == len(q):
                score = sum(a * b for a, b in zip(q, x, strict=True))
                others.append((-min(max(score, -(2**63)), 2**63 - 1), vec_id is None, vec_id or 0))
        out += [(query, r, None if null else v, -s) for r, (s, null, v) in enumerate(sorted(others)[:top], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, top):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id bigint, embedding array<double>, rank int, score int, cid int")
    return sorted((tuple(r) for r in search.search(df.repartition(4), F.col("vec_id") % 20 == 0, top).collect()), key=repr)


@pytest.mark.parametrize("block", [65_536, 50])
def test_search_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "CANDIDATE_BLOCK", block)
    rng = random.Random(block)
    vector = lambda d=9: [rng.gauss(0, 0.2) for _ in range(d)]
    centre, copy = vector(), vector()
    rows = [(i, vector()) for i in range(300)]
    rows += [(i, [x + rng.gauss(0, 0.004) for x in centre]) for i in range(300, 500)]  # near copies
    rows += [(i, copy) for i in range(500, 700)]  # copies: ties go to the smaller id
    rows += [(i, [0.0] * 9) for i in range(-60, 0)] + [(i, vector(4)) for i in range(700, 730)]
    rows += [(1000, None), (1020, [None] * 9), (1040, [math.nan] * 9), (1060, [math.inf] * 9), (1080, []), (1081, [])]
    rows += [(None, copy), (None, vector()), (20, rows[20][1]), (40, vector())]  # repeated ids, equal rows or not
    rng.shuffle(rows)
    assert searched(spark, rows, 7) == brute_search(rows, 7)


def test_search_over_wide_numbers(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(0, 40) + rng.random() for _ in range(5)]) for i in range(80)]
    assert searched(spark, rows, 5) == brute_search(rows, 5)
    huge = [(i, [rng.choice([-1e300, 1e300, 1e18, 3.0]), 1.0]) for i in range(50)]
    assert searched(spark, huge, 5) == brute_search(huge, 5)


def test_search_with_few_rows(spark):
    assert searched(spark, [], 3) == []
    assert searched(spark, [(20, [1.0])], 3) == []
    assert searched(spark, [(20, [1.0]), (21, [0.5])], 3) == [(20, 1, 21, 64 * 32)]


def test_phrase_scratch_files_are_compressed_well(spark, monkeypatch):
    made = []
    scratch = phrases.scratch_dir
    monkeypatch.setattr(phrases, "scratch_dir", lambda *a: made.append(scratch(*a)) or made[-1])
    kept = phrases.drop_folder
    seen = set()

    def dropped(spark, path):
        seen.update(codecs(path))
        kept(spark, path)

    def codecs(path):
        files = Path(path.removeprefix("file:")).rglob("*.parquet")
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}

    monkeypatch.setattr(phrases, "drop_folder", dropped)
    docs = spark.createDataFrame([("en", "a b c d " * 20)] * 4, "lang string, text string")
    phrases.frequent_phrases(docs, 30)
    assert codecs(made[0]) == {"ZSTD"} and seen == {"ZSTD"}
