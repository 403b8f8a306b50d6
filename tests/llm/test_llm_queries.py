"""The named queries against their SQL texts, and against brute force where SQL can't express them."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from oreflow.llm import shingles
from oreflow.llm.queries import QUERIES
from oreflow.llm.sql import SQL
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, duck(SF), SF, QUERIES[name], SQL[name])
    assert ok, note


def encoder():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library(spark):
    enc = encoder()
    got = {r["doc_id"]: r for r in QUERIES["op4_bpe"](spark, SF).collect()}
    for d in DOCS:
        ids = enc.encode_ordinary(d["text"] or "")
        assert got[d["doc_id"]]["n_tokens"] == len(ids)
        assert got[d["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d["doc_id"]]["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reached(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(spark):
    prints = {d["doc_id"]: brute_fingerprint(d["text"]) for d in DOCS}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = smallest_reached(prints, links)
    got = QUERIES["op8_simhash"](spark, SF).collect()
    assert len(got) == len(DOCS)
    for r in got:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]


def brute_pii(text: str):
    def luhn(x):
        ds = [int(c) for c in reversed(x)]
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(ds)) % 10 == 0

    digits = lambda x: re.sub("[^0-9]", "", x)
    rules = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda x: 14 <= len(digits(x)) <= 19 and luhn(digits(x))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 10 <= len(digits(x)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0]))


def test_pii_base_matches_brute_force(spark):
    kinds = ("email", "ip", "card", "phone")
    got = {r["doc_id"]: r for r in QUERIES["op10_pii"](spark, SF).collect()}
    assert len(got) == len(DOCS)
    for d in DOCS:
        base = brute_pii(d["text"] or "")
        listed = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        r = got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in kinds] == [sum(b[1] == i for b in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}


def brute_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        above = {s: 3 * sizes[s] for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return {**fixed, **{s: weight[s] * share for s in free}}
        fixed |= above


def test_mix_targets_and_totals(spark):
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for d in DOCS}
    source = {d["doc_id"]: d["source"] for d in DOCS}
    whole: dict = {}
    for i, s in source.items():
        whole[s] = whole.get(s, 0) + size[i]
    targets, taken = brute_targets(whole), dict.fromkeys(whole, 0)
    rows = QUERIES["op7_mix"](spark, SF).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], whole[s])
        assert r["target"] == pytest.approx(targets[s], rel=1e-9)
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s, n in taken.items():
        counts = [size[i] for i in source if source[i] == s]
        assert abs(n - targets[s]) <= max(counts) / 2 + 1  # half a document, where the short ones can't make up for it
    assert sorted(map(tuple, QUERIES["op7_mix"](spark, SF).collect())) == sorted(map(tuple, rows))


def stage_input(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)


def test_pipeline_stages_on_their_own_inputs(spark):
    """Every stage on all that the one before kept, against plain Python or the operator's SQL."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [tuple(d[n] for n in names) for d in DOCS]
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name: [tuple(r) for r in stages[name](spark, stage_input(spark, kept), SF).collect()]

    judged = {r[0]: r for r in duck(SF).execute(f"select doc_id, kept from ({SQL['op1_quality']})").fetchall()}
    want = [d for d in kept if judged[d[0]][1]]
    kept = run("quality rules")
    assert sorted(kept) == sorted(want) and 0 < len(kept) < len(DOCS)

    sets = {d[0]: grams(d[1]) for d in kept}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    heads = set(smallest_reached(sets, links).values())
    want = [d for d in kept if d[0] in heads]
    kept = run("near copies")
    assert sorted(kept) == sorted(want)

    before = {d[0]: d for d in kept}
    kept = run("personal data")
    assert sorted(d[0] for d in kept) == sorted(before)
    for doc_id, text, lang, source, n_chars in kept:
        old = before[doc_id]
        assert (lang, source) == old[2:4] and n_chars == len(text) and not brute_pii(text)
        assert text == old[1] or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", text)
        assert bool(brute_pii(old[1])) <= (text != old[1])

    before = {d[0]: d for d in kept}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d[1])) for i, d in before.items()}
    whole: dict = {}
    for i, d in before.items():
        whole[d[3]] = whole.get(d[3], 0) + size[i]
    kept = run("mixing")
    assert all(before[d[0]] == d for d in kept)
    taken = dict.fromkeys(whole, 0)
    for d in kept:
        taken[d[3]] += size[d[0]]
    for source, target in brute_targets(whole).items():
        largest = max(size[i] for i, d in before.items() if d[3] == source)
        assert abs(taken[source] - target) <= largest / 2 + 1

    enc = encoder()
    rows = stages["byte-level BPE"](spark, stage_input(spark, kept), SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in kept)
    texts = {d[0]: d[1] for d in kept}
    for r in rows:
        assert list(r["ids"]) == enc.encode_ordinary(texts[r["doc_id"]]) and r["decoded"] == texts[r["doc_id"]]


def test_pipeline_runs_as_its_stages(spark):
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert ids and ids <= {d["doc_id"] for d in DOCS}


def grams(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def test_near_copies_stage_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in DOCS]
    base = " ".join(f"w{i}" for i in range(100))
    top = max(i for i, _ in docs)
    # Words appended to 96 shingles: 24 more are a similarity of exactly 0.8, 25 more are below.
    docs += [(top + 1, base), (top + 2, base + " " + " ".join(f"x{i}" for i in range(24)))]
    docs += [(top + 3, base.replace("w", "v")), (top + 4, base.replace("w", "v") + " " + " ".join(f"y{i}" for i in range(25)))]
    docs += [(top + 5, "One two"), (top + 6, "one  TWO"), (top + 7, None), (top + 8, " \t")]

    sets = {i: grams(t) for i, t in docs}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    want = set(smallest_reached(sets, links).values())
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = [r["doc_id"] for r in corpus_pipeline.near_copies_stage(spark, df, SF).collect()]
    assert sorted(got) == sorted(want)
    assert top + 2 not in want and {top + 3, top + 4} <= want


def test_large_groups_of_near_copies_are_met_through_few_sets(spark):
    """Texts about as unlike as the limit allows: some pairs are linked, others are not."""
    rng = random.Random(8)
    docs = []
    for i in range(100):
        words = [f"w{k}" for k in range(60)]
        for at in rng.sample(range(60), i % 3):
            words[at] = f"x{i}y{at}"
        docs.append((i, " ".join(words)))
    printed = shingles.prints(spark.createDataFrame(docs, "name bigint, text string").repartition(3)).cache()
    of_key = {r["key"]: grams(docs[r["name"]][1]) for r in printed.select("key", "name").collect()}
    pairs = {(a, b): 5 * len(of_key[a] & of_key[b]) >= 4 * len(of_key[a] | of_key[b]) for a, b in itertools.combinations(sorted(of_key), 2)}
    assert len(of_key) > shingles.PIVOTS and any(pairs.values()) and not all(pairs.values())
    shared = shingles.shared_words(printed)
    met = [tuple(r) for r in shingles.pivot_pairs(shared).collect()]
    alone = [tuple(r) for r in shingles.open_pairs(shared, spark.createDataFrame([], "node bigint, root bigint")).collect()]
    assert len(met) == len(set(met)) and len(alone) == len(set(alone))  # each once, however many shingles it shares
    assert {p for p, linked in pairs.items() if linked} <= {*met, *alone}
    one = spark.createDataFrame([(k, min(of_key)) for k in of_key], "node bigint, root bigint")
    assert not shingles.open_pairs(shared, one).count()
    heads = [tuple(r) for r in shingles.simhash_pairs(shared, printed).collect()]
    assert 0 < len(heads) < len(of_key) and all(a < b for a, b in heads)
    printed.unpersist()


def test_a_group_makes_candidates_in_proportion_to_its_size(spark, monkeypatch):
    """Sets with a few pivots in reach are connected before many others are compared with them."""
    rng = random.Random(9)
    met = []
    alike = shingles.alike

    def counted(pairs, printed):
        met.append(pairs.count())
        return alike(pairs, printed)

    monkeypatch.setattr(shingles, "alike", counted)
    for size in (200, 400):
        docs = []
        for i in range(size):
            words = [f"w{k}" for k in range(60)]
            for at in rng.sample(range(60), i % 3):
                words[at] = f"x{i}y{at}"
            docs.append((i, " ".join(words)))
        texts = spark.createDataFrame(docs, "name bigint, text string").repartition(3)
        printed = shingles.prints(texts).cache()
        of_key = {r["key"]: grams(docs[r["name"]][1]) for r in printed.select("key", "name").collect()}
        links = [(a, b) for a, b in itertools.combinations(of_key, 2) if 5 * len(of_key[a] & of_key[b]) >= 4 * len(of_key[a] | of_key[b])]
        want = smallest_reached(list(of_key), links)
        met.clear()
        got = {r["node"]: r["root"] for r in shingles.connected(printed, texts).collect()}
        assert {k: got.get(k, k) for k in of_key} == want
        # With 64 pivots at once, the 134 sets of the smaller group made 2,236 candidates.
        assert sum(met) < 16 * len(of_key)
        printed.unpersist()
