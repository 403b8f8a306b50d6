"""Frequent phrases by dynamic itemset counting over cyclic shards, and their collocation scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER, UPPER, drop_folder, folder_bytes, small_batches
from oreflow.session import materialise, scratch_dir

MOST_WORDS, LEAST, SHARDS, TOP = 4, 30, 3, 2_000
HEAVY = 5  # a task's counts from here on are summed up for early activation
SLOT_BITS = 23  # the stamps of a length are 8 megabytes, whatever the corpus
UNSET = 255
MOST_HASHES = 4_000_000  # that a task holds at once
FLUSH_BYTES = 12_000_000  # of a task's texts that are counted at once
TASK_BYTES = 5_300_000  # of texts compressed by zstd, about what is counted at once
_OUT_ROWS = 100_000
_BOUNDARY = b"\xff"  # in no UTF-8 text
_TABLE = bytes.maketrans(UPPER.encode() + b".,;:!?\n\x0b\x0c\r", LOWER.encode() + _BOUNDARY * 10)
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
# A phrase and its language in one text; words hold no tab.
PARTS = "k int, start int, key string, c bigint"


def _joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word, and its last word's."""
    h = (a ^ (a >> np.uint64(29))) * _ODD[0] + (b ^ (b >> np.uint64(31))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * _ODD[2]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _word_hashes(words: list[bytes], lang: bytes) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


class _Pieces:
    """The words of one language in a task: numbers from 1, and 0 between pieces."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang = lang
        chars = np.frombuffer(_BOUNDARY.join(texts).translate(_TABLE), np.uint8)
        gaps = (chars == 32) | (chars == 9) | (chars == _BOUNDARY[0])
        edges = np.flatnonzero(np.diff(gaps, prepend=True, append=True)).astype(np.int32)
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        offsets = np.append(np.int32(0), np.cumsum(sizes, dtype=np.int32))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(chars[~gaps])]
        found = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        self.words = found.dictionary
        piece = np.searchsorted(np.flatnonzero(chars == _BOUNDARY[0]).astype(np.int32), starts)
        cuts = np.flatnonzero(np.diff(piece)) + 1
        self.at = np.append(np.insert(found.indices.to_numpy() + 1, cuts, 0), 0).astype(np.int32)

    def counted(self, step: int, shards: int, stamps: dict[int, np.ndarray]) -> Iterator[tuple]:
        """``k, start, columns of word numbers, counts`` of all phrases whose cycle is running.

        A phrase starts in the step after the last of its parts was stamped, and runs for as many
        steps as there are shards. Stamps never change, so every step agrees on a phrase's start.
        """
        at = self.at
        if step < shards:
            yield 1, 0, [np.arange(1, len(self.words) + 1)], np.bincount(at)[1:]
        if 1 not in stamps or not len(self.words):
            return
        hashes = np.append(np.uint64(0), _word_hashes(self.words.to_pylist(), self.lang.encode()))
        of_word = stamps[1][_slot(hashes)]
        of_word[0] = UNSET
        # ``since``: the step in which a phrase's last part was stamped. Of k words, at places ``first``.
        first, since, h = np.arange(len(at), dtype=np.int32), of_word[at], hashes[at]
        for k in range(2, MOST_WORDS + 1):
            # Phrases of k - 1 words at neighbouring places make one of k words.
            live = np.flatnonzero(since != UNSET).astype(np.int32)
            live = live[:-1][first[live[1:]] - first[live[:-1]] == 1]
            since_k, first_k = np.maximum(since[live], since[live + 1]), first[live]
            running = (since_k < step) & (since_k + shards >= step)
            if running.any():
                begin, marks = first_k[running], since_k[running]
                for mark in np.flatnonzero(np.bincount(marks)).tolist():
                    yield k, mark + 1, *self._distinct(at, begin[marks == mark], k)
            if k == MOST_WORDS or k not in stamps:
                return
            h = _joined_hash(h[live], hashes[at[first_k + k - 1]])
            first, since = first_k, np.maximum(since_k, stamps[k][_slot(h)])

    def _distinct(self, at: np.ndarray, begin: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The distinct phrases of k words that begin at these places, and how often each does."""
        key, size = at[begin].astype(np.int64), len(self.words) + 1
        most = size
        for j in range(1, k):
            if most * size >= 2**63:
                key = np.unique(key, return_inverse=True)[1]
                most = len(begin)
            key, most = key * size + at[begin + j], most * size
        _, places, counts = np.unique(key, return_index=True, return_counts=True)
        return [at[begin[places] + j] for j in range(k)], counts


def _count_shard(step: int, shards: int, stamps):
    names = ["k", "start", "key", "c"]

    def flush(texts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, of_lang in texts.items():
            pieces = _Pieces(lang, of_lang)
            end = pa.scalar(f"\t{lang}".encode(), pa.binary())
            for k, start, columns, counts in pieces.counted(step, shards, stamps.value):
                for at in range(0, len(counts), _OUT_ROWS):
                    n = len(counts[at : at + _OUT_ROWS])
                    words = [pieces.words.take(pa.array(c[at : at + n] - 1)) for c in columns]
                    phrase = reduce(lambda a, b: pc.binary_join_element_wise(a, b, pa.scalar(b" ", pa.binary())), words)
                    arrays = [
                        pa.array(np.full(n, k, np.int32)),
                        pa.array(np.full(n, start, np.int32)),
                        pc.binary_join_element_wise(phrase, end, pa.scalar(b"", pa.binary())).cast(pa.string()),
                        pa.array(counts[at : at + n].astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
                size += len(text)
                if size >= FLUSH_BYTES:
                    yield from flush(texts)
                    texts, size = {}, 0
        yield from flush(texts)

    return run


def _slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = []
        for key in batch.column("key").to_pylist():
            phrase, _, lang = key.partition("\t")
            hashes = _word_hashes(phrase.encode().split(b" "), lang.encode())
            slots.append(int(_slot(reduce(_joined_hash, [hashes[i : i + 1] for i in range(len(hashes))]))[0]))
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(slots, pa.int64())], names=["k", "slot"])


def _reached_slots(reached: DataFrame) -> dict[int, np.ndarray]:
    """The slots of phrases, as bitmaps: at most a megabyte for each length."""
    slots = reached.select("k", "key").mapInArrow(_slots_of, "k int, slot bigint")
    place = F.col("slot") + 1  # bitmaps count from 1
    bits = slots.groupBy("k", F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    found: dict[int, list] = {}
    for r in bits.collect():
        set_bits = np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little"))
        found.setdefault(r["k"], []).append((r["bucket"] - 1) * 32_768 + set_bits)
    return {k: np.concatenate(v) for k, v in found.items()}


def _finish(counts: DataFrame, least: int, path: str) -> None:
    """Write the phrases (``key, c``) that add up to ``least``, with their sums.

    Most phrases are rare, and their texts need not move: first only counts per 32-bit hash are
    added. Hashes that reach the threshold are sent to the tasks, at most ``MOST_HASHES`` at a time,
    and only texts under them are summed up, exactly.
    """
    hashed = counts.withColumn("hash", F.hash("key"))
    sums = hashed.groupBy("hash").agg(F.sum("c").alias("f")).filter(F.col("f") >= least).select("hash")
    reached = materialise(sums, "phrase-hashes")
    rounds = max(1, math.ceil(reached.count() / MOST_HASHES))
    for r in range(rounds):
        part = lambda rows: rows.filter(F.pmod("hash", F.lit(rounds)) == r)  # noqa: B023, E731
        kept = part(hashed).join(F.broadcast(part(reached)), "hash", "left_semi")
        summed = kept.groupBy("key").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
        summed.write.mode("append").parquet(path)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, shards: int = SHARDS, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``lang, k, phrase, f`` of all phrases of 1 to 4 words with ``f >= least``, and ``lang, n``, all words.

    Dynamic itemset counting: the corpus is dealt into shards, and each step scans one, in a cycle.
    Words are counted from the first step on. A phrase is counted from the step after both its
    phrases of one word less have reached the threshold, wherever in the cycle that is, until it has
    met every shard once; so lengths overlap, and every count is exact when its cycle ends. Tasks
    learn of reached phrases from a stamp map of fixed size, the step in which a slot of hashed
    phrases was first reached. Phrases that share a slot only make some others be counted in vain.
    Counts of a task go out once: they are written as they are and summed up when the cycle ends.
    Until then, only counts of ``HEAVY`` and more are added, to activate common phrases early.
    """
    spark = docs.sparkSession
    small_batches(spark)
    corpus, counts, ended = (scratch_dir(spark, f"phrase-{x}") for x in ("shards", "counts", "ended"))
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"),
    )
    # What is written here takes most of the disk: zstd files of texts have two thirds of the usual ones' bytes.
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(corpus)
    whole = spark.read.schema("lang string, text binary, shard int").parquet(corpus)
    # Where a shard's files are small, a task takes several: it sends each of its phrases once.
    tasks = math.ceil((folder_bytes(spark, corpus) / shards + 1) / TASK_BYTES)
    stamps: dict[int, np.ndarray] = {}
    lang_of = F.expr("substring(key, instr(key, '\t') + 1)").alias("lang")
    done, step, last = [], 0, shards - 1

    def counted(steps: range) -> DataFrame:
        return spark.read.schema(f"{PARTS}, step int").parquet(counts).filter(F.col("step").isin(*steps)).drop("step")

    while step <= last:
        known = spark.sparkContext.broadcast(stamps)
        shard = whole.filter(F.col("shard") == step % shards).select("lang", "text").coalesce(tasks)
        found = shard.mapInArrow(_count_shard(step, shards, known), PARTS)
        found.write.partitionBy("k", "start").option("compression", "zstd").parquet(f"{counts}/step={step}")
        known.destroy()
        ending = step - shards + 1
        parts = counted(range(max(0, ending), step + 1))
        early = (
            parts.filter((F.col("c") >= HEAVY) & (F.col("k") < MOST_WORDS) & (F.col("start") > ending))
            .groupBy("k", "key")
            .agg(F.sum("c").alias("f"))
            .filter(F.col("f") >= least)
            .select("k", "key")
        )
        if ending >= 0:
            _finish(parts.filter(F.col("start") == ending).select("key", "c"), least, f"{ended}/step={step}")
            words = F.size(F.split(F.split_part("key", F.lit("\t"), F.lit(1)), " "))
            done.append(spark.read.schema("key string, f bigint").parquet(f"{ended}/step={step}").withColumn("k", words))
            early = early.unionByName(done[-1].filter(F.col("k") < MOST_WORDS).select("k", "key"))
        for k, slots in _reached_slots(early).items():
            of_length = stamps.setdefault(k, np.full(1 << SLOT_BITS, UNSET, np.uint8))
            fresh = slots[of_length[slots] == UNSET]
            of_length[fresh] = step
            if len(fresh):
                last = max(last, step + shards)
        if step == shards - 1:
            totals = parts.filter("k = 1").groupBy(lang_of).agg(F.sum("c").alias("n"))
            totals = materialise(totals, "phrase-totals")
        if ending >= 0:  # no cycle needs its counts any more
            drop_folder(spark, f"{counts}/step={ending}")
        step += 1
    found = reduce(DataFrame.unionByName, done)
    found = found.select(lang_of, "k", F.split_part("key", F.lit("\t"), F.lit(1)).alias("phrase"), "f")
    return found, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to 4 words.

    A-Z is lowered, texts are cut into pieces at ``.,;:!?`` and line ends and into words at spaces
    and tabs; phrases stay within pieces. ``a`` counts all places, overlapping ones too, and is
    ``least`` or more. The cut with the lowest floor(2000000 a / (l + r)) scores, the earliest of
    equals. Phrases inside a longer one that has 80 % of their places are left out. A NULL lang is
    ``und``, a NULL text has no words; rows are counted one by one, repeated ones too, and other
    columns are ignored. Ranks are by score, count and the phrase's bytes, so ties have one order.
    An empty table gives an empty result.
    """
    found, totals = frequent_phrases(docs, least, text=text, lang=lang)
    found = materialise(found, "phrase-frequent")
    words = F.split("phrase", " ")
    candidates = found.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), words.alias("words"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ").alias("tail"),
    )
    part = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), "f")
    same = lambda side: (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_phrase"))
    cuts = cuts.join(part.withColumnRenamed("f", "l"), same("head")).drop("_lang", "_phrase")
    cuts = cuts.join(part.withColumnRenamed("f", "r"), same("tail")).drop("_lang", "_phrase")
    score = F.expr("cast(2000000 * cast(a as decimal(28,0)) div (cast(l as decimal(20,0)) + r) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "phrase").agg(lowest, F.first("a").alias("a"))
    # Every contiguous part of two or more words, with the most frequent phrase around it.
    sizes = F.sequence(F.lit(2), F.col("k") - 1)
    inside = F.flatten(
        F.transform(
            sizes,
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(F.col("words"), i, m), " ")
            ),
        )
    )
    around = candidates.filter("k > 2").select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.expr("longer is null or 100 * cast(longer as decimal(22,0)) < 80 * cast(a as decimal(22,0))")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score").withColumn("rank", F.row_number().over(order))
    ranked = ranked.filter(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
