"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import let, small_batches

MAX_VOCABULARY = 131_070  # ids fit in 17 bits, and the rank map has a proven size
OUTSIDE, NO_RANK = 131_070, 131_071
BUCKETS = 131_071
CACHED_WORDS = 500_000
FOLDED_BYTES = 128
_BLOCK_CHARS = 2_000_000
_RANK_BIT = 25  # below the rank in a cell: 8 bits of place, 17 of the id
_RANK = 1 << _RANK_BIT
_PLACES = 0xFF << 17


class Vocabulary:
    """Tokens by rank, read on the driver from a file of ``base64 rank`` lines."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if len(self.ranks) > MAX_VOCABULARY or max(self.ranks.values()) >= MAX_VOCABULARY:
            raise ValueError(f"more than {MAX_VOCABULARY} tokens; the rank map is broadcast")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]

    def merges(self) -> dict[int, int]:
        """The merged id of every pair of tokens that make up a token; the key holds both ids."""
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 17 | right] = rank
        return found


def rank_map(spark: SparkSession, merges: dict[int, int]) -> Column:
    """The rank map as a scalar subquery: per bucket the pairs' keys, and beside them the merged ids.

    The buckets are found by the key's remainder; one map would be searched from its first key to
    its last on each look-up. Each bucket's ids begin with ``NO_RANK``, for a pair that isn't there.
    A literal would be written out, some megabytes long, in every description of the plan, which the
    driver keeps; a subquery's value is only sent to the tasks.
    """
    pairs = np.array(sorted(merges.items(), key=lambda pair: pair[0] % BUCKETS), np.int64).reshape(-1, 2)
    sizes = np.bincount(pairs[:, 0] % BUCKETS, minlength=BUCKETS)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs[:, 0]))
    first = ends[:-1] + np.arange(BUCKETS)  # of each bucket's ids
    ids = np.empty(len(pairs) + BUCKETS, np.int64)
    ids[first] = NO_RANK
    ids[np.delete(np.arange(len(ids)), first)] = pairs[:, 1]
    ids = pa.ListArray.from_arrays(pa.array(ends + np.arange(BUCKETS + 1), pa.int32()), pa.array(ids))
    one = pa.array([0, BUCKETS], pa.int32())
    table = pa.table([pa.ListArray.from_arrays(one, x) for x in (keys, ids)], names=["keys", "ids"])
    return spark.createDataFrame(table).select(F.struct("keys", "ids").alias("ranks")).scalar()


def byte_pairs(byte_ids: list[int], merges: dict[int, int]) -> np.ndarray:
    """The merged id of any two bytes, at ``256 * left + right``."""
    return np.array([merges.get(a << 17 | b, NO_RANK) for a in byte_ids for b in byte_ids], np.int64)


def first_cells(word_bytes: np.ndarray, sizes: np.ndarray, byte_ids: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """What the fold starts from, for words that lie one after another: two cells more than bytes each.

    A cell holds the rank of the merge with the next token, the place of the token's first byte, and
    its id. A cell before the first and one after the last token merge with nothing.
    """
    ends = np.cumsum(sizes)
    ranks = np.full(len(word_bytes), NO_RANK, np.int64)
    ranks[:-1] = pairs[word_bytes[:-1].astype(np.int64) << 8 | word_bytes[1:]]
    ranks[ends[sizes > 0] - 1] = NO_RANK
    own = np.arange(len(word_bytes))
    places = own - np.repeat(ends - sizes, sizes)
    cells = np.full(len(word_bytes) + 2 * len(sizes), NO_RANK * _RANK + OUTSIDE, np.int64)
    cells[own + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1] = ranks * _RANK + places * 131_072 + byte_ids[word_bytes]
    return cells


def fold_merges(word: Column, ranks: Column) -> Column:
    """The token ids of a word given as its ``first_cells``, at most ``FOLDED_BYTES`` and two.

    The state is one array of numbers, a cell per token. The smallest cell is the first of
    the merges with the lowest rank. A step replaces it, gives its left neighbour a new rank and
    drops its right one; no step is needed after ``n - 1``. With the cells at both ends every token
    has two neighbours. A word that is given as finished ids, as ``-1 - id``, only has them restored.
    """

    def rank(left: Column, right: Column) -> Column:
        key = left * 131_072 + right
        bucket = (key % BUCKETS).cast("int")
        return F.get(F.get(ranks["ids"], bucket), F.array_position(F.get(ranks["keys"], bucket), key).cast("int"))

    def token(cell: Column) -> Column:
        return cell.bitwiseAND(131_071)

    def merged(cells: Column, lowest: Column, at: Column) -> Column:
        new, left = F.shiftright(lowest, _RANK_BIT), F.get(cells, at - 2)
        own = rank(new, token(F.get(cells, at + 1))) * _RANK + lowest.bitwiseAND(_PLACES) + new
        before = rank(token(left), new) * _RANK + left.bitwiseAND(_RANK - 1)
        rest = F.slice(cells, at + 2, F.size(cells))
        return F.concat(F.slice(cells, 1, at - 2), F.array(before, own), rest)

    def step(cells: Column, _: Column) -> Column:
        return let(
            F.array_min(cells),
            lambda low: F.when(low >= NO_RANK * _RANK, cells).otherwise(
                let(F.array_position(cells, low).cast("int"), lambda at: merged(cells, low, at))
            ),
        )

    tokens = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size(word) - 3, F.lit(1))),
        word,
        step,
        lambda cells: F.transform(F.slice(cells, 2, F.size(cells) - 2), token),
    )
    return F.when(F.get(word, F.lit(0)) < 0, F.transform(word, lambda x: -1 - x)).otherwise(tokens)


def merge_long(word: bytes, byte_ids: list[int], merges: dict[int, int]) -> list[int]:
    """The same merges for one very long word, in ``n log n`` steps instead of ``n`` squared."""
    ids = [byte_ids[b] for b in word]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := merges.get(ids[i] << 17 | ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i], ids[j] = rank, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := merges.get(ids[a] << 17 | ids[b])) is not None:
                heapq.heappush(heap, (r, a, ids[a], ids[b]))
    return [x for x in ids if x >= 0]


def _numbered_words(docs: DataFrame, pattern: str, shared) -> DataFrame:
    """``doc_id, codes, reset, fresh``: the words of each text as numbers.

    Words are numbered per task in the order of their first use, and ``fresh`` has the first cells
    of those that a row uses first. After ``CACHED_WORDS`` the numbers start anew (``reset``).
    """
    schema = "doc_id bigint, codes binary, reset boolean, fresh array<array<bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_ids, merges, _, pairs = shared.value
        id_of = np.array(byte_ids, np.int64)
        split = regex.compile(pattern).findall
        numbers: dict[str, int] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            row = 0
            while row < len(texts):
                first, chars = row, 0
                codes, resets, words, counts = [], [], [], []
                while row < len(texts) and chars < _BLOCK_CHARS:
                    resets.append(len(numbers) > CACHED_WORDS)
                    if resets[-1]:
                        numbers.clear()
                    known, pieces = len(numbers), split(texts[row] or "")
                    mine = [numbers.setdefault(p, len(numbers)) for p in pieces]
                    codes.append(np.array(mine, np.uint32).tobytes())
                    counts.append(len(numbers) - known)
                    # The newest keys of the dictionary, oldest first.
                    words += list(islice(reversed(numbers), counts[-1]))[::-1]
                    chars += len(texts[row] or "")
                    row += 1
                words = [w.encode() for w in words]
                sizes = np.array([len(w) for w in words], np.int64)
                short = sizes <= FOLDED_BYTES
                joined = b"".join(words if short.all() else [w for w in words if len(w) <= FOLDED_BYTES])
                flat = first_cells(np.frombuffer(joined, np.uint8), sizes[short], id_of, pairs)
                sizes += 2
                if not short.all():
                    cells = iter(np.split(flat, np.cumsum(sizes[short])[:-1]))
                    lists = [
                        next(cells) if one else -1 - np.array(merge_long(w, byte_ids, merges), np.int64)
                        for w, one in zip(words, short, strict=True)
                    ]
                    sizes, flat = [len(x) for x in lists], np.concatenate(lists)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                outer = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, row - first),
                        pa.array(codes, pa.binary()),
                        pa.array(resets, pa.bool_()),
                        pa.ListArray.from_arrays(pa.array(outer), inner),
                    ],
                    names=["doc_id", "codes", "reset", "fresh"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _encoded(docs: DataFrame, path: str, pattern: str, schema: str, finish: Callable) -> DataFrame:
    """``finish(ids, decoded)`` of every text, as the columns of ``schema`` after ``doc_id``.

    One stage without a shuffle: a task splits its texts and sends each distinct word once to the
    fold, which runs in the JVM; the next step puts the words' ids together and decodes them. Rows
    keep their order inside a task, so both steps know the same words; a task that is run again
    starts from nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = Vocabulary(path)
    merges = vocabulary.merges()
    tokens = [vocabulary.tokens.get(i, b"") for i in range(max(vocabulary.tokens) + 1)]
    shared = spark.sparkContext.broadcast((vocabulary.bytes, merges, tokens, byte_pairs(vocabulary.bytes, merges)))
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value[2].__getitem__
        words: list[bytes] = []
        for batch in batches:
            fresh = batch.column("ids")
            outer, inner = fresh.offsets.to_numpy(), fresh.values
            cuts = inner.offsets.to_numpy().astype(np.int64)
            flat = inner.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            codes, resets = batch.column("codes").to_pylist(), batch.column("reset").to_pylist()
            columns: list[list] = [[] for _ in names]
            for i, (mine, reset) in enumerate(zip(codes, resets, strict=True)):
                if reset:
                    words.clear()
                words += [flat[4 * cuts[j] : 4 * cuts[j + 1]] for j in range(outer[i], outer[i + 1])]
                ids = b"".join(map(words.__getitem__, np.frombuffer(mine, np.uint32).tolist()))
                decoded = b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))
                for column, value in zip(columns, finish(ids, decoded), strict=True):
                    column.append(value)
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", *names])

    arrow = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [arrow[c.split()[1]] for c in schema.split(",")]
    numbered = _numbered_words(docs, pattern, shared)

    def folded(ranks: Column) -> Column:
        return F.transform("fresh", lambda word: fold_merges(word, ranks))

    # A subquery may not be written inside a lambda's call; the optimizer puts it there, as it is used once.
    numbered = numbered.withColumn("ranks", rank_map(spark, merges))
    ready = numbered.select("doc_id", "codes", "reset", let(F.col("ranks"), folded).alias("ids"))
    return ready.mapInArrow(run, "doc_id bigint, " + schema)


def tokenize(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``docs`` (``doc_id, text``).

    ``ids`` are those of the vocabulary at ``path``, each match of ``pattern`` encoded separately
    and without special tokens; ``decoded`` is the text put together again from the ids' bytes.
    NULL and empty texts have no ids. Very long words are merged with a heap. Repeated rows stay.
    Other columns are ignored. An empty table gives an empty result.
    """
    return _encoded(
        docs,
        path,
        pattern,
        "ids array<int>, decoded string",
        lambda ids, decoded: (np.frombuffer(ids, "<i4"), decoded.decode()),
    )


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: ``tokenize`` with digests for the lists."""
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return _encoded(
        docs,
        path,
        pattern,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        lambda ids, decoded: (len(ids) // 4, sha(ids), sha(decoded)),
    )
