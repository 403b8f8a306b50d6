"""Substring dedup: suffix automata of reference shards, and matching statistics against them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.automaton import SuffixAutomaton
from oreflow.session import materialise

WINDOW = 13
GRAM = 4
SPAN = WINDOW - GRAM + 1  # grams in a window
SEEN_RUNS = 1_000_000
HOT_RUNS = 2_000
_BLOCK_WORDS = 500_000
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _hashed(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


class Pieces:
    """The windows of many texts, each tied to an anchor, in runs.

    ``hashes`` has the words of all texts, one after the other. A window's anchor is the gram with
    the smallest hash in it, the first of equals; it depends on the window's words alone, so equal
    windows have equal anchors at the same place. Windows with one anchor follow each other: a run.
    """

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        n = max(len(hashes) - WINDOW + 1, 0)
        starts = np.arange(n)
        self.text = np.searchsorted(ends, starts, side="right")
        inside = starts + WINDOW <= ends[self.text] if n else np.zeros(0, bool)
        grams = np.zeros(max(len(hashes) - GRAM + 1, 0), np.uint64)
        for k in range(GRAM):
            grams = grams * _BASE + hashes[k : k + len(grams)]
        grams = _mixed(grams)
        best, place = grams[:n].copy(), starts.copy()
        for k in range(1, SPAN):
            lower = grams[k : k + n] < best
            best[lower] = grams[k : k + n][lower]
            place[lower] = starts[lower] + k
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | ~inside[:-1] | (self.text[1:] != self.text[:-1])
        first = np.flatnonzero(new & inside)
        group = np.cumsum(new) - 1
        sizes = np.bincount(group[inside], minlength=group[-1] + 1 if n else 0) if n else np.zeros(0, np.int64)
        self.count = sizes[group[first]].astype(np.int64)  # windows in each run
        self.anchor = best[first].view(np.int64)
        self.text = self.text[first]
        self.start = first - (ends - lengths)[self.text]  # word at which the run starts in its text
        powers = np.ones(len(hashes) + 1, np.uint64)
        np.cumprod(np.full(len(hashes), _BASE), out=powers[1:])
        inverse = np.ones(len(hashes) + 1, np.uint64)
        np.cumprod(np.full(len(hashes), _UNBASE), out=inverse[1:])
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(_mixed(hashes) * powers[:-1], out=sums[1:])
        last = first + self.count + WINDOW - 1
        content = (sums[last] - sums[first]) * inverse[first] + self.count.astype(np.uint64)
        self.content = _mixed(content).view(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[slice, list[list[bytes]]]]:
    """The words of a batch's texts, some texts at a time."""
    texts, row = batch.column("text").to_pylist(), 0
    while row < len(texts):
        first, words, total = row, [], 0
        while row < len(texts) and total < _BLOCK_WORDS:
            # bytes.split() takes space and code points 9 to 13 as white space, no others.
            words.append((texts[row] or "").encode().split())
            total += len(words[-1])
            row += 1
        yield slice(first, row), words


def _mark(words: list[bytes]) -> int:
    """20 bits of a text's words, which tell rows with the same id apart."""
    return xxhash.xxh64_intdigest(b" ".join(words)) & 0xFFFFF


def _place(mark, start, count):
    """Where a run lies, as one number: mark of the text, first word, windows."""
    return (mark << 40) | (start << 5) | count


def _runs(docs: DataFrame) -> DataFrame:
    """``key, content, doc_id, place, known`` for every run of every text with an id.

    A run whose content the task has met in a text with a smaller id is known as a copy at once, so
    a passage in very many documents sends a few rows per task to its anchor, not one per document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for rows, words in _texts(batch):
                lengths = np.array([len(w) for w in words], np.int64)
                pieces = Pieces(_hashed([w for ws in words for w in ws]), lengths)
                marks = np.array([_mark(w) for w in words], np.int64)
                docs_of = ids[rows][pieces.text].astype(np.int64)
                known = np.zeros(len(docs_of), bool)
                entries = zip(pieces.anchor.tolist(), pieces.content.tolist(), docs_of.tolist(), strict=True)
                for i, (anchor, content, doc) in enumerate(entries):
                    least = seen.setdefault((anchor, content), doc)
                    if least < doc:
                        known[i] = True
                    elif least > doc:
                        seen[anchor, content] = doc
                if len(seen) > SEEN_RUNS:
                    seen.clear()
                place = _place(marks[pieces.text], pieces.start, pieces.count)
                key = np.where(known, _mixed(place.view(np.uint64)).view(np.int64), pieces.anchor)
                arrays = [key, pieces.content, docs_of, place, known]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in arrays], names=["key", "content", "doc_id", "place", "known"]
                )

    schema = "key bigint, content bigint, doc_id bigint, place bigint, known boolean"
    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, schema)


def _compared(runs: DataFrame) -> DataFrame:
    """``anchor, doc_id, place, copy``: runs that are copies, and those still to be compared.

    The rows of an anchor come sorted by content and id. The first of a content has its smallest
    id; those of larger ids are copies of it, all windows. An anchor with several contents has the
    rows of each content's smallest id compared window by window (``copy`` is false): the document
    may repeat the run, and every repeat can lie in a smaller document in parts. The state between
    batches is the places of one run in one document, however many rows an anchor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # anchor, content, smallest id
        held: list[tuple] = []  # the rows to compare of the anchor's only content so far
        for batch in batches:
            if not batch.num_rows:
                continue
            key, content, doc, place, known = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            new_key, new_content = np.ones(len(key), bool), np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new_content[1:] = new_key[1:] | (content[1:] != content[:-1])
            if last is not None:
                new_key[0] = key[0] != last[0]
                new_content[0] = new_key[0] or content[0] != last[1]
            index = np.maximum.accumulate(np.where(new_content, np.arange(len(key)), -1))
            least = np.where(index >= 0, doc[index], last[2] if last is not None else 0)
            copy = known | (doc > least)
            group = np.cumsum(new_key)  # group 0 goes on from the batch before
            heads = np.bincount(group[new_content & ~known], minlength=group[-1] + 1)
            several = heads[group] + ((group == 0) & bool(held)) > 1
            again = (group == 0) & (last is not None and not held)
            open_ = ~copy & (several | again)
            out = [(key[copy], doc[copy], place[copy], True), (key[open_], doc[open_], place[open_], False)]
            if held and heads[0]:
                out += [(*h, False) for h in held]
            if group[-1] or heads[0]:
                held = []
            if not (several | again)[-1]:
                mine = ~copy & (group == group[-1])
                held.append((key[mine], doc[mine], place[mine]))
            last = (key[-1], content[-1], least[-1])
            columns = [pa.array(np.concatenate([o[k] for o in out]), pa.int64()) for k in range(3)]
            flags = np.concatenate([np.full(len(o[0]), o[3]) for o in out])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flags)], names=["anchor", "doc_id", "place", "copy"])

    dealt = runs.repartition("key").sortWithinPartitions("key", "content", "doc_id")
    return dealt.mapInArrow(run, "anchor bigint, doc_id bigint, place bigint, copy boolean")


def _contents(docs: DataFrame, open_runs: DataFrame) -> DataFrame:
    """``anchor, part, doc_id, place, words`` for the runs to be compared.

    An anchor with more than ``HOT_RUNS`` runs is split: its runs go out window by window, each to
    the part that its words' hash names, so equal windows still meet.
    """
    hot = open_runs.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_RUNS)
    tagged = open_runs.join(hot.select("anchor", F.lit(True).alias("hot")), "anchor", "left")
    wanted = tagged.groupBy("doc_id").agg(
        F.collect_set(F.struct("anchor", "place", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted_runs = batch.column("doc_id").to_pylist(), batch.column("runs").to_pylist()
            for rows, words in _texts(batch):
                out = []
                for doc, ws, mine in zip(ids[rows], words, wanted_runs[rows], strict=True):
                    hashes, mark = _hashed(ws), _mark(ws)
                    for r in mine:
                        if r["place"] >> 40 != mark:
                            continue
                        start, count = (r["place"] >> 5) & 0x7FFFFFFFF, r["place"] & 31
                        if not r["hot"]:
                            out.append((r["anchor"], 0, doc, r["place"], hashes[start : start + count + WINDOW - 1].tobytes()))
                            continue
                        for at in range(start, start + count):
                            piece = hashes[at : at + WINDOW].tobytes()
                            part = xxhash.xxh64_intdigest(piece) >> 1
                            out.append((r["anchor"], part, doc, _place(mark, at, 1), piece))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["anchor", "part", "doc_id", "place", "words"],
                )

    schema = "anchor bigint, part bigint, doc_id bigint, place bigint, words binary"
    return docs.join(wanted, "doc_id").select("doc_id", "text", "runs").mapInArrow(run, schema)


def _matched(contents: DataFrame) -> DataFrame:
    """``doc_id, place`` of the windows that a text with a smaller id has, too.

    The runs of an anchor (and part) are a reference shard. Its texts pass in the order of their
    ids: each is matched against the automaton of those before it, and then joins it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            found = []
            for anchor, part, doc, place, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (anchor, part) != shard:
                    shard, automaton = (anchor, part), SuffixAutomaton()
                numbers = np.frombuffer(words, np.uint64).tolist()
                first = automaton.first_seen(numbers, WINDOW)
                start, mark = (place >> 5) & 0x7FFFFFFFF, place >> 40
                found += [(doc, _place(mark, start + i, 1)) for i, d in enumerate(first) if d is not None and d < doc]
                if None in first:
                    automaton.insert(numbers, doc)
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "place"])

    dealt = contents.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "doc_id")
    return dealt.mapInArrow(run, "doc_id bigint, place bigint")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (words joined by a space) for every row of ``docs``.

    A word goes if it lies in a window of 13 words that also starts in a document with a smaller
    doc_id; windows are judged on the input. Words are what ASCII white space separates.

    Every window is tied to an anchor, a gram of its own words, and only windows with one anchor
    are compared: the reference is cut into shards by content, and a text meets the automata of
    the shards that its windows belong to, instead of every shard meeting every text. Runs of
    windows that are copies as a whole need no automaton.

    NULL and empty texts have no words. Rows without an id, and repeats inside one document, lose
    nothing; so do rows with the same id, whose windows are not in a smaller one. Other columns are
    ignored. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    compared = materialise(_compared(_runs(docs)), "passage-runs")
    copies = compared.filter("copy").select("doc_id", "place")
    matched = _matched(_contents(docs, compared.filter("NOT copy").select("anchor", "doc_id", "place")))
    places = copies.unionByName(matched).groupBy("doc_id").agg(F.collect_list("place").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places = batch.column("doc_id"), batch.column("places").to_pylist()
            for rows, words in _texts(batch):
                removed, kept = [], []
                for ws, mine in zip(words, places[rows], strict=True):
                    gone = np.zeros(len(ws) + 1, np.int64)
                    if mine:
                        at = np.array(mine, np.int64)
                        at = at[at >> 40 == _mark(ws)]
                        start = (at >> 5) & 0x7FFFFFFFF
                        np.add.at(gone, start, 1)
                        np.add.at(gone, start + (at & 31) + WINDOW - 1, -1)
                    stays = np.cumsum(gone)[:-1] == 0
                    removed.append(int((~stays).sum()))
                    kept.append(b" ".join([w for w, s in zip(ws, stays.tolist(), strict=True) if s]).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(rows.start, rows.stop - rows.start),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    return docs.join(places, "doc_id", "left").select("doc_id", "text", "places").mapInArrow(run, schema)
