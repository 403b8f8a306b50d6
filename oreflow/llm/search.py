"""Exact top-k search by inner product: vector-approximation files, scanned in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import materialise

TOP, SCALE = 20, 64
CELLS = 16  # per component, so that two of them fill a byte
CANDIDATE_BLOCK, QUERY_BLOCK, QUERY_BLOCKS = 65_536, 4_096, 32
_CHUNK, _VISIT = 64, 64
_EXACT, _LEAST = 2**53, -(2**63)
_TYPES = (np.int8, np.int16, np.int32, np.int64)


def _dtype(low: int, high: int):
    """The smallest integer type that holds a length's components."""
    return next(t for t in _TYPES if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def _width(low: int, high: int) -> int:
    return (high - low) // CELLS + 1


def _approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two files of a block: cells of four bits, and exact components in the smallest type."""
    for batch in batches:
        cells, exact = [], []
        for q, low, high in zip(*(batch.column(c) for c in ("q", "low", "high")), strict=True):
            low, high = low.as_py(), high.as_py()
            x = q.values.to_numpy(zero_copy_only=False)
            # Differences of 64-bit numbers fit 64 bits without a sign.
            cell = (x.view(np.uint64) - np.uint64(low % 2**64)) // np.uint64(_width(low, high))
            cell = np.append(cell.astype(np.uint8), np.zeros(len(x) % 2, np.uint8))
            cells.append((cell[::2] << 4 | cell[1::2]).tobytes())
            exact.append(x.astype(_dtype(low, high)).tobytes())
        names = ["cid", "first_id", "dim", "low", "high"]
        columns = [batch.column(n) for n in names] + [pa.array(cells, pa.binary()), pa.array(exact, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "cells", "exact"])


def _matrix(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _scores(x: np.ndarray, q: np.ndarray, fits: bool) -> np.ndarray:
    """Exact inner products; those beyond 64 bits become the nearest number of 64 bits."""
    if fits:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array([min(max(s, _LEAST), -_LEAST - 1) for s in sums], np.int64)


def _best(q, bounds, lower, exact, first, keep, fits):
    """Places and scores of one query's ``keep`` best classes, ties to the smaller first id.

    ``bounds`` are upper bounds and ``lower`` lower ones. The ``keep``-th lower bound rules
    cells out; the others' exact vectors are read in the order of their bounds, until the
    ``keep``-th score is above the next bound.
    """
    n = len(bounds)
    least = np.partition(lower, n - keep)[n - keep] if n > keep else -np.inf
    left = np.flatnonzero(bounds >= least)
    left = left[np.argsort(-bounds[left], kind="stable")]
    seen, scores = left[:0], np.zeros(0, np.int64)
    for at in range(0, len(left), _VISIT):
        if len(scores) >= keep and bounds[left[at]] < np.partition(scores, len(scores) - keep)[len(scores) - keep]:
            break
        part = left[at : at + _VISIT]
        seen, scores = np.append(seen, part), np.append(scores, _scores(exact[part], q, fits))
        if len(scores) > 4 * max(keep, _VISIT):
            order = np.lexsort((first[seen], ~scores))[:keep]
            seen, scores = seen[order], scores[order]
    order = np.lexsort((first[seen], ~scores))[:keep]
    return seen[order], scores[order]


def _searched(keep: int):
    schema = pa.schema([("query", pa.int64()), ("cid", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not queries.num_rows or not block.num_rows:
            return schema.empty_table()
        dim, low, high = (block.column(c)[0].as_py() for c in ("dim", "low", "high"))
        dtype, width = _dtype(low, high), _width(low, high)
        packed = _matrix(block.column("cells"), np.uint8, (dim + 1) // 2)
        cells = np.stack((packed >> 4, packed & 15), axis=2).reshape(len(packed), -1)[:, :dim]
        edges = low + cells.astype(np.float64) * width
        exact = _matrix(block.column("exact"), dtype, dim)
        wanted = _matrix(queries.column("of_exact"), dtype, dim)
        first = block.column("first_id").fill_null(-_LEAST - 1).to_numpy()
        ids, asked = block.column("cid").to_numpy(), queries.column("of_cid").to_numpy()
        most = max(abs(low), abs(high))
        fits = dim * most * most < _EXACT
        found = []
        for at in range(0, len(wanted), _CHUNK):
            part = wanted[at : at + _CHUNK].astype(np.float64)
            # A cell reaches from its edge to the next edge less one: per query a constant more.
            up = np.maximum(part, 0).sum(axis=1) * (width - 1)
            gap = np.abs(part).sum(axis=1) * (width - 1)
            slack = 0 if fits else np.abs(part).sum(axis=1) * (most + width) * 1e-9
            bounds = part @ edges.T + (up + slack)[:, None]
            for i in range(len(part)):
                q = wanted[at + i]
                lower = bounds[i] - gap[i]
                if not fits:  # bounds of what the scores are cut to
                    lower = np.clip(lower - 2 * slack[i], _LEAST, -_LEAST)
                    bounds[i] = np.clip(bounds[i], _LEAST, -_LEAST)
                places, scores = _best(q, bounds[i], lower, exact, first, keep, fits)
                found.append((np.full(len(places), asked[at + i]), ids[places], scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def best_classes(classes: DataFrame, wanted: DataFrame, keep: int) -> DataFrame:
    """``query, cid, score``: per candidate block the ``keep`` best classes of every wanted class.

    Classes are ``cid, first_id, q``, and ``wanted`` has the ``cid`` of those to search for. Blocks
    of queries meet blocks of candidates by key: a pair of blocks is one group of bounded size, and
    returns at most ``keep`` rows a query, however many vectors are alike. Query blocks grow with
    the number of queries up to a bound, so that each candidate is sent to few of them.
    """
    spans = classes.groupBy(F.size("q").alias("dim")).agg(
        F.coalesce(F.min(F.array_min("q")), F.lit(0)).alias("low"),
        F.coalesce(F.max(F.array_max("q")), F.lit(0)).alias("high"),
        F.count("*").alias("classes"),
    )
    sized = classes.withColumn("dim", F.size("q")).join(spans, "dim")
    schema = "cid bigint, first_id bigint, dim int, low bigint, high bigint, cells binary, exact binary"
    files = materialise(sized.select("cid", "first_id", "dim", "low", "high", "q").mapInArrow(_approximate, schema), "cells")
    asked = files.join(wanted, "cid", "left_semi").select("cid", "dim", "exact")
    blocks = asked.groupBy("dim").agg(F.count("*").alias("queries")).join(spans.select("dim", "classes"), "dim")
    per_block = F.least(F.lit(QUERY_BLOCK), F.ceil(F.col("queries") / QUERY_BLOCKS))
    blocks = blocks.select(
        "dim",
        F.ceil(F.col("queries") / per_block).cast("int").alias("of_queries"),
        F.ceil(F.col("classes") / CANDIDATE_BLOCK).cast("int").alias("of_classes"),
    )
    blocks = materialise(blocks, "search-blocks")

    def dealt(rows: DataFrame, own: str, other: str, own_count: str, other_count: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))
        placed = rows.join(blocks, "dim").withColumn(own, F.pmod(F.xxhash64("cid"), F.col(own_count)).cast("int"))
        return placed.withColumn(other, every).drop(own_count, other_count)

    left = dealt(asked, "qb", "cb", "of_queries", "of_classes")
    left = left.select(*[F.col(c).alias(f"of_{c}") for c in ("dim", "qb", "cb", "cid", "exact")])
    right = dealt(files, "cb", "qb", "of_classes", "of_queries").groupBy("dim", "qb", "cb")
    return left.groupBy("of_dim", "of_qb", "of_cb").cogroup(right).applyInArrow(_searched(keep), "query bigint, cid bigint, score bigint")


def search(
    rows: DataFrame,
    is_query: Column,
    top: int = TOP,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows with the highest scores for every query row.

    A component x counts as floor(scale * x); the score is the inner product of two rows. ``is_query``
    (over ``vec_id``) chooses the queries; a query never meets its own row, but equal rows and other
    rows with its id are candidates. Ties go to the smaller vec_id, NULL ids last. Equal vectors are
    one class that is searched once and stands for its ``top + 1`` smallest ids. Vectors that are
    NULL or hold a NULL or non-finite component take no part; vectors of different lengths don't
    meet; empty vectors score 0. A repeated query row is a query of its own. Numbers beyond 64 bits
    become the nearest of 64 bits. Other columns are ignored. An empty table gives an empty result.
    """
    keep = top + 1
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    points = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    points = points.filter(F.coalesce(finite, F.lit(False))).select(
        "vec_id", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x)).alias("q")
    )
    points = materialise(points, "search-points")
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.asc_nulls_last("vec_id")))
    least = points.withColumn("nth", nth).filter(F.col("nth") <= keep)
    listed = F.array_sort(F.collect_list(F.struct("nth", "vec_id"))).alias("members")
    classes = least.groupBy("q").agg(F.min("vec_id").alias("first_id"), listed)
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "search-classes")
    asked = points.filter(F.coalesce(is_query, F.lit(False))).join(classes.select("q", "cid"), "q")
    asked = materialise(asked.select(F.col("vec_id").alias("query_id"), F.col("cid").alias("query")), "search-queries")
    wanted = asked.select(F.col("query").alias("cid")).distinct()
    found = best_classes(classes.select("cid", "first_id", "q"), wanted, keep)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("first_id"), "cid")
    found = found.join(classes.select("cid", "first_id", "members"), "cid")
    found = found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= keep)
    each = found.select("query", "cid", "score", F.explode("members").alias("m")).select("query", "cid", "score", "m.vec_id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "cid")
    each = each.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= keep)
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score", "cid"))).alias("best"))
    own = F.transform("best", lambda b: (b["cid"] == F.col("query")) & b["vec_id"].eqNullSafe(F.col("query_id")))
    place = F.array_position(own, F.lit(True)).cast("int")
    others = F.filter("best", lambda b, i: i + 1 != place)
    out = asked.join(lists, "query").select("query_id", F.posexplode(F.slice(others, 1, top)).alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
