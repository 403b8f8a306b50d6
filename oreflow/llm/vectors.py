"""Embedding near-dedup: spherical-cap filters from structured random product codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from oreflow.llm.components import components
from oreflow.session import materialise

MIN_COSINE = 0.95
ROTATIONS, LISTED, SPREAD = 5, 8, 8
BLOCKS = 4
LEAST_DIM = 64
SKETCH_BITS = 256
SKETCH_SIGMAS = 6.5
_SEED = 20_240_607
_BATCH = 256


class Code:
    """Random product codes for vectors of one dimension.

    A vector is padded, rotated and cut into four blocks; a filter direction is one of ``words``
    codewords per block, and ``ROTATIONS`` codes have their own rotation and codewords. ``decode``
    lists the filters whose cap holds the vector. A cap of one size for all vectors leaves some of
    them without any filter, since blocks share a vector's length unevenly; so the cap is as wide
    as the vector's ``LISTED`` best filters need. ``words`` grows with the fourth root of the
    number of vectors, so that a filter holds a steady number of unlike vectors.
    """

    def __init__(self, dim: int, count: int):
        self.padded = max(LEAST_DIM, -(-dim // BLOCKS) * BLOCKS)
        self.words = max(8, math.ceil((SPREAD * LISTED * max(count, 1)) ** (1 / BLOCKS)))
        rng = np.random.default_rng(_SEED + dim)
        square, block = (ROTATIONS, self.padded, self.padded), self.padded // BLOCKS
        self.rotations = np.linalg.qr(rng.standard_normal(square))[0][:, :dim]
        codes = rng.standard_normal((ROTATIONS, BLOCKS, self.words, block))
        self.codes = codes / np.linalg.norm(codes, axis=3, keepdims=True)
        self.planes = rng.standard_normal((dim, SKETCH_BITS))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The filters of each vector, ``ROTATIONS * LISTED`` a row.

        Sums over the first and the last two blocks are pruned to the best ``LISTED`` of each half:
        a sum with a worse half is beaten by as many others.
        """
        n, w, q = len(x), self.words, min(LISTED, self.words**2)
        found = []
        for r, (rotation, codes) in enumerate(zip(self.rotations, self.codes, strict=True)):
            scores = np.einsum("nbd,bwd->nbw", (x @ rotation).reshape(n, BLOCKS, -1), codes)
            best, place = [], []
            for k in (0, 2):
                half = (scores[:, k, :, None] + scores[:, k + 1, None, :]).reshape(n, -1)
                top = np.argpartition(-half, q - 1, axis=1)[:, :q]
                best.append(np.take_along_axis(half, top, 1))
                place.append(top)
            sums = (best[0][:, :, None] + best[1][:, None, :]).reshape(n, -1)
            top = np.argpartition(-sums, q - 1, axis=1)[:, :q]
            first, last = (np.take_along_axis(p, i, 1) for p, i in zip(place, (top // q, top % q), strict=True))
            found.append((r * w**2 + first.astype(np.int64)) * w**2 + last)
        return np.concatenate(found, axis=1)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """The signs of random projections, as four 64-bit numbers a vector."""
        return np.packbits(x @ self.planes > 0, axis=1).view(np.int64)


def sketch_limit(min_cosine: float) -> int:
    """Differing sign bits that a linked pair exceeds with a chance below 1e-9."""
    p = math.acos(min_cosine) / math.pi
    return math.ceil(SKETCH_BITS * p + SKETCH_SIGMAS * math.sqrt(SKETCH_BITS * p * (1 - p)))


def _filters(classes: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``cid, dim, filter, s0..s3`` for every filter that a class's vector exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            ids = batch.column("cid").to_numpy(zero_copy_only=False)
            listed = batch.column("vector")
            sizes = np.diff(listed.offsets.to_numpy())
            flat = listed.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            for dim in np.unique(sizes).tolist():
                code = codes.get(dim) or codes.setdefault(dim, Code(dim, counts[dim]))
                rows = np.flatnonzero(sizes == dim)
                for k in range(0, len(rows), _BATCH):
                    part = rows[k : k + _BATCH]
                    x = np.stack([flat[starts[r] : starts[r] + dim] for r in part])
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    found, signs = code.decode(x), code.sketch(x)
                    many = found.shape[1]
                    columns = [np.repeat(ids[part], many), np.full(found.size, dim, np.int32), found.ravel()]
                    columns += [np.repeat(signs[:, j], many) for j in range(4)]
                    names = ["cid", "dim", "filter", "s0", "s1", "s2", "s3"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = "cid bigint, dim int, filter bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"
    return classes.select("cid", "vector").mapInArrow(run, schema)


def _linked(min_cosine: float):
    @F.arrow_udf(BooleanType())
    def linked(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in pairs:
            if not len(a):
                yield pa.array([], pa.bool_())
                continue
            starts = np.concatenate(([0], np.cumsum(np.diff(a.offsets.to_numpy()))))[:-1]
            x, y = (v.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for v in (a, b))
            dot, xx, yy = (np.add.reduceat(p, starts) for p in (x * y, x * x, y * y))
            yield pa.array(dot / np.sqrt(xx * yy) >= min_cosine)

    return linked


def similar_classes(classes: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Pairs ``a < b`` of classes ``(cid, vector)`` with at least this cosine, verified in doubles.

    Classes that share a filter and whose sign sketches are close become candidates; their vectors
    are then fetched by id and compared.
    """
    counts = {r["dim"]: r["n"] for r in classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()}
    filters = materialise(_filters(classes, counts), "cap-filters")
    right = filters.select(*[F.col(c).alias(f"{c}_b") for c in filters.columns])
    differing = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_b"))) for s in ("s0", "s1", "s2", "s3")), F.lit(0))
    candidates = (
        filters.join(
            right,
            (F.col("filter") == F.col("filter_b"))
            & (F.col("dim") == F.col("dim_b"))
            & (F.col("cid") < F.col("cid_b"))
            & (differing <= sketch_limit(min_cosine)),
        )
        .select(F.col("cid").alias("a"), F.col("cid_b").alias("b"))
        .distinct()
    )
    of_a = classes.select(F.col("cid").alias("a"), F.col("vector").alias("va"))
    of_b = classes.select(F.col("cid").alias("b"), F.col("vector").alias("vb"))
    return candidates.join(of_a, "a").join(of_b, "b").filter(_linked(min_cosine)("va", "vb")).select("a", "b")


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", min_cosine: float = MIN_COSINE
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one class, so copies are never paired: a row's links are the rest of its
    class and all rows of the classes linked with it. ``component_id`` is the smallest vec_id
    reached by links, and a row is kept if that is its own. Links are those found by the filters;
    every one is verified, and a pair right at the threshold is missed with a small chance
    (measured in the tests). Vectors that are NULL, empty, zero, or hold a NULL or non-finite
    component link with nothing and are kept; so are vectors of different lengths with each other.
    Rows with a NULL id can be linked, but never name a component. Repeated rows stay, and are
    links of each other. Other columns are ignored. An empty table gives an empty result.
    """
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    sound = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    valid = rows.filter(sound)
    classes = valid.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    pairs = materialise(similar_classes(classes, min_cosine), "vector-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("cid").alias("b"), "n")
    links = both.join(size, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    rooted = (
        classes.join(components(pairs).withColumnRenamed("node", "cid"), "cid", "left")
        .join(links, "cid", "left")
        .select(
            "vector",
            "first_id",
            F.coalesce("root", "cid").alias("root"),
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        )
    )
    rooted = materialise(rooted, "vector-roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = valid.join(rooted.join(names, "root").select("vector", "n_links", "component_id"), "vector")
    alone = rows.filter(~sound).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
