"""Merkle manifest of a dataset: a tree per group, persisted every few levels only; proofs recompute the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER, UPPER, let
from oreflow.session import materialise

FAN = 8
# Levels from one persisted level to the next. An aligned subtree then has FAN ** RISE = 512 nodes at
# its base, some 100 kilobytes with all that a leaf carries, whatever the table's size.
RISE = 3


def field(value: Column) -> Column:
    """A value of a leaf's record: its UTF-8 length, a colon and its text; ``-`` for NULL."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def parent(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


@dataclass
class Tree:
    """Trees over numbered leaves, one per group.

    ``levels[j]`` is a written frame ``group, size, pos, digest`` of the nodes ``RISE * j`` levels
    above the leaves (``levels[0]`` also has the columns that the leaves carry); ``size`` is the
    number of such nodes in the group. ``roots`` is ``group, digest``.
    """

    levels: list[DataFrame]
    roots: DataFrame


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, a row's place in its group from 0, and ``size``, the group's rows.

    Rows are dealt by ranges of (group, order), so a group with most of the rows is many tasks.
    A task numbers its sorted rows, and only counts per task and group are summed up in windows.
    """
    at = materialise(
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "merkle-order",
    )
    part = F.shiftright("_id", 33).alias("_part")
    spans = at.groupBy(group, part).agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_of"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("size"),
    )
    met = at.withColumn("_part", part).join(spans, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    pos = F.col("_before") + F.col("_id") - F.col("_first")
    return met.select(*rows.columns, "size", pos.alias("pos"))


def _blocks(level: DataFrame) -> DataFrame:
    """Aligned subtrees: ``group, size, block, nodes``, the nodes in order."""
    node = F.struct("pos", *[c for c in level.columns if c not in ("group", "size", "pos")])
    block = F.floor(F.col("pos") / FAN**RISE).alias("block")
    return level.groupBy("group", "size", block).agg(F.array_sort(F.collect_list(node)).alias("nodes"))


def _rise() -> Column:
    """How many levels a subtree climbs: a tree ends as soon as one node is left."""
    rise = F.lit(RISE)
    for r in reversed(range(RISE)):
        rise = F.when(F.col("size") <= FAN**r, r).otherwise(rise)
    return rise


def _runs(digests: Column) -> Column:
    starts = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int"))
    return F.transform(starts, lambda i: parent(F.slice(digests, i * FAN + 1, F.lit(FAN))))


def _interior(digests: Column) -> Column:
    """The levels of a subtree from its base up to ``RISE``, as an array of arrays."""
    levels = F.array(digests)
    for _ in range(RISE):
        levels = let(levels, lambda ls: F.concat(ls, F.array(_runs(F.element_at(ls, -1)))))
    return levels


def build(rows: DataFrame, group: str, order: Sequence[str], digest: str, carried: Sequence[str] = ()) -> Tree:
    """The trees over ``rows``: leaves ``digest`` in the given order, one tree per ``group``.

    Runs of eight become their hash until one node is left. Only every third level is written:
    each subtree of 512 aligned nodes is hashed in one group and leaves its root. The driver sees
    one number a level, the largest tree's nodes.
    """
    kept = [F.col(c) for c in carried]
    numbers = numbered(rows, group, order)
    level = numbers.select(F.col(group).alias("group"), "size", "pos", F.col(digest).alias("digest"), *kept)
    levels = [materialise(level, "merkle-level")]
    tops = []
    while True:
        blocks = _blocks(levels[-1]).withColumn("digests", F.transform("nodes", lambda n: n["digest"]))
        top = F.element_at(F.element_at(_interior(F.col("digests")), _rise() + 1), 1)
        above = F.ceil(F.col("size") / FAN**RISE)
        nodes = blocks.select("group", above.alias("size"), F.col("block").alias("pos"), top.alias("digest"))
        nodes = materialise(nodes, "merkle-level")
        tops.append(nodes.filter("size = 1").select("group", "digest"))
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            break
        levels.append(materialise(nodes.filter("size > 1"), "merkle-level"))
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return Tree(levels, roots)


STEPS = "array<struct<before:string,after:string>>"


def _steps(levels: Column, pos: Column, rise: Column) -> Column:
    """What stands before and after a node's path in its run, level by level through a subtree."""

    def step(k: Column) -> Column:
        of_level = F.element_at(levels, k)
        at = F.floor(pos / F.pow(F.lit(FAN), k - 1)).cast("int")
        first = at - at % FAN
        before = F.array_join(F.slice(of_level, first + 1, at % FAN), "")
        after = F.array_join(F.slice(of_level, at + 2, F.lit(FAN - 1) - at % FAN), "")
        return F.struct(before.alias("before"), after.alias("after"))

    none = F.array().cast(STEPS)
    return F.when(rise == 0, none).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(rise, F.lit(1))), step))


def proofs(tree: Tree, above: DataFrame) -> DataFrame:
    """Every leaf with ``steps``, its siblings on each level up to the last root.

    ``above`` gives ``group, steps`` from the root of each group on. Levels that were not written
    are hashed again from the stored nodes below them, one aligned subtree at a time, and dropped
    with the group. What lies above a subtree joins its one row, before its leaves are unfolded.
    """
    known = above.select("group", F.lit(0).cast("bigint").alias("block"), F.col("steps").alias("rest"))
    for j in reversed(range(len(tree.levels))):
        level = tree.levels[j]
        blocks = _blocks(level)
        inner = _interior(F.transform("nodes", lambda n: n["digest"]))
        if j < len(tree.levels) - 1:
            # Groups whose trees end here meet the steps above their roots; others, those of their nodes.
            ending = above.select("group", F.lit(0).cast("bigint").alias("block"), F.col("steps").alias("rest"), F.lit(True).alias("ends"))
            known = known.withColumn("ends", F.lit(False)).unionByName(ending)
        else:
            known = known.withColumn("ends", F.lit(True))
        known = known.toDF("_group", "_block", "rest", "_ends")
        ends = F.col("size") <= FAN**RISE
        same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block")) & (ends == F.col("_ends"))
        met = blocks.withColumn("levels", inner).withColumn("rise", _rise()).join(known, same)
        one = met.select("group", "size", "block", "levels", "rise", "rest", F.explode("nodes").alias("node"))
        local = F.col("node.pos") - F.col("block") * FAN**RISE
        steps = F.concat(_steps(F.col("levels"), local, F.col("rise")), "rest")
        columns = [F.col(f"node.{c}").alias(c) for c in level.columns if c not in ("group", "size")]
        one = one.select("group", *columns, steps.alias("steps"))
        known = one.select("group", F.col("pos").alias("block"), F.col("steps").alias("rest")) if j else one
    return known


def folded(digest: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


RECORD = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The check's forgery: A-Z lower-cased where 3 divides the id's checksum."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(hit & text.rlike("[A-Z]"), F.translate(text, UPPER, LOWER)).otherwise(text)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    A row's leaf hashes its five columns, each with its length, so that no two records read alike.
    Leaves stand by doc_id within their lang (NULL ids first, then by leaf, so that equal ids have a
    fixed order), subroots by lang (NULL first, by bytes). ``folded_root`` starts from the leaf of
    the tampered row and ``verified`` says whether it still meets ``root``. Repeated rows are leaves
    of their own; NULL and empty texts have different leaves; other columns are ignored. A lone row
    is its own root, with an empty proof. An empty table gives an empty result.
    """
    record = [F.col(c) for c in RECORD]
    forged = [*record[:-1], tampered_text(record[0], record[-1])]
    rows = docs.select("lang", "doc_id", leaf(*record).alias("leaf"), leaf(*forged).alias("tampered"))
    rows = materialise(rows, "merkle-leaves")
    langs = build(rows, "lang", ["doc_id", "leaf"], "leaf", ["doc_id", "tampered"])
    subroots = materialise(langs.roots, "merkle-roots").select(
        F.lit(0).alias("all"), F.col("group").alias("lang"), F.col("digest").alias("subroot")
    )
    whole = build(subroots, "all", ["lang"], "subroot", ["lang"])
    nothing = whole.roots.select("group", F.array().cast(STEPS).alias("steps"))
    tops = proofs(whole, nothing).select(F.col("lang").alias("group"), "digest", "steps")
    tops = materialise(tops, "merkle-tops")
    root = whole.roots.first()
    of_lang = tops.select(F.col("group").alias("_lang"), F.col("digest").alias("subroot"))
    found = proofs(langs, tops.select("group", "steps"))
    found = found.join(of_lang, F.col("group").eqNullSafe(F.col("_lang")))
    found = found.withColumn("root", F.lit(root and root["digest"]).cast("string"))
    return found.select(
        "doc_id",
        F.col("group").alias("lang"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.col("tampered"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
