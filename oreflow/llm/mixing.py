"""Mixing sources to target weights: pivotal dependent rounding over a distributed reduction tree."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import words_of
from oreflow.session import materialise

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
FAN_IN = 64
KEY = ["source", "doc_id", "size"]

_ITEM = "struct<size:bigint,doc_id:bigint,rows:bigint,whole:bigint,mass:double>"
_DONE = "struct<size:bigint,doc_id:bigint,rows:bigint,copies:bigint>"
_STATE = f"struct<left:{_ITEM},done:array<{_DONE}>>"


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources in code point order, NULL last, have the given weights in turn. They share the total
    size by weight; a target stops at ``max_repeats`` times its source's size and the excess goes
    to the others by weight, until none is above. Each round is one aggregate that brings three
    numbers to the driver. Numbering the sources is one task over a row per source.
    """
    numbered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(numbered) - 1) % len(weights) + 1).cast("int"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialise(totals.select("source", "source_size", weight.alias("weight")), "mix-sources")
    total, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total or 0) / (all_weights or 1), 0
    limit = max_repeats * F.col("source_size")
    while True:
        above = F.col("weight") * F.lit(level) > limit
        fixed, free, now = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count_if(above),
        ).first()
        if now == capped or not free:
            break
        level, capped = (total - fixed) / free, now
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.select("source", "source_size", target.alias("target"))


def _fold(level: int) -> str:
    """SQL for one bucket's fold: ``struct(left, done)`` from its sorted items.

    ``mass`` is an item's open probability times its size. Two open items meet: mass flows one way
    or the other, at random with the odds that keep both expectations, until one of them is whole
    or empty. That one is done; the other goes on with what the two had together.
    """
    full = "named_struct('size', {0}.size, 'doc_id', {0}.doc_id, 'rows', {0}.rows, 'copies', {0}.whole + 1)"
    void = "named_struct('size', {0}.size, 'doc_id', {0}.doc_id, 'rows', {0}.rows, 'copies', {0}.whole)"
    rest = "named_struct('size', {0}.size, 'doc_id', {0}.doc_id, 'rows', {0}.rows, 'whole', {0}.whole, 'mass', {1})"
    a, b = "s.left", "b"
    state = "named_struct('left', {0}, 'done', array_append(s.done, {1}))"
    to_a, to_b = "least(s.left.size - s.left.mass, b.mass)", "least(s.left.mass, b.size - b.mass)"
    draw = (
        f"(pmod(xxhash64('mix', {level}, s.left.doc_id, s.left.size, b.doc_id, b.size), 9007199254740992)"
        " / 9007199254740992D)"
    )
    step = f"""
      CASE WHEN s.left IS NULL THEN named_struct('left', b, 'done', s.done)
           WHEN {draw} * ({to_a} + {to_b}) < {to_b} THEN
             CASE WHEN s.left.size - s.left.mass <= b.mass
                  THEN {state.format(rest.format(b, "b.mass - (s.left.size - s.left.mass)"), full.format(a))}
                  ELSE {state.format(rest.format(a, "s.left.mass + b.mass"), void.format(b))} END
           ELSE
             CASE WHEN s.left.mass <= b.size - b.mass
                  THEN {state.format(rest.format(b, "b.mass + s.left.mass"), void.format(a))}
                  ELSE {state.format(rest.format(a, "s.left.mass - (b.size - b.mass)"), full.format(b))} END
      END"""
    start = f"CAST(named_struct('left', null, 'done', array()) AS {_STATE})"
    return f"aggregate(items, {start}, (s, b) -> CAST({step} AS {_STATE}))"


def _round_items(items: DataFrame, fan_in: int, label: str) -> DataFrame:
    """Whole copies for items ``source, doc_id, size, rows, expected``."""
    whole = (
        items.withColumn("whole", F.floor("expected"))
        .withColumn("mass", (F.col("expected") - F.col("whole")) * F.col("size"))
        .select(*KEY, "rows", "whole", "mass")
    )
    whole = materialise(whole, f"mix-{label}")
    closed = whole.filter("mass = 0").select(*KEY, "rows", F.col("whole").alias("copies"))
    counts = materialise(whole.filter("mass > 0").groupBy("source").agg(F.count("*").alias("n")), f"mix-{label}-n")
    width = counts.agg(F.max("n")).first()[0]
    if width is None:
        return closed
    spot = F.pmod(F.xxhash64("doc_id", "size", F.lit("bucket")), F.lit(2**62))
    still = _with_source(whole.filter("mass > 0"), counts).withColumn("spot", spot)
    results, level = [closed], 0
    item = F.struct("size", "doc_id", "rows", "whole", "mass")
    while True:
        level, width = level + 1, -(-width // fan_in)
        buckets = F.ceil(F.col("n") / F.lit(fan_in**level))
        folded = (
            still.withColumn("spot", F.pmod("spot", buckets))
            .groupBy("source", "spot", "n")
            .agg(F.sort_array(F.collect_list(item)).alias("items"))
            .select("source", "spot", "n", F.expr(_fold(level)).alias("state"))
            .select("source", "spot", "n", "state.*")
        )
        folded = materialise(folded, f"mix-{label}-{level}")
        done = folded.select("source", F.explode("done").alias("d"))
        results.append(done.select("source", "d.doc_id", "d.size", "d.rows", "d.copies"))
        still = folded.select("source", "spot", "n", "left.*")
        if width <= 1:
            break
    last = F.col("whole") + (2 * F.col("mass") >= F.col("size")).cast("bigint")
    results.append(still.select(*KEY, "rows", last.alias("copies")))
    return reduce(DataFrame.unionByName, results)


def _with_source(df: DataFrame, per_source: DataFrame) -> DataFrame:
    """Joins a row per source; NULL is a source of its own."""
    right = per_source.withColumnRenamed("source", "_source")
    return df.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix(
    sized: DataFrame, targets: DataFrame, fan_in: int = FAN_IN, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """How often the mix takes each document: ``source, doc_id, size, rows, copies``.

    ``sized`` has ``source, doc_id, size``; rows equal in all three are one item of ``rows`` rows,
    which share its copies. An item expects ``rows * target / source_size`` copies; the whole part
    is certain, the rest is rounded. Items of a source are dealt to buckets of about ``fan_in`` by a
    hash, so a hot source is many buckets; each bucket leaves at most one open item, and the open
    items of ``fan_in`` buckets meet on the next level, until one per source is left. It has no
    partner and is rounded to the nearer side.

    What that adds or takes is at most half a document. To make it a short one, the documents
    above their source's mean size are rounded first, and the others expect what is then left of
    the target. Every draw is a hash of the documents that meet, so reruns agree. A document
    without words is never taken. An empty table gives an empty result.
    """
    items = materialise(sized.groupBy(*KEY).agg(F.count("*").alias("rows")), "mix-items")
    words = F.col("rows") * F.col("size")
    rows = items.groupBy("source").agg(F.sum("rows").alias("_n"))
    sources = _with_source(rows, targets).withColumn("_mean", F.col("source_size") / F.col("_n"))
    large = F.col("size") > F.col("_mean")
    whole = _with_source(items, materialise(sources, "mix-means"))
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    first = whole.filter(large).withColumn("expected", F.col("rows") * ratio)
    first = materialise(_round_items(first, fan_in, "large"), "mix-large-all")
    taken = first.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("_taken"))
    small = whole.filter(~large)
    open_words = small.groupBy("source").agg(
        F.sum(words).alias("_open"), F.first("target").alias("_target")
    )
    right = taken.withColumnRenamed("source", "_source")
    rest = open_words.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    left_over = F.try_divide(F.col("_target") - F.coalesce("_taken", F.lit(0)), "_open")
    rest = rest.select("source", F.greatest(F.lit(0.0), F.least(left_over, F.lit(max_repeats))).alias("_ratio"))
    second = _with_source(small, materialise(rest, "mix-rest"))
    second = second.withColumn("expected", F.when(F.col("size") > 0, F.col("rows") * F.col("_ratio")).otherwise(0.0))
    return first.unionByName(_round_items(second, fan_in, "small"))


def share_rows(copies: Column, rows: Column, number: Column) -> Column:
    """What the row with this number (from 0) gets of the copies of equal rows."""
    return F.floor(copies / rows) + (number < copies % rows).cast("bigint")


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per document row: ``doc_id, size, source_size, target, taken``."""
    sized = materialise(docs.select("source", "doc_id", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = materialise(source_targets(sized), "mix-targets")
    dealt = mix(sized, targets).withColumn("_n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
    return _with_source(dealt, targets).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (share_rows(F.col("copies"), F.col("rows"), F.col("_n")) * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with all its columns.

    Equal rows in source, doc_id and size share their copies in the order of their text's hash.
    """
    names = docs.columns
    sized = docs.withColumn("_size", word_count(F.col("text")))
    small = materialise(sized.select("source", "doc_id", F.col("_size").alias("size")), "mix-sizes")
    dealt = mix(small, materialise(source_targets(small), "mix-targets"))
    dealt = dealt.select(*[F.col(c).alias(f"_{c}") for c in dealt.columns]).filter("_copies > 0")
    sized = sized.withColumnRenamed("_size", "_words")
    same = (
        F.col("source").eqNullSafe(F.col("_source"))
        & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("_words") == F.col("_size"))
    )
    number = F.row_number().over(Window.partitionBy("_source", "_doc_id", "_size").orderBy(F.xxhash64("text"))) - 1
    times = share_rows(F.col("_copies"), F.col("_rows"), number)
    return (
        sized.join(dealt, same)
        .withColumn("_times", times)
        .filter("_times > 0")
        .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
        .select(*names)
    )
