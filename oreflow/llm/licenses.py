"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.llm.common import let

K = 2
BITS = 64  # a template's covered places are bits, in as many numbers as the longest template needs
MAX_TEMPLATES = 10_000
DRIFT = 2
MIN_COVERAGE = 0.8

# (label, words, base): a base phrase counts wherever its words stand one after the other.
TEMPLATES = (
    ("mit", "mit license", True),
    ("apache", "apache license", True),
    ("gpl", "general public license", True),
    ("mit", "released under the mit license", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    ("apache", "licensed under the apache license version 2 0", False),
    ("apache", "you may not use this file except in compliance with the license", False),
    ("gpl", "licensed under the gnu general public license version 3", False),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu", False),
    ("cc-by-nc", "licensed under cc by nc 4 0", False),
    ("cc-by", "creative commons attribution 4 0 international license", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    ("all-rights-reserved", "all rights reserved", False),
)


def license_words(text: Column) -> Column:
    """Words of digits, ASCII letters (lower-cased) and all characters beyond ASCII.

    ``lower`` also changes letters beyond ASCII. That can't make a word of the templates, which are
    ASCII: of those letters only the Kelvin sign becomes an ASCII one by itself, and it is replaced
    first.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ")))

    def bare(ws: Column) -> Column:
        first = F.when(F.get(ws, F.lit(0)) == "", 2).otherwise(1)
        last = F.size(ws) - F.when(F.element_at(ws, -1) == "", 1).otherwise(0)
        return F.slice(ws, first, F.greatest(F.lit(0), last - first + 1))

    return let(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), bare)


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """``template, label, base, grams, at, word, next`` for every place of every template."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; their grams are broadcast, so at most {MAX_TEMPLATES}")
    rows = []
    for number, (label, text, base) in enumerate(templates):
        words = text.split()
        if len(words) < K or not text.isascii():
            raise ValueError(f"a template has {K} or more ASCII words: {text}")
        rows += [
            (number, label, base, len(words) - 1, at, *pair) for at, pair in enumerate(zip(words, words[1:], strict=False))
        ]
    schema = "template int, label string, base boolean, grams int, at int, t_word string, t_next string"
    return spark.createDataFrame(rows, schema).withColumn("t_hash", F.xxhash64("t_word", "t_next"))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str, bool]] = TEMPLATES) -> DataFrame:
    """``doc_id`` of every row, and ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Every word pair of a text is hashed and joined to the places of the templates. Pairs vote for
    the diagonal (place in the text less place in the template) they lie on; diagonals up to
    ``DRIFT`` words apart, as an inserted or lost word leaves them, are merged; a merged span
    is a find if it covers ``MIN_COVERAGE`` of the template's pairs and is at most twice as long.
    A diagonal that covers all pairs of a base phrase is one of its places; the pairs' words are
    compared, so hashes can't mislead. ``score`` is the best coverage of any template.

    Texts are read once: each also sends a row with its number of words, which keeps documents
    without finds. A NULL text counts as empty. Rows are told apart by their id and two 64-bit hashes
    of their text, so texts that share an id, or have none, are scanned one by one, and each repeated
    row is returned. Other columns are ignored. An empty table gives an empty result.
    """
    grams = template_grams(docs.sparkSession, templates)
    numbers = max((len(words.split()) for _, words, _ in templates), default=0) // BITS + 1
    covered = [f"covered_{j}" for j in range(numbers)]
    bits = sum((F.bit_count(c) for c in covered), F.lit(0))
    grams, row = F.broadcast(grams), ["doc_id", "t1", "t2"]

    def pairs(ws: Column) -> Column:
        pair = lambda w, i: F.struct(
            i.alias("pos"),
            w.alias("word"),
            F.get(ws, i + 1).alias("next"),
            F.xxhash64(w, F.get(ws, i + 1)).alias("hash"),
        )
        none = F.lit(None)
        header = F.struct(
            F.size(ws).alias("pos"),
            none.cast("string").alias("word"),
            none.cast("string").alias("next"),
            none.cast("bigint").alias("hash"),
        )
        return F.concat(F.array(header), F.transform(ws, pair))

    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]
    exploded = docs.select("doc_id", *hashes, F.explode(let(license_words(F.col("text")), pairs)).alias("g")).select(
        *row, "g.*"
    )
    met = exploded.join(
        grams,
        (F.col("hash") == F.col("t_hash")) & (F.col("word") == F.col("t_word")) & (F.col("next") == F.col("t_next")),
        "left",
    ).filter("hash IS NULL OR template IS NOT NULL")
    header = F.col("hash").isNull()
    votes = (
        met.withColumn("diagonal", F.when(~header, F.col("pos") - F.col("at")))
        .groupBy(*row, "template", "label", "base", "grams", "diagonal")
        .agg(
            F.max(F.when(header, F.col("pos"))).alias("n_words"),
            F.count_if(header).alias("copies"),
            *[F.bit_or(F.expr(f"if(at div {BITS} = {j}, shiftleft(1L, at % {BITS}), 0L)")).alias(c) for j, c in enumerate(covered)],
            F.min("pos").alias("low"),
            (F.max("pos") + K).alias("high"),
        )
    )
    along = Window.partitionBy(*row, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT
    complete = F.col("base") & (bits == F.col("grams"))
    merged = (
        votes.withColumn("gap", F.coalesce(gap.cast("int"), F.lit(0)))
        .withColumn("span", F.sum("gap").over(along))
        .groupBy(*row, "template", "label", "base", "grams", "span")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("copies").alias("copies"),
            *[F.bit_or(c).alias(c) for c in covered],
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.count_if(complete).alias("places"),
            F.min(F.when(complete, F.col("diagonal"))).alias("first_place"),
            F.max(F.when(complete, F.col("diagonal"))).alias("last_place"),
        )
    )
    coverage = bits / F.col("grams")
    tight = F.col("high") - F.col("low") <= 2 * (F.col("grams") + 1)
    find = ((coverage >= MIN_COVERAGE) & tight & ~F.col("base")) | (F.col("places") > 0)
    score = F.when(F.col("places") > 0, F.lit(1.0)).when(tight, coverage)
    labels = lambda hit: F.array_join(F.sort_array(F.collect_set(F.when(hit, F.col("label")))), ",")
    found = merged.groupBy(*row).agg(
        F.max("copies").cast("int").alias("copies"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.sum("places").cast("bigint").alias("n_base"),
        F.min("first_place").cast("bigint").alias("first_word"),
        F.max("last_place").cast("bigint").alias("last_word"),
        labels(F.col("places") > 0).alias("base_labels"),
        labels(find).alias("labels"),
        F.coalesce(F.max(score), F.lit(0.0)).alias("score"),
    )
    columns = [c for c in found.columns if c not in (*row, "copies")]
    return found.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("doc_id", *columns)
