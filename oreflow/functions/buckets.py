"""Portable hash buckets and hash-driven draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 from the first 32 bits of md5: the same number on any engine."""
    head = F.substring(F.md5(key), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(n)


def key_text(*parts: Column | str) -> Column:
    """Concatenate the parts as text; strings stand for themselves."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def weighted_draw(key: Column, weights: Sequence[tuple[str, int]]) -> Column:
    """Draw a label per row with the given integer weights, by hash bucket."""
    urn = F.array(*[F.lit(label) for label, times in weights for _ in range(times)])
    size = sum(times for _, times in weights)
    return F.element_at(urn, (bucket(key, size) + 1).cast("int"))


def flag_share(key: Column, per_thousand: int) -> Column:
    """True for a stable share of rows, given in thousandths."""
    return bucket(key, 1000) < per_thousand
