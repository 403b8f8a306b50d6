"""Row scores from weighted rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_score(rules: Iterable[tuple[str, float]], scale: int) -> Column:
    """The points of every rule (a SQL predicate) that is TRUE, added up in whole units of 1 / scale."""
    total = F.lit(0).cast("bigint")
    for predicate, points in rules:
        total = total + F.when(F.expr(predicate), round(points * scale)).otherwise(0)
    return total
