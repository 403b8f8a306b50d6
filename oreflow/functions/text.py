"""String helpers used by ids, names, file paths and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The visible form of a masked card number.
CARD_MASK_PREFIX = "****-****-****-"


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` plus the number, zero-padded to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def title_from_code(code: Column) -> Column:
    """``home_office`` becomes ``Home Office``."""
    return F.initcap(F.regexp_replace(code, "_", " "))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)$", 1)


def keep_last_four(value: Column) -> Column:
    return F.concat(F.lit(CARD_MASK_PREFIX), F.substring(value, -4, 4))
