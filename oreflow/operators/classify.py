"""Which columns hold sensitive values: one profile of a table, several lines of evidence per class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.governance import Mask, Policy

RATE = 0.8


def luhn(digits: Column) -> Column:
    """Whether a text of digits ends with the check digit of its others."""
    places = F.sequence(F.lit(1), F.length(digits))

    def weighed(i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda s, x: s + x) % 10 == 0


def _card_digits(v: Column) -> Column:
    return F.regexp_replace(v, "[ -]", "")


def _octets(v: Column) -> Column:
    return F.forall(F.split(v, r"\."), lambda x: x.cast("int") <= 255)


@dataclass(frozen=True)
class Sign:
    """A line of evidence: a test of a value, behind a cheap pattern that decides whether to run it."""

    name: str
    pattern: str
    check: object = None

    def met(self, value: Column) -> Column:
        shape = F.coalesce(value.rlike(self.pattern), F.lit(False))
        return shape if self.check is None else F.when(shape, self.check(value)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """A class of sensitive values: all of ``needed`` and one of ``any_of`` must hold for the column.

    ``hints`` are words of a column's name; a hint counts as a sign named ``hint``.
    """

    name: str
    signs: tuple[Sign, ...]
    needed: tuple[str, ...]
    any_of: tuple[str, ...] = ()
    hints: tuple[str, ...] = ()


# Shapes of sensitive data and words of column names.
CARD_SHAPE = "^[0-9]([ -]?[0-9]){12,18}$"
KINDS = (
    Kind(
        "card",
        (
            Sign("shape", CARD_SHAPE),
            Sign("grouped", "^[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{1,7}$"),
            Sign("checksum", CARD_SHAPE, lambda v: luhn(_card_digits(v))),
        ),
        ("shape",),
        ("grouped", "checksum"),
    ),
    Kind("email", (Sign("shape", r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"),), ("shape",)),
    Kind(
        "ip_address",
        (Sign("shape", r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", _octets),),
        ("shape",),
    ),
    Kind(
        "phone",
        (
            Sign("shape", r"^\+?[0-9][0-9 ().-]{5,17}[0-9]$"),
            Sign("prefixed", r"^\+[0-9]"),
            Sign("grouped", r"^\+?[0-9]{0,3}[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{3,4}$"),
        ),
        ("shape",),
        ("prefixed", "grouped", "hint"),
        ("phone", "mobile", "tel"),
    ),
)


def column_profile(df: DataFrame, table: str, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Rows (table_name, column_name, kind, sign, filled, hits) for all text columns: one aggregate.

    Every text value is tested once per sign, and checksums only where the shape fits. The table is
    never unpivoted row by row.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, kind string, sign string, filled bigint, hits bigint"
        )
    counts, lines = [], []
    for i, c in enumerate(columns):
        value = F.trim(F.col(f"`{c}`"))
        counts.append(F.count_if(value != "").alias(f"n{i}"))
        for kind in kinds:
            for sign in kind.signs:
                name = f"h{len(lines)}"
                counts.append(F.count_if(sign.met(value)).alias(name))
                lines.append(
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.lit(kind.name).alias("kind"),
                        F.lit(sign.name).alias("sign"),
                        F.col(f"n{i}").alias("filled"),
                        F.col(name).alias("hits"),
                    )
                )
    return df.agg(*counts).select(F.lit(table).alias("table_name"), F.inline(F.array(*lines)))


def classified(profile: DataFrame, kinds: Sequence[Kind] = KINDS, rate: float = RATE) -> DataFrame:
    """Rows (table_name, column_name, kind, filled, signs, sensitive): the signs that ``rate`` of the values show."""
    shown = F.try_divide(F.col("hits").cast("double"), F.col("filled").cast("double")) >= rate
    grouped = profile.groupBy("table_name", "column_name", "kind").agg(
        F.max("filled").alias("filled"), F.array_sort(F.collect_set(F.when(shown, F.col("sign")))).alias("signs")
    )
    # Names are metadata; the hint joins the other signs.
    words = F.split(F.regexp_replace(F.lower("column_name"), "[^a-z0-9]+", " "), " ")
    verdict = F.lit(False)
    for kind in kinds:
        has = lambda s: F.array_contains("signs", s)
        needed = reduce(lambda a, b: a & b, [has(s) for s in kind.needed])
        hint = F.arrays_overlap(words, F.array(*[F.lit(h) for h in kind.hints])) if kind.hints else F.lit(False)
        other = [hint if s == "hint" else has(s) for s in kind.any_of]
        enough = needed & reduce(lambda a, b: a | b, other) if other else needed
        verdict = F.when(F.col("kind") == kind.name, enough).otherwise(verdict)
    return grouped.withColumn("sensitive", F.coalesce(verdict, F.lit(False)))


def classify_tables(tables: Mapping[str, DataFrame], kinds: Sequence[Kind] = KINDS, rate: float = RATE) -> DataFrame:
    """The verdicts for the columns of many tables; each table is read once."""
    profiles = [column_profile(df, name, kinds) for name, df in tables.items()]
    return classified(reduce(DataFrame.unionAll, profiles), kinds, rate)


def kind_tags(verdicts: DataFrame) -> DataFrame:
    """Tags (table, column, ``kind``, class) for the sensitive columns."""
    return verdicts.filter("sensitive").select(
        "table_name", "column_name", F.lit("kind").alias("tag_name"), F.col("kind").alias("tag_value")
    )


def policies_from_tags(
    tags: DataFrame, masks: Mapping[str, Mask], unmasked_groups: frozenset[str] = frozenset()
) -> dict[str, Policy]:
    """One policy per table with a tagged column: every column so tagged, in every table, is masked.

    The tags are metadata, a few rows per column.
    """
    found: dict[str, dict[str, Mask]] = {}
    for r in tags.filter(F.col("tag_value").isin(*masks)).collect():
        found.setdefault(r["table_name"], {})[r["column_name"]] = masks[r["tag_value"]]
    return {table: Policy(masks=columns, unmasked_groups=unmasked_groups) for table, columns in found.items()}
