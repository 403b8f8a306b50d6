"""Row filters, column masks, tags, and tag-driven policies as DataFrame operators.

``secure`` only adds a filter and a projection, so the ordinary pushdown takes them to the scan.
Pipelines read unsecured frames; only consumers get a secured one, so a gold table never freezes
what one caller was allowed to see.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.text import keep_last_four

Mask = Callable[[Column], Column]


@dataclass(frozen=True)
class Identity:
    """The caller: groups, and attributes such as the countries it may see."""

    name: str
    groups: frozenset[str] = frozenset()
    attributes: dict[str, tuple[str, ...]] = field(default_factory=dict)


def mask_to_null(value: Column) -> Column:
    return F.lit(None)


def mask_card(value: Column) -> Column:
    return keep_last_four(value)


@dataclass(frozen=True)
class Policy:
    """Who sees which rows and which columns of a table."""

    row_filter: Callable[[Identity], Column] | None = None
    masks: dict[str, Mask] = field(default_factory=dict)
    unmasked_groups: frozenset[str] = frozenset()


def by_attribute(column: str, attribute: str) -> Callable[[Identity], Column]:
    """Rows whose column is one of the caller's attribute values; no values, no rows."""

    def predicate(who: Identity) -> Column:
        allowed = who.attributes.get(attribute, ())
        return F.col(column).isin(*allowed) if allowed else F.lit(False)

    return predicate


def by_group(column: str, prefix: str) -> Callable[[Identity], Column]:
    """Rows whose ``prefix + column`` names a group of the caller."""

    def predicate(who: Identity) -> Column:
        members = sorted(g[len(prefix):] for g in who.groups if g.startswith(prefix))
        return F.col(column).isin(*members) if members else F.lit(False)

    return predicate


def secure(df: DataFrame, policy: Policy, who: Identity) -> DataFrame:
    """The frame as this caller may see it."""
    if policy.row_filter is not None:
        df = df.filter(policy.row_filter(who))
    if policy.masks and not (policy.unmasked_groups & who.groups):
        types = {f.name: f.dataType for f in df.schema.fields}
        df = df.withColumns(
            {c: mask(F.col(c)).cast(types[c]) for c, mask in policy.masks.items() if c in types}
        )
    return df


TAG_SCHEMA = "table_name string, column_name string, tag_name string, tag_value string"


def tag_frame(spark: SparkSession, tags: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(tags), TAG_SCHEMA)


def find_tagged(tags: DataFrame, value: str) -> DataFrame:
    return tags.filter(F.col("tag_value") == value).select(
        "table_name", "column_name", "tag_name", "tag_value"
    )


def policy_from_tags(
    tags: DataFrame, table: str, masks: dict[str, Mask], unmasked_groups: frozenset[str] = frozenset()
) -> Policy:
    """Every column of the table that carries one of the tag values gets that value's mask.

    The tags of one table are metadata, at most a few rows per column.
    """
    rows = tags.filter((F.col("table_name") == table) & F.col("tag_value").isin(*masks)).collect()
    return Policy(masks={r["column_name"]: masks[r["tag_value"]] for r in rows}, unmasked_groups=unmasked_groups)


# What a sensitive value looks like, by class.
SENSITIVE_PATTERNS = {
    "card": r"^[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}$",
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "ip_address": r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$",
    "phone": r"^\+?[0-9]{1,3}[ -]?[0-9]{3}[ -][0-9]{3}[ -][0-9]{4}$",
}


def sensitive_scan(df: DataFrame, table: str, threshold: float = 0.8) -> DataFrame:
    """Hit rate of each class in each string column, from one aggregate pass.

    The table is never unpivoted row by row: the counts are made per column and class first.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    summed = df.agg(
        *[F.count(c).alias(f"{c}|rows") for c in columns],
        *[
            F.count_if(F.col(c).rlike(pattern)).alias(f"{c}|{kind}")
            for c in columns
            for kind, pattern in SENSITIVE_PATTERNS.items()
        ],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("kind"),
                F.col(f"`{c}|rows`").alias("filled"),
                F.col(f"`{c}|{kind}`").alias("hits"),
            )
            for c in columns
            for kind in SENSITIVE_PATTERNS
        ]
    )
    rate = F.try_divide(F.col("hits").cast("double"), F.col("filled").cast("double"))
    return summed.select(F.lit(table).alias("table_name"), F.inline(lines)).withColumn(
        "sensitive", F.coalesce(rate >= threshold, F.lit(False))
    )


def describe(df: DataFrame, comments: dict[str, str] | None = None) -> DataFrame:
    """Rows (position, column_name, data_type, comment) of a frame's schema."""
    comments = comments or {}
    rows = [
        (i, f.name, f.dataType.simpleString(), comments.get(f.name, f.metadata.get("comment")))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, comment string"
    )


def comment(df: DataFrame, **comments: str) -> DataFrame:
    """Attach column comments, kept in the schema metadata."""
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df
