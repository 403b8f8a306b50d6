"""Row rules, their metrics, table checks, and gates that stop a job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate that must be TRUE, and what to do with a row where it is not."""

    name: str
    predicate: str
    action: str = WARN

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


class QualityError(RuntimeError):
    """A table-level check failed."""


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Drop and fail rules, all judged on the same input rows; works on batch and stream."""
    # A filter already drops rows where the predicate is NULL; bare predicates can reach the scan.
    drops = [F.expr(rule.predicate) for rule in rules if rule.action == DROP]
    keep = reduce(lambda a, b: a & b, drops) if drops else F.lit(True)
    fails = [rule for rule in rules if rule.action == FAIL]
    # One CASE cannot be split, so a row that breaks both kinds of rule still stops the job.
    for rule in reversed(fails):
        stop = F.raise_error(F.lit(f"rule {rule.name} failed: {rule.predicate}")).cast("boolean")
        keep = F.when(~rule.passed(), stop).otherwise(keep)
    return df.filter(keep)


def flag_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep every row and add one boolean column per rule."""
    return df.withColumns({rule.name: rule.passed() for rule in rules})


def measure_rules(df: DataFrame, rules: Sequence[Rule], dataset: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (dataset, rule, action, passed, failed) from one aggregate, per ``keys`` if given."""
    counts = [F.count("*").alias("_rows")]
    counts += [F.count_if(rule.passed()).alias(f"_{i}") for i, rule in enumerate(rules)]
    summed = df.groupBy(*keys).agg(*counts)
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.action).alias("action"),
                F.col(f"_{i}").alias("passed"),
                (F.col("_rows") - F.col(f"_{i}")).alias("failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return summed.select(*keys, F.lit(dataset).alias("dataset"), F.inline(lines))


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates for ``observe``: rows, and failures per rule, as a side result of the job that writes."""
    failed = [F.count_if(~rule.passed()).alias(f"failed_{rule.name}") for rule in rules]
    return [F.count(F.lit(1)).alias("rows"), *failed]


def observe_rules(df: DataFrame, rules: Sequence[Rule], observation: Observation) -> DataFrame:
    """Count rule failures while the frame is written."""
    return df.observe(observation, *rule_counts(rules))


def check_rows(df: DataFrame, values: dict[str, Column], checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate, many checks: rows (check, value, ok).

    ``values`` are aggregates; each check is (name, value column, condition on the values).
    """
    summed = df.agg(*[c.alias(name) for name, c in values.items()])
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.col(value).cast("double").alias("value"),
                F.coalesce(ok, F.lit(False)).alias("ok"),
            )
            for name, value, ok in checks
        ]
    )
    return summed.select(F.inline(lines))


def gate(checks: DataFrame) -> DataFrame:
    """Raise when any check is false; otherwise give the checks back. One tiny collect."""
    failed = [row["check"] for row in checks.filter(~F.col("ok")).collect()]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
    return checks


def assert_columns(df: DataFrame, **types: str) -> DataFrame:
    """Fail early when a column is missing or has another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {c: (t, have.get(c)) for c, t in types.items() if have.get(c) != t}
    if wrong:
        raise QualityError(f"schema check failed: {wrong}")
    return df


def quality_log(metrics: DataFrame, event_type: str = "flow_progress") -> DataFrame:
    """Rule metrics as log rows with a VARIANT detail column."""
    detail = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.array(F.struct("rule", "dataset", "passed", "failed")).alias("expectations")
                ).alias("data_quality")
            ).alias("flow_progress")
        )
    )
    return metrics.withColumn("event_type", F.lit(event_type)).withColumn("details", F.parse_json(detail))


def latest_quality(log: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` quality entries of the log, read by path from the detail column."""
    base = "$.flow_progress.data_quality.expectations[0]."
    return (
        log.filter(F.col("event_type") == "flow_progress")
        .select(
            "logged_at",
            F.variant_get("details", base + "rule", "string").alias("rule"),
            F.variant_get("details", base + "dataset", "string").alias("dataset"),
            F.variant_get("details", base + "passed", "bigint").alias("passed"),
            F.variant_get("details", base + "failed", "bigint").alias("failed"),
        )
        .orderBy(F.desc("logged_at"), "rule")
        .limit(n)
    )
