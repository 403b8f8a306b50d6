"""Dated copies of a table as plain parquet folders, and comparisons between them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY = "version bigint, committed_at timestamp, operation string, user string, affected bigint"


class VersionError(ValueError):
    """The asked version does not exist."""


def updated(df: DataFrame, where: str, **changes: str) -> DataFrame:
    """The frame with columns set where the predicate is TRUE; types stay."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hit = F.coalesce(F.expr(where), F.lit(False))
    return df.withColumns({c: F.when(hit, F.expr(v).cast(types[c])).otherwise(F.col(c)) for c, v in changes.items()})


def without(df: DataFrame, where: str) -> DataFrame:
    """The frame less the rows where the predicate is TRUE."""
    return df.filter(~F.coalesce(F.expr(where), F.lit(False)))


@dataclass(frozen=True)
class Snapshots:
    """Whole copies of a table, ``version=<n>`` each, and a row about each in a history table.

    Every change writes a full copy, so this is for tables of reports and reference data; large
    tables belong in a table format. One writer at a time.
    """

    spark: SparkSession
    path: str
    user: str = "unknown"

    def history(self) -> DataFrame:
        try:
            rows = self.spark.read.schema(HISTORY).json(f"{self.path}/history")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], HISTORY)
        return rows.orderBy(F.desc("version"))

    def _version(self, wanted: Column) -> int:
        found = self.history().filter(wanted).agg(F.max("version")).first()[0]
        if found is None:
            raise VersionError(f"no such version in {self.path}")
        return found

    def read(self, version: int | None = None) -> DataFrame:
        wanted = F.lit(True) if version is None else F.col("version") == version
        return self.spark.read.parquet(f"{self.path}/data/version={self._version(wanted)}")

    def read_at(self, moment: datetime) -> DataFrame:
        """The table as of a moment; an error before its first version."""
        version = self._version(F.col("committed_at") <= F.lit(moment))
        return self.spark.read.parquet(f"{self.path}/data/version={version}")

    def write(self, df: DataFrame, operation: str = "CREATE OR REPLACE", affected: int | None = None) -> int:
        """A new version with exactly these rows; all of them count as affected unless said otherwise."""
        last = self.history().agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
        folder = f"{self.path}/data/version={version}"
        df.write.mode("overwrite").parquet(folder)
        rows = self.spark.read.parquet(folder).count() if affected is None else affected
        line = self.spark.createDataFrame([(version, datetime.now(), operation, self.user, rows)], HISTORY)
        line.coalesce(1).write.mode("append").json(f"{self.path}/history")
        return version

    def append(self, df: DataFrame) -> int:
        now = self.read()
        aligned = df.select(*[F.col(f.name).cast(f.dataType) for f in now.schema.fields])
        return self.write(now.unionByName(aligned), "INSERT", aligned.count())

    def update(self, where: str, **changes: str) -> int:
        now = self.read()
        return self.write(updated(now, where, **changes), "UPDATE", now.filter(where).count())

    def delete(self, where: str) -> int:
        now = self.read()
        return self.write(without(now, where), "DELETE", now.filter(where).count())

    def restore(self, version: int) -> int:
        """A new version equal to an old one; the versions between stay."""
        return self.write(self.read(version), "RESTORE", 0)


def update_impact(df: DataFrame, where: str, changed: str) -> DataFrame:
    """One row: rows an update touches, rows that already hold the value, rows that change."""
    hit = F.coalesce(F.expr(where), F.lit(False))
    moves = F.coalesce(F.expr(changed), F.lit(False))
    return df.agg(
        F.count_if(hit).alias("affected"),
        F.count_if(hit & ~moves).alias("already_equal"),
        F.count_if(hit & moves).alias("really_changed"),
    )


def compare_versions(old: DataFrame, new: DataFrame, **measures: Column) -> DataFrame:
    """One row with every measure on both versions."""
    before = old.agg(*[c.alias(f"{m}_old") for m, c in measures.items()])
    after = new.agg(*[c.alias(f"{m}_new") for m, c in measures.items()])
    return before.select("*", *[after.select(f"{m}_new").scalar().alias(f"{m}_new") for m in measures])
