"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The ASCII white space that separates words: space, and code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[ \t-\r]+"


BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python a few hundred at a time.

    Spark's default of 10,000 rows a batch holds some hundred megabytes of texts in each buffer
    between the JVM and Python. A smaller setting of the session stays.
    """
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain reference inside a lambda can be inlined by the optimizer, and would then be computed
    once per array element. A lambda variable cannot.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, as an array; none for NULL and for white space only."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_PATTERN))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def count_true(flags: Column) -> Column:
    return F.size(F.filter(flags, lambda x: x)).cast("bigint")


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_bytes(spark: SparkSession, path: str) -> int:
    system, place = _folder(spark, path)
    return system.getContentSummary(place).getLength()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    system, place = _folder(spark, path)
    system.delete(place, True)


def slots_met(slots: DataFrame, bits: int) -> np.ndarray:
    """Which of ``2 ** bits`` values occur in the column ``slot``: a bitmap, whatever the rows."""
    place = F.col("slot") + 1  # bitmaps count from 1
    found = slots.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    met = np.zeros(1 << bits, bool)
    for r in found.collect():
        block = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little").astype(bool)
        met[(r["bucket"] - 1) * 32_768 :][: len(block)] = block
    return met
