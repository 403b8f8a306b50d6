"""A table dealt to hash buckets of its keys, of which a micro-batch replaces only those it touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.session import scratch_scope

BUCKETS = 64
BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketedTable:
    """Rows under ``path/rows``, one folder per bucket of ``keys``.

    ``buckets`` belongs to the table: choose it once, so that a bucket is a few files. It bounds what
    the driver learns of a batch, the numbers of the buckets that it touches.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int = BUCKETS

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def staged_path(self) -> str:
        # A leading underscore hides it from readers of ``path``.
        return f"{self.path}/_staged"

    def place(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, path: str) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            return self.spark.read.schema(stored).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], stored)

    def read(self) -> DataFrame:
        return self._read(self.rows_path).drop(BUCKET)

    def touched(self, batch: DataFrame) -> list[int]:
        return sorted(r[0] for r in batch.select(self.place()).distinct().collect())

    def read_buckets(self, numbers: Sequence[int]) -> DataFrame:
        """The rows of some buckets; the others' files are not opened."""
        return self._read(self.rows_path).filter(F.col(BUCKET).isin(list(numbers))).drop(BUCKET)

    def replace(self, batch_id: int, make: Callable[[], DataFrame]) -> None:
        """Replace the buckets that occur in ``make()`` by its rows, once per batch.

        The rows are staged whole before any bucket is touched. A batch that is replayed after a
        crash in between finds them and does not read the half-replaced table; a batch that is
        replayed after its end replaces its buckets by the same rows.
        """
        staged = f"{self.staged_path}/batch={batch_id}"
        if not self._is_complete(staged):
            rows = make().select(*self.schema.fieldNames()).withColumn(BUCKET, self.place())
            # Each bucket goes to one task, or to more if it is large.
            rows.hint("rebalance", BUCKET).write.mode("overwrite").parquet(staged)
        (
            self._read(staged)
            .hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.rows_path)
        )
        self._delete(f"{self.staged_path}/batch={batch_id - 1}")

    def _file_system(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _is_complete(self, path: str) -> bool:
        system, place = self._file_system(f"{path}/_SUCCESS")
        return system.exists(place)

    def _delete(self, path: str) -> None:
        system, place = self._file_system(path)
        system.delete(place, True)


def drain_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch that is due to ``apply``, then stop."""

    def scoped(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            apply(batch, batch_id)

    query = stream.writeStream.foreachBatch(scoped).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
