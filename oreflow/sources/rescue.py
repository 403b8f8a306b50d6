"""Read JSON lines under a fixed schema and keep whatever does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def parse_with_rescue(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Typed columns, plus a JSON text of the unknown or misfit fields, or of the broken line.

    The line is parsed twice: once by the schema and once as text values per key. A key is
    rescued when the schema lacks it, or when its typed value is NULL while its text is not.
    ``lines`` may be a batch or a stream of text lines.
    """
    typed = F.from_json(text, T.StructType([*schema.fields]), {"mode": "PERMISSIVE"})
    raw = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    parsed = lines.withColumns({"_typed": typed, "_raw": raw})
    fields = [f.name for f in schema.fields]

    def misfit(key: Column, value: Column) -> Column:
        unknown = ~key.isin(*fields)
        failed = F.lit(False)
        for name in fields:
            failed = failed | ((key == name) & F.col(f"_typed.`{name}`").isNull())
        return value.isNotNull() & (unknown | failed)

    kept = F.map_filter("_raw", misfit)
    # Arrays and objects parse to NULL under a failed map: then the whole line is kept.
    rescued = F.when(F.col("_raw").isNull(), F.when(F.length(F.trim(text)) > 0, F.col(text))).when(
        F.size(kept) > 0, F.to_json(kept)
    )
    others = [c for c in lines.columns if c != text]
    return parsed.select(*[F.col(f"_typed.`{n}`").alias(n) for n in fields], rescued.alias(RESCUED), *others)
