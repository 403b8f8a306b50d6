"""Remember an inferred schema, and decide what to do when the source changes."""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.sources.headers import (
    BROKEN,
    FILE,
    NAMES,
    VALUES,
    lines_options,
    listed_files,
    read_headers,
    split_lines,
)

ADD_NEW, ADD_NEW_WIDEN, RESCUE, FAIL_ON_NEW, IGNORE = (
    "add_new_columns",
    "add_new_columns_with_widening",
    "rescue",
    "fail_on_new_columns",
    "none",
)

# Each numeric type may widen to the ones after it.
WIDENING = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType())


class SchemaChanged(RuntimeError):
    """The source has columns that the saved schema lacks. The merged schema is already saved."""


class NewColumnsError(RuntimeError):
    """The source has new columns and the policy is to fail until someone updates the schema."""


def plain_type(kind: T.DataType) -> T.DataType:
    """The column type for a type that variants were found to have; what varies or is unknown is text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType))
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def _infer_json(spark: SparkSession, paths: list[str]) -> T.StructType:
    """One aggregate over the lines as variants; broken lines and those that hold no object don't count."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    objects = lines.filter(F.ltrim("value").startswith("{")).select(F.try_parse_json("value").alias("v"))
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    # Only outside quoted names.
    parts = re.split("(`(?:[^`]|``)*`)", found)
    text = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))
    kind = plain_type(T.DataType.fromDDL(text))
    return kind if isinstance(kind, T.StructType) else T.StructType([])


# How a text must look to be of a type, the narrowest first.
CSV_TYPES = (
    (T.BooleanType(), "(?i)true|false"),
    (T.IntegerType(), r"[+-]?\d+"),
    (T.LongType(), r"[+-]?\d+"),
    (T.DoubleType(), r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"),
    (T.DateType(), r"\d{4}-\d{2}-\d{2}"),
    (T.TimestampType(), r"\d{4}-\d{2}-\d{2}.*"),
)


def _infer_csv(spark: SparkSession, paths: list[str]) -> T.StructType:
    """Columns by the names in all headers, in the order of the files; types by one aggregate."""
    headers = read_headers(spark, listed_files(spark, paths))
    orders = headers.groupBy(NAMES).agg(F.min(FILE).alias("first")).orderBy("first").collect()
    names = list(dict.fromkeys(n for r in orders for n in r[NAMES]))
    if not names:
        return T.StructType([])
    lines = lines_options(spark.read).option("recursiveFileLookup", True).load(paths)
    rows = split_lines(lines.select("*", F.col("_metadata.file_path").alias(FILE)), headers)
    cells = rows.filter(F.col(BROKEN).isNull()).select(F.map_from_arrays(NAMES, VALUES).alias("cells"))
    fits = []
    for i, name in enumerate(names):
        value = F.try_element_at("cells", F.lit(name))
        fits.append(F.count(value).alias(f"n{i}"))
        for j, (kind, look) in enumerate(CSV_TYPES):
            sound = value.rlike(f"^({look})$") & value.try_cast(kind).isNotNull()
            fits.append(F.every(value.isNull() | sound).alias(f"t{i}_{j}"))
    found = cells.agg(*fits).first()
    fields = []
    for i, name in enumerate(names):
        kinds = [kind for j, (kind, _) in enumerate(CSV_TYPES) if found[f"n{i}"] and found[f"t{i}_{j}"]]
        fields.append(T.StructField(name, kinds[0] if kinds else T.StringType()))
    return T.StructType(fields)


def infer_schema(spark: SparkSession, path: str | list[str], fmt: str) -> T.StructType:
    """The schema of the files under a folder, or of a list of files, by one pass over them."""
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "json":
        return _infer_json(spark, paths)
    if fmt == "csv":
        return _infer_csv(spark, paths)
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    return reader.option("mergeSchema", True).load(paths).schema


def _new_files(spark: SparkSession, path: str, location: str) -> DataFrame:
    """Files under ``path`` that no start has seen; they are listed, not opened."""
    try:
        seen = spark.read.schema(f"{FILE} string").parquet(f"{location}-files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return listed_files(spark, path)
    return listed_files(spark, path).join(seen, FILE, "left_anti")


def _readable(file: str) -> str:
    """A listed name as a path for a reader, which expands patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    try:
        lines = spark.read.text(location).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return T.StructType.fromJson(json.loads("".join(row["value"] for row in lines))) if lines else None


def remembered_schema(
    spark: SparkSession, path: str, fmt: str, location: str, hints: dict[str, str] | None = None
) -> T.StructType:
    """The saved schema, or one inferred now and saved for every later run."""
    saved = load_schema(spark, location)
    if saved is not None:
        return saved
    schema = apply_hints(infer_schema(spark, path, fmt), hints or {})
    save_schema(spark, schema, location)
    return schema


def apply_hints(schema: T.StructType, hints: dict[str, str]) -> T.StructType:
    hinted = {name: T.StructType.fromDDL(f"`{name}` {ddl}")[name].dataType for name, ddl in hints.items()}
    return T.StructType(
        [T.StructField(f.name, hinted.get(f.name, f.dataType), True, f.metadata) for f in schema.fields]
    )


def wider_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds both, or None when they do not fit together."""
    if old == new:
        return old
    if old in WIDENING and new in WIDENING:
        return WIDENING[max(WIDENING.index(old), WIDENING.index(new))]
    return None


def merge_schemas(saved: T.StructType, found: T.StructType, widen: bool = False) -> T.StructType:
    """Saved columns first and in order, then new ones; types change only by widening."""
    seen = {f.name: f.dataType for f in found.fields}
    merged = []
    for f in saved.fields:
        wider = wider_type(f.dataType, seen[f.name]) if widen and f.name in seen else None
        merged.append(T.StructField(f.name, wider or f.dataType, True, f.metadata))
    known = set(saved.fieldNames())
    merged += [T.StructField(f.name, f.dataType, True) for f in found.fields if f.name not in known]
    return T.StructType(merged)


def evolve(
    spark: SparkSession, path: str, fmt: str, location: str, mode: str = ADD_NEW, found: T.StructType | None = None
) -> T.StructType:
    """The schema to start a stream with, under an evolution policy.

    Only files that earlier starts have not seen are opened, and what they hold is merged into the
    saved schema; a start without new files opens none. ``add_new_columns`` saves the merged schema
    and raises once, so that the caller notices and restarts; the next start runs with the new
    columns from the same checkpoint. ``fail_on_new_columns`` raises until the saved schema has them.
    """
    saved = load_schema(spark, location)
    fresh = None
    if found is None:
        fresh = [r[0] for r in _new_files(spark, path, location).collect()]
        if not fresh and saved is not None:
            return saved
        found = infer_schema(spark, [_readable(f) for f in fresh] if saved is not None else path, fmt)

    def remember() -> None:
        if fresh:
            spark.createDataFrame([(f,) for f in fresh], f"{FILE} string").coalesce(1).write.mode("append").parquet(f"{location}-files")

    if saved is None:
        save_schema(spark, found, location)
        remember()
        return found
    new = [f.name for f in found.fields if f.name not in saved.fieldNames()]
    if mode == FAIL_ON_NEW and new:
        raise NewColumnsError(f"new columns: {', '.join(new)}")
    if mode not in (ADD_NEW, ADD_NEW_WIDEN):
        remember()
        return saved
    merged = merge_schemas(saved, found, widen=mode == ADD_NEW_WIDEN)
    if merged != saved:
        save_schema(spark, merged, location)
    remember()
    if new:
        raise SchemaChanged(f"new columns: {', '.join(new)}; restart to read them")
    return merged


def widen_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns of a frame to the merged schema; missing ones become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
