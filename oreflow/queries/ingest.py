"""Files in, tables out: scans, incremental ingest, streaming silver, change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.buckets import bucket
from oreflow.functions.calendar import day_of
from oreflow.operators.cdc import scd1, scd2
from oreflow.operators.splits import recency_split
from oreflow.plans.fraud import SILVER_COLUMNS, TX_RULES, gold_daily_risk, refine_transactions
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import SALES_AS_OF, sql
from oreflow.queries.oracle import bucket as q_bucket
from oreflow.session import materialise, scratch_dir
from oreflow.sources import files, schemas
from oreflow.sources.catalog import dropped_after
from oreflow.sources.files import SOURCE_FILE
from oreflow.sources.rescue import RESCUED, parse_with_rescue
from oreflow.streaming.changes import current_state, history, run_scd1, run_scd2
from oreflow.streaming.gold import refresh_days
from oreflow.streaming.ingest import drain, file_stream
from oreflow.streaming.silver import run_silver

FILES, LATE_FILES = 12, 3
ORDER_SCHEMA = "o_orderkey bigint, o_orderstatus string, o_totalprice decimal(18,2), day date"


def _folder(pattern: str = "initial|late"):
    return F.regexp_extract(F.col(SOURCE_FILE), f"/({pattern})/", 1).alias("batch")


def _order_rows(t: Layers) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("day"),
    )


def _halves(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    side = bucket(F.concat(F.col(key).cast("string"), F.lit("half")), 2)
    return df.filter(side == 0), df.filter(side == 1)


_HALF = q_bucket("concat(o_orderkey, 'half')", 2)


def _totals(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("o_totalprice").alias("amount"))


# -- scans ---------------------------------------------------------------------------------------


def _json_roundtrip(t: Layers):
    path = scratch_dir(t.spark, "json")
    raw = t.transactions()
    raw.write.json(path)
    return files.scan_json(t.spark, path, raw.schema)


def _csv_roundtrip(t: Layers):
    path = scratch_dir(t.spark, "csv")
    raw = t.customers()
    raw.write.option("header", True).csv(path)
    return files.scan_csv(t.spark, path, raw.schema)


def _sql_on_files(t: Layers):
    path = scratch_dir(t.spark, "sql")
    _order_rows(t).drop("o_totalprice").write.json(path)
    return files.sql_on_files(t.spark, "json", path).groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.max("o_orderkey").alias("last_key")
    )


def _scan_table(t: Layers):
    """A table of the catalog, read by its name."""
    path = scratch_dir(t.spark, "table")
    t.customer.write.parquet(path)
    name = f"oreflow_customer_{path[-8:]}"
    with dropped_after(t.spark, name):
        t.spark.catalog.createTable(name, path=path, source="parquet")
        return materialise(t.spark.table(name), "from-table")


def _list_files(t: Layers):
    """One file per status folder, and its bytes: those of its lines, with a line end each."""
    path = scratch_dir(t.spark, "list")
    lines = t.orders.select("o_orderstatus", F.concat("o_orderkey", F.lit("-"), "o_orderpriority").alias("line"))
    lines.repartition(FILES, "o_orderstatus").write.partitionBy("o_orderstatus").text(path)
    found = files.list_files(t.spark, path, ".txt")
    return found.select(F.regexp_extract("path", "o_orderstatus=(.)", 1).alias("folder"), "bytes")


def _fanout(t: Layers):
    path = scratch_dir(t.spark, "fanout")
    files.write_fanout(_order_rows(t), path, FILES)
    back = files.with_provenance(files.scan_json(t.spark, path, ORDER_SCHEMA))
    return back.agg(F.count_distinct(SOURCE_FILE).alias("files"), F.count("*").alias("rows"), F.sum("o_totalprice").alias("amount"))


def _per_file(t: Layers):
    """One file per batch folder; the counts per file lead back to the batches."""
    path = scratch_dir(t.spark, "per-file")
    batch = bucket(F.col("o_orderkey").cast("string"), FILES)
    _order_rows(t).withColumn("batch", batch).repartition(FILES, "batch").write.partitionBy("batch").json(path)
    bronze = files.with_provenance(files.scan_json(t.spark, path, ORDER_SCHEMA, recursive=True))
    batch = F.regexp_extract(SOURCE_FILE, "batch=([0-9]+)", 1).cast("bigint").alias("batch")
    return files.rows_per_file(bronze).select(batch, "rows")


def _provenance(t: Layers):
    path = scratch_dir(t.spark, "provenance")
    initial, late = _halves(_order_rows(t), "o_orderkey")
    files.write_fanout(initial, f"{path}/initial", 3)
    late.write.json(f"{path}/late")
    bronze = files.with_provenance(files.scan_json(t.spark, path, ORDER_SCHEMA, recursive=True))
    return bronze.groupBy(_folder()).agg(
        F.count("*").alias("rows"), F.count(files.INGESTED_AT).alias("stamped"), F.sum("o_totalprice").alias("amount")
    )


def _overwrite_schema(t: Layers):
    path = scratch_dir(t.spark, "overwrite")
    files.overwrite_table(t.part.select("p_partkey", "p_size"), path)
    files.overwrite_table(t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_brand"), path)
    return t.spark.read.parquet(path)


# -- schema memory and rescue --------------------------------------------------------------------


def _schema_memory(t: Layers):
    source, saved = scratch_dir(t.spark, "memory"), scratch_dir(t.spark, "schema")
    initial, late = _halves(_order_rows(t), "o_orderkey")
    initial.write.json(f"{source}/initial")
    hints = {"o_totalprice": "decimal(18,2)", "day": "date"}
    schemas.remembered_schema(t.spark, source, "json", saved, hints)
    late.withColumn("surprise", F.lit(1)).write.json(f"{source}/late")
    again = schemas.remembered_schema(t.spark, source, "json", saved, hints)
    return _totals(files.scan_json(t.spark, source, again, recursive=True), "o_orderstatus")


def _rescue_lines(t: Layers) -> DataFrame:
    """Events as JSON lines: some with an unknown key, some with a misfit value, some broken."""
    b = bucket(F.concat(F.col("event_id").cast("string"), F.lit("z")), 1000)
    event = F.col("event_id").cast("string")
    plain = F.concat(F.lit('{"event_id":'), event, F.lit(',"user_id":'), F.col("user_id").cast("string"))
    line = (
        F.when(b < 50, F.concat(plain, F.lit(',"extra":"x'), event, F.lit('"}')))
        .when(b < 100, F.concat(plain, F.lit(',"level":"n/a"}')))
        .when(b < 150, plain)
        .otherwise(F.concat(plain, F.lit(',"level":'), b.cast("string"), F.lit("}")))
    )
    return t.events.select(line.alias("value"))


def _rescued(t: Layers):
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, level bigint")
    return parse_with_rescue(_rescue_lines(t), schema)


def _evolution(t: Layers):
    """A column appears; the first start after it stops and saves, the next one reads it."""
    source, saved = scratch_dir(t.spark, "evolve"), scratch_dir(t.spark, "schema")
    sink, checkpoint = scratch_dir(t.spark, "bronze"), scratch_dir(t.spark, "checkpoint")
    first, second = _halves(_order_rows(t).drop("o_totalprice", "day"), "o_orderkey")
    first.drop("o_orderstatus").write.json(f"{source}/initial")
    schema = schemas.evolve(t.spark, source, "json", saved)
    drain(t.spark, source, schema, sink, checkpoint)
    second.write.json(f"{source}/late")
    for _ in range(2):
        try:
            schema = schemas.evolve(t.spark, source, "json", saved)
            break
        except schemas.SchemaChanged:
            continue
    drain(t.spark, source, schema, sink, checkpoint)
    bronze = t.spark.read.option("mergeSchema", True).parquet(sink)
    return bronze.groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


def _evolution_csv(t: Layers):
    """CSV files whose columns change: another order, then one more and one less, at each start."""
    source, sink, checkpoint = _places(t, "evolve-csv")
    saved = scratch_dir(t.spark, "schema")
    third = bucket(F.concat(F.col("o_orderkey").cast("string"), F.lit("third")), 3)
    orders = materialise(_order_rows(t).withColumn("third", third), "orders")
    landings = (
        ["o_orderkey", "o_orderstatus"],
        ["o_orderstatus", "o_orderkey"],
        ["o_totalprice", "day", "o_orderkey"],
    )
    for part, columns in enumerate(landings):
        rows = orders.filter(F.col("third") == part).select(*columns)
        rows.write.option("header", True).csv(f"{source}/landing {part}")
        try:
            schema = schemas.evolve(t.spark, source, "csv", saved)
        except schemas.SchemaChanged:
            schema = schemas.evolve(t.spark, source, "csv", saved)
        drain(t.spark, source, schema, sink, checkpoint, "csv")
    bronze = t.spark.read.schema(schema.add(RESCUED, "string")).parquet(sink)
    return bronze.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "day", RESCUED)


def _widening(t: Layers):
    """``size`` starts as an int and later needs a long; both batches stay readable."""
    source, saved = scratch_dir(t.spark, "widen"), scratch_dir(t.spark, "schema")
    small = t.part.select(F.col("p_partkey").alias("part"), F.col("p_size").alias("size"))
    small.write.option("header", True).csv(f"{source}/initial")
    schemas.evolve(t.spark, source, "csv", saved)
    large = small.withColumn("size", F.col("size").cast("bigint") * 10_000_000_000)
    large.write.option("header", True).csv(f"{source}/late")
    schema = schemas.evolve(t.spark, source, "csv", saved, schemas.ADD_NEW_WIDEN)
    both = files.scan_csv(t.spark, source, schema, recursive=True, provenance=True)
    return both.groupBy(_folder()).agg(F.count("*").alias("rows"), F.sum("size").alias("total"), F.max("size").alias("largest"))


# -- incremental ingest --------------------------------------------------------------------------


def _places(t: Layers, name: str) -> tuple[str, str, str]:
    return scratch_dir(t.spark, f"{name}-source"), scratch_dir(t.spark, f"{name}-sink"), scratch_dir(t.spark, "checkpoint")


def _sales_split(t: Layers) -> tuple[DataFrame, DataFrame]:
    raw = t.sales().withColumn("day", F.to_date(F.substring("sold_at", 1, 10)))
    raw = materialise(raw.select("sale_id", "day", "quantity", "amount"), "raw-sales")
    split = recency_split(raw, "day", 0.045, t.sales_as_of())
    return split.filter("batch = 'initial'").drop("batch"), split.filter("batch = 'late'").drop("batch")


SALE_SCHEMA = "sale_id string, day date, quantity bigint, amount decimal(18,2)"


def _incremental(t: Layers) -> DataFrame:
    """Twelve files, a drain, three late files, a second drain."""
    source, sink, checkpoint = _places(t, "sales")
    initial, late = _sales_split(t)
    files.write_fanout(initial, f"{source}/initial", FILES)
    drain(t.spark, source, SALE_SCHEMA, sink, checkpoint)
    files.write_fanout(late, f"{source}/late", LATE_FILES)
    return drain(t.spark, source, SALE_SCHEMA, sink, checkpoint)


def _incremental_totals(t: Layers):
    return _incremental(t).groupBy(_folder()).agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


def _distinct_files(t: Layers):
    return _incremental(t).agg(F.count_distinct(SOURCE_FILE).alias("files"), F.count("*").alias("rows"))


def _incremental_csv(t: Layers):
    source, sink, checkpoint = _places(t, "products")
    products = t.products()
    files.write_fanout(products, source, 2, "csv")
    return drain(t.spark, source, products.schema, sink, checkpoint, "csv").drop(files.INGESTED_AT, SOURCE_FILE, RESCUED)


def _idempotent(t: Layers):
    source, sink, checkpoint = _places(t, "orders")
    initial, late = _halves(_order_rows(t), "o_orderkey")
    files.write_fanout(initial, f"{source}/initial", 4)
    counts = [drain(t.spark, source, ORDER_SCHEMA, sink, checkpoint).count() for _ in range(2)]
    late.write.json(f"{source}/late")
    counts.append(drain(t.spark, source, ORDER_SCHEMA, sink, checkpoint).count())
    return t.spark.createDataFrame(list(enumerate(counts, 1)), "run bigint, rows bigint")


def _nested(t: Layers):
    source, sink, checkpoint = _places(t, "nested")
    initial, late = _halves(_order_rows(t), "o_orderkey")
    initial.write.json(f"{source}/initial")
    late.write.json(f"{source}/initial/deeper/late")
    late.write.json(f"{source}/_hidden/late")
    bronze = drain(t.spark, source, ORDER_SCHEMA, sink, checkpoint)
    return _totals(bronze, F.regexp_extract(SOURCE_FILE, "/(initial|late)/[^/]+$", 1).alias("batch"))


def _archive(t: Layers):
    source, sink, checkpoint = _places(t, "archive")
    archive = scratch_dir(t.spark, "archived")
    initial, late = _halves(_order_rows(t), "o_orderkey")
    options = {"archive_to": archive, "recursive": False, "max_files": 1}
    files.write_fanout(initial, source, 2)
    drain(t.spark, source, ORDER_SCHEMA, sink, checkpoint, **options)
    late.repartition(2).write.mode("append").json(source)
    return _totals(drain(t.spark, source, ORDER_SCHEMA, sink, checkpoint, **options), "o_orderstatus")


def _rescued_ingest(t: Layers):
    source, sink, checkpoint = _places(t, "rescue")
    _rescue_lines(t).write.text(source)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, level bigint")
    return drain(t.spark, source, schema, sink, checkpoint).agg(
        F.count("*").alias("rows"), F.count(RESCUED).alias("rescued"), F.count("level").alias("levels")
    )


def _rescued_csv(t: Layers):
    """Columns in another order than the schema's, one unknown column, and misfit values."""
    source, sink, checkpoint = _places(t, "rescue-csv")
    size = F.when(F.col("p_size") % 10 == 0, "large").otherwise(F.col("p_size").cast("string"))
    rows = t.part.select("p_brand", size.alias("p_size"), "p_partkey", F.col("p_type").alias("surprise"))
    rows.write.option("header", True).csv(source)
    bronze = drain(t.spark, source, "p_partkey bigint, p_size int, p_brand string", sink, checkpoint, "csv")
    return bronze.select(
        "p_partkey",
        "p_size",
        "p_brand",
        F.get_json_object(RESCUED, "$.surprise").alias("surprise"),
        F.get_json_object(RESCUED, "$.p_size").alias("misfit"),
    )


def _evolution_rescue(t: Layers):
    """Under the policy ``rescue`` the schema stays, and what is new is kept as text."""
    source, sink, checkpoint = _places(t, "evolve-rescue")
    saved = scratch_dir(t.spark, "schema")
    first, second = _halves(_order_rows(t).select("o_orderkey", "o_orderstatus"), "o_orderkey")
    first.drop("o_orderstatus").write.json(f"{source}/initial")
    schema = schemas.evolve(t.spark, source, "json", saved, schemas.RESCUE)
    drain(t.spark, source, schema, sink, checkpoint)
    second.write.json(f"{source}/late")
    schema = schemas.evolve(t.spark, source, "json", saved, schemas.RESCUE)
    bronze = drain(t.spark, source, schema, sink, checkpoint)
    status = F.get_json_object(RESCUED, "$.o_orderstatus").alias("o_orderstatus")
    return bronze.groupBy(status).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


# -- streaming silver ----------------------------------------------------------------------------


def _stream_silver(t: Layers, after=None) -> str:
    """Bronze holds every transaction twice; the stream keeps one. ``after`` follows each drain."""
    bronze, silver, checkpoint = _places(t, "silver")
    metrics = scratch_dir(t.spark, "metrics")
    raw = materialise(t.labelled_transactions(), "labelled")
    customers = t.customers()
    first, second = _halves(raw, "tx_id") if after else (raw, raw)
    for part in (first, second, first) if after else (first, second):
        part.write.mode("append").parquet(bronze)
        run_silver(
            file_stream(t.spark, bronze, raw.schema, "parquet", recursive=False),
            lambda s: refine_transactions(s, customers),
            TX_RULES,
            ["tx_id"],
            silver,
            metrics,
            checkpoint,
            "silver_transactions",
            partition=("day", day_of(F.col("occurred_at"))) if after else None,
        )
        if after:
            after(silver)
    return silver


def _silver_stream(t: Layers):
    return t.spark.read.parquet(_stream_silver(t)).select(*SILVER_COLUMNS)


def _gold_refresh_days(t: Layers):
    """Two halves of the transactions and a repeated one: after each drain, gold of the touched days."""
    gold, checkpoint = scratch_dir(t.spark, "gold"), scratch_dir(t.spark, "checkpoint")

    def refresh(silver: str) -> None:
        new = file_stream(t.spark, silver, t.spark.read.parquet(silver).schema, "parquet", recursive=False)
        refresh_days(t.spark, new, gold_daily_risk, silver, gold, checkpoint)

    _stream_silver(t, refresh)
    return t.spark.read.parquet(gold)


def _gold_refresh(t: Layers):
    gold = scratch_dir(t.spark, "gold")
    files.overwrite_table(gold_daily_risk(t.spark.read.parquet(_stream_silver(t))), gold)
    return t.spark.read.parquet(gold)


# -- change feeds --------------------------------------------------------------------------------


def _changes(t: Layers) -> DataFrame:
    return t.events.select("user_id", "ts", "event_id", "event_type", "value")


def _scd1(t: Layers):
    return scd1(_changes(t), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


def _scd2(t: Layers):
    spans = scd2(_changes(t), ["user_id"], ["ts", "event_id"], ["event_type"], F.to_date("ts"))
    return spans.select("user_id", "event_type", "valid_from", "valid_to", "is_current")


EVENT_SCHEMA = "user_id bigint, ts timestamp_ntz, event_id bigint, event_type string, value double"


def _shuffled_drains(t: Layers, apply) -> None:
    """The events in three drains, dealt by hash and so out of order; the first one's files come again."""
    source, checkpoint = scratch_dir(t.spark, "feed"), scratch_dir(t.spark, "checkpoint")
    third = bucket(F.concat(F.col("event_id").cast("string"), F.lit("drain")), 3)
    changes = materialise(_changes(t).withColumn("drain", third), "changes")
    for drains in ([0], [1], [2, 0]):
        changes.filter(F.col("drain").isin(drains)).drop("drain").write.mode("append").parquet(source)
        apply(t.spark.readStream.schema(EVENT_SCHEMA).parquet(source), checkpoint)


def _scd1_stream(t: Layers):
    path, keys, sequence = scratch_dir(t.spark, "latest"), ["user_id"], ["ts", "event_id"]
    gone = F.col("event_type") == "error"
    _shuffled_drains(t, lambda stream, checkpoint: run_scd1(stream, path, keys, sequence, checkpoint, buckets=8))
    return current_state(t.spark, path, keys, T.StructType.fromDDL(EVENT_SCHEMA), gone, buckets=8)


def _scd2_stream(t: Layers):
    path, keys, sequence = scratch_dir(t.spark, "history"), ["user_id"], ["ts", "event_id"]
    _shuffled_drains(
        t,
        lambda stream, checkpoint: run_scd2(
            stream, path, keys, sequence, ["event_type"], F.to_date("ts"), checkpoint, buckets=8
        ),
    )
    spans = history(t.spark, path, keys, sequence, T.StructType.fromDDL(EVENT_SCHEMA), buckets=8)
    return spans.select("user_id", "event_type", "valid_from", "valid_to", "is_current")


QUERIES = {
    "scan_json_roundtrip": query(_json_roundtrip),
    "scan_csv_roundtrip": query(_csv_roundtrip),
    "sql_on_files": query(_sql_on_files),
    "scan_table": query(_scan_table),
    "list_source_files": query(_list_files),
    "sink_fanout": query(_fanout),
    "rows_per_file": query(_per_file),
    "provenance": query(_provenance),
    "overwrite_schema": query(_overwrite_schema),
    "schema_memory": query(_schema_memory),
    "rescued_data": query(_rescued),
    "rescued_ingest": query(_rescued_ingest),
    "ingest_rescued_csv": query(_rescued_csv),
    "schema_evolution_rescue": query(_evolution_rescue),
    "schema_evolution": query(_evolution),
    "schema_evolution_csv": query(_evolution_csv),
    "type_widening": query(_widening),
    "ingest_incremental": query(_incremental_totals),
    "distinct_files": query(_distinct_files),
    "ingest_incremental_csv": query(_incremental_csv),
    "ingest_idempotent": query(_idempotent),
    "nested_discovery": query(_nested),
    "archive_processed": query(_archive),
    "silver_stream": query(_silver_stream),
    "gold_refresh": query(_gold_refresh),
    "gold_refresh_days": query(_gold_refresh_days),
    "scd1": query(_scd1),
    "scd2": query(_scd2),
    "scd1_stream": query(_scd1_stream),
    "scd2_stream": query(_scd2_stream),
}

_SPLIT = f"""select case when age <= (select quantile_cont(age::double, 0.045) from aged) then 'late' else 'initial' end
    as batch, amount from aged"""
_AGED = f"select {SALES_AS_OF} - sold_at[1:10]::date as age, amount from sales"
_ORDER_TOTALS = """select o_orderstatus, count(*) as rows, sum(o_totalprice::decimal(18,2))::double as amount
    from orders group by 1"""
_HALF_TOTALS = f"""select case {_HALF} when 0 then 'initial' else 'late' end as batch, count(*) as rows,
    sum(o_totalprice::decimal(18,2))::double as amount"""
_LINES = f"""select event_id, user_id, b, concat('{{"event_id":', event_id, ',"user_id":', user_id) as plain
    from (select *, {q_bucket("concat(event_id, 'z')", 1000)} as b from events)"""
_TX = (
    "tx_id, customer_id, card_number, merchant_category, country, currency, channel, region, occurred_at, device_id, "
    "amount::double as amount, value::double as value"
)

SQL = {
    "scan_json_roundtrip": sql(f"select {_TX} from tx1", "tx1"),
    "scan_csv_roundtrip": sql("select * from customers", "customers"),
    "sql_on_files": sql(
        "select o_orderstatus, count(*) as rows, max(o_orderkey) as last_key from orders group by 1"
    ),
    "scan_table": sql("select * from customer"),
    "list_source_files": sql(
        """select o_orderstatus as folder, sum(strlen(concat(o_orderkey, '-', o_orderpriority)) + 1)::bigint as bytes
        from orders group by 1"""
    ),
    "sink_fanout": sql(
        f"select {FILES} as files, count(*) as rows, sum(o_totalprice::decimal(18,2))::double as amount from orders"
    ),
    "rows_per_file": sql(
        f"select {q_bucket('o_orderkey::varchar', FILES)} as batch, count(*) as rows from orders group by 1"
    ),
    "provenance": sql(
        _HALF_TOTALS.replace("count(*) as rows,", "count(*) as rows, count(*) as stamped,") + " from orders group by 1"
    ),
    "overwrite_schema": sql("select p_partkey, p_size::double as p_size, p_brand from part"),
    "schema_memory": sql(_ORDER_TOTALS),
    "rescued_data": sql(
        """select case when b < 100 or b >= 150 then event_id end as event_id,
        case when b < 100 or b >= 150 then user_id end as user_id, case when b >= 150 then b end as level,
        case when b < 50 then concat('{"extra":"x', event_id, '"}') when b < 100 then '{"level":"n/a"}'
            when b < 150 then plain end as _rescued_data from lines_z""",
        lines_z=_LINES,
    ),
    "rescued_ingest": sql(
        """select count(*) as rows, count_if(b < 150)::bigint as rescued, count_if(b >= 150)::bigint as levels
        from lines_z""",
        lines_z=_LINES,
    ),
    "ingest_rescued_csv": sql(
        """select p_partkey, case when p_size % 10 <> 0 then p_size end as p_size, p_brand, p_type as surprise,
        case when p_size % 10 = 0 then 'large' end as misfit from part"""
    ),
    "schema_evolution_rescue": sql(
        f"""select case {_HALF} when 1 then o_orderstatus end as o_orderstatus, count(*) as rows,
        sum(o_orderkey)::bigint as keys from orders group by 1"""
    ),
    "schema_evolution": sql(
        f"""select case {_HALF} when 1 then o_orderstatus end as o_orderstatus, count(*) as rows from orders group by 1"""
    ),
    "schema_evolution_csv": sql(
        f"""select o_orderkey, case when third < 2 then o_orderstatus end as o_orderstatus,
        case when third = 2 then o_totalprice::decimal(18,2)::double end as o_totalprice,
        case when third = 2 then o_orderdate::date end as day, null::varchar as _rescued_data
        from (select *, {q_bucket("concat(o_orderkey, 'third')", 3)} as third from orders)"""
    ),
    "type_widening": sql(
        """select 'initial' as batch, count(*) as rows, sum(p_size)::bigint as total, max(p_size)::bigint as largest from part
        union all select 'late', count(*), sum(p_size::bigint * 10000000000)::bigint, max(p_size::bigint * 10000000000)
        from part"""
    ),
    "ingest_incremental": sql(
        "select batch, count(*) as rows, sum(amount)::double as amount from split group by 1",
        "sales",
        aged=_AGED,
        split=_SPLIT,
    ),
    "distinct_files": sql(f"select {FILES + LATE_FILES} as files, count(*) as rows from lineitem"),
    "ingest_incremental_csv": sql(
        """select product_id, product_name, category, brand, list_price::double as list_price,
        unit_cost::double as unit_cost from products""",
        "products",
    ),
    "ingest_idempotent": sql(
        f"""select 1 as run, count(*) as rows from orders where {_HALF} = 0 union all
        select 2, count(*) from orders where {_HALF} = 0 union all select 3, count(*) from orders"""
    ),
    "nested_discovery": sql(_HALF_TOTALS + " from orders group by 1"),
    "archive_processed": sql(_ORDER_TOTALS),
    "silver_stream": sql(
        """select tx_id, customer_id, card_number, amount::double as amount, currency, merchant_category, channel,
        country, region, occurred_at, is_fraud, segment, tenure_months, credit_score from silver_tx""",
        "silver_tx",
    ),
    "gold_refresh": sql(
        """select day, region, merchant_category, transactions, total_amount, frauds, fraud_amount, fraud_rate,
        average_ticket from risk_daily""",
        "risk_daily",
    ),
    "scd1": sql(
        """select user_id, ts, event_id, event_type, value from (select *,
            row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
        where rn = 1 and event_type <> 'error'"""
    ),
    "scd2": sql(
        """select user_id, event_type, ts as valid_from,
        lead(ts) over (partition by user_id order by ts, event_id) as valid_to,
        lead(ts) over (partition by user_id order by ts, event_id) is null as is_current
        from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events)
        where before is null or before <> event_type"""
    ),
}

SQL["gold_refresh_days"] = SQL["gold_refresh"]
SQL["scd1_stream"], SQL["scd2_stream"] = SQL["scd1"], SQL["scd2"]
