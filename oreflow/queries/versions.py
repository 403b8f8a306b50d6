"""Versioned tables over whole transaction tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.buckets import bucket
from oreflow.operators.governance import comment, describe
from oreflow.operators.snapshots import Snapshots, VersionError, compare_versions, update_impact
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import bucket as q_bucket
from oreflow.queries.oracle import sql
from oreflow.session import scratch_dir
from oreflow.sources.files import SOURCE_FILE, scan_json, with_provenance

LIMIT = 100  # amounts above it get the discount
SAMPLE = 1000


def _rows(t: Layers) -> DataFrame:
    return t.transactions().select("tx_id", "merchant_category", "country", "amount")


def _table(t: Layers) -> Snapshots:
    return Snapshots(t.spark, scratch_dir(t.spark, "versioned"), user="analyst")


def _created(t: Layers) -> Snapshots:
    table = _table(t)
    table.write(_rows(t))
    return table


def _updated(t: Layers) -> Snapshots:
    table = _created(t)
    table.update(f"amount > {LIMIT}", amount="amount * 0.8")
    return table


def _profile(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_category").agg(
        F.count("*").alias("rows"), F.sum("amount").alias("amount"), F.max("amount").alias("largest")
    )


def _append(t: Layers):
    side = bucket(F.concat(F.col("tx_id"), F.lit("v")), 3)
    table = _table(t)
    table.write(_rows(t).filter(side == 0))
    table.append(_rows(t).filter(side == 1))
    table.append(_rows(t).filter(side == 2))
    return _profile(table.read())


def _delete(t: Layers):
    table = _updated(t)
    table.delete("country = 'US' OR amount <= 0")
    return _profile(table.read())


def _history(t: Layers):
    table = _updated(t)
    table.delete("country = 'US'")
    table.restore(0)
    return table.history().drop("committed_at")


def _by_time(t: Layers):
    table = _updated(t)
    first = table.history().agg(F.min("committed_at")).first()[0]
    try:
        table.read_at(first - timedelta(seconds=1))
    except VersionError:
        return _profile(table.read_at(first))
    raise AssertionError("a table cannot be read before it existed")


def _compare(t: Layers):
    table = _updated(t)
    return compare_versions(
        table.read(0),
        table.read(),
        rows=F.count("*"),
        above_80=F.count_if(F.col("amount") > 80),
        amount=F.sum("amount"),
    )


def _restore(t: Layers):
    table = _updated(t)
    table.delete("country <> 'CO'")
    table.restore(0)
    return _profile(table.read())


def _withdraw(t: Layers):
    """Take back the rows of one bad source file by its name."""
    source = scratch_dir(t.spark, "withdraw")
    side = bucket(F.concat(F.col("tx_id"), F.lit("f")), 4)
    rows = _rows(t)
    rows.filter(side > 0).write.json(f"{source}/good")
    rows.filter(side == 0).write.json(f"{source}/bad")
    bronze = with_provenance(scan_json(t.spark, source, rows.schema, recursive=True))
    table = _table(t)
    table.write(bronze)
    table.delete(f"{SOURCE_FILE} LIKE '%/bad/%'")
    return _profile(table.read())


def _sample(t: Layers):
    table = _table(t)
    table.write(_rows(t).orderBy("tx_id").limit(SAMPLE))
    return table.read()


def _describe(t: Layers):
    """Columns with types, comments and the number of filled values of the whole table."""
    rows = comment(t.transactions(), amount="Amount in the card's currency", card_number="Card number, personal data")
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    counts = filled.unpivot([], filled.columns, "column_name", "filled")
    return describe(rows).join(counts, "column_name")


QUERIES = {
    "versioned_create": query(lambda t: _profile(_created(t).read(0))),
    "versioned_append": query(_append),
    "versioned_update": query(lambda t: _profile(_updated(t).read())),
    "versioned_delete": query(_delete),
    "versioned_restore": query(_restore),
    "table_history": query(_history),
    "time_travel_version": query(lambda t: _profile(_updated(t).read(0))),
    "time_travel_timestamp": query(_by_time),
    "version_compare": query(_compare),
    "update_impact": query(lambda t: update_impact(t.labelled_transactions(), f"amount > {LIMIT}", "NOT is_fraud")),
    "withdraw_file": query(_withdraw),
    "ctas_sample": query(_sample),
    "limit_sample": query(lambda t: _rows(t).orderBy("tx_id").limit(10)),
    "describe_table": query(_describe),
}

_PROFILE = """select merchant_category, count(*) as rows, sum(amount)::double as amount, max(amount)::double as largest
    from v group by 1"""
_NEW = f"""select tx_id, merchant_category, country,
    case when amount > {LIMIT} then cast(amount * 0.8 as decimal(18,2)) else amount end as amount from tx1"""
_ROW = "tx_id, merchant_category, country, amount::double as amount"
_TYPES = {
    "tx_id": "string",
    "customer_id": "bigint",
    "card_number": "string",
    "merchant_category": "string",
    "country": "string",
    "currency": "string",
    "channel": "string",
    "region": "string",
    "occurred_at": "string",
    "device_id": "string",
    "amount": "decimal(18,2)",
    "value": "decimal(18,2)",
}
_COMMENTS = {"amount": "'Amount in the card''s currency'", "card_number": "'Card number, personal data'"}

SQL = {
    "versioned_create": sql(_PROFILE, "tx1", v="select * from tx1"),
    "versioned_append": sql(_PROFILE, "tx1", v="select * from tx1"),
    "versioned_update": sql(_PROFILE, "tx1", v=_NEW),
    "versioned_delete": sql(
        _PROFILE, "tx1", n=_NEW, v="select * from n where not (country = 'US' or amount <= 0)"
    ),
    "versioned_restore": sql(_PROFILE, "tx1", v="select * from tx1"),
    "table_history": sql(
        f"""select 0 as version, 'CREATE OR REPLACE' as operation, 'analyst' as user, count(*) as affected from tx1
        union all select 1, 'UPDATE', 'analyst', count(*) from tx1 where amount > {LIMIT}
        union all select 2, 'DELETE', 'analyst', count(*) from tx1 where country = 'US'
        union all select 3, 'RESTORE', 'analyst', 0""",
        "tx1",
    ),
    "time_travel_version": sql(_PROFILE, "tx1", v="select * from tx1"),
    "time_travel_timestamp": sql(_PROFILE, "tx1", v="select * from tx1"),
    "version_compare": sql(
        """select (select count(*) from tx1) as rows_old, (select count_if(amount > 80)::bigint from tx1) as above_80_old,
        (select sum(amount)::double from tx1) as amount_old, count(*) as rows_new,
        count_if(amount > 80)::bigint as above_80_new, sum(amount)::double as amount_new from v""",
        "tx1",
        v=_NEW,
    ),
    "update_impact": sql(
        f"""select count_if(amount > {LIMIT})::bigint as affected,
        count_if(amount > {LIMIT} and is_fraud)::bigint as already_equal,
        count_if(amount > {LIMIT} and not is_fraud)::bigint as really_changed from tx""",
        "tx",
    ),
    "withdraw_file": sql(
        _PROFILE, "tx1", v=f"select * from tx1 where {q_bucket("concat(tx_id, 'f')", 4)} > 0"
    ),
    "ctas_sample": sql(f"select {_ROW} from tx1 order by tx_id limit {SAMPLE}", "tx1"),
    "limit_sample": sql(f"select {_ROW} from tx1 order by tx_id limit 10", "tx1"),
    "describe_table": sql(
        " union all ".join(
            f"""select {i} as position, '{c}' as column_name, '{kind}' as data_type,
            {_COMMENTS.get(c, 'null::varchar')} as comment, count({c}) as filled from tx1"""
            for i, (c, kind) in enumerate(_TYPES.items())
        ),
        "tx1",
    ),
}
