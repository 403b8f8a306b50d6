"""Row rules, metrics, controls, gates and monitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators import monitors
from oreflow.operators.joins import join_loss, require_lossless
from oreflow.operators.quality import (
    FAIL,
    Rule,
    apply_rules,
    flag_rules,
    gate,
    latest_quality,
    measure_rules,
    quality_log,
)
from oreflow.plans import validation
from oreflow.plans.fraud import TX_RULES, refine_transactions
from oreflow.plans.sales import SALES_RULES, refine_sales
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import sql

BAD_ROWS = 500
# What the file controls expect of the given tables.
SALES_CONTROL = {"min_rows": 1000, "countries": 5, "min_months": 22}
TX_CONTROL = {"min_rows": 500, "min_categories": 5}


def _judged_sales(t: Layers):
    return refine_sales(t.unique_sales(), t.products())


def _judged_tx(t: Layers):
    return refine_transactions(t.labelled_transactions(), t.customers())


def _bad_batch(t: Layers):
    """Discards per rule before and after 500 invalid sales arrive; they must rise by 500."""
    good = _judged_sales(t)
    first = good.agg(F.min("sold_at")).scalar()
    bad = t.spark.range(BAD_ROWS).select(
        F.concat(F.lit("BAD"), F.col("id")).alias("sale_id"),
        first.alias("sold_at"),
        F.lit(0).cast("bigint").alias("quantity"),
        F.lit(0).cast("decimal(18,2)").alias("amount"),
    )
    after = good.unionByName(bad, allowMissingColumns=True)
    before = measure_rules(good, SALES_RULES, "silver_sales").select("rule", F.col("failed").alias("failed_before"))
    return (
        measure_rules(after, SALES_RULES, "silver_sales")
        .select("rule", F.col("failed").alias("failed_after"))
        .join(before, "rule")
        .withColumn("rise", F.col("failed_after") - F.col("failed_before"))
    )


def _log(t: Layers):
    """One metrics row per rule and day, logged at that day."""
    tx = _judged_tx(t).withColumn("logged_at", F.to_date("occurred_at"))
    return latest_quality(quality_log(measure_rules(tx, TX_RULES, "silver_transactions", ["logged_at"])))


def _loss(t: Layers):
    loss = require_lossless(join_loss(t.sales().select("product_id"), t.products(), "product_id"))
    return loss.withColumn("ok", F.col("rows_after") >= F.col("rows_before") * F.lit(0.99))


def _validate_retail(t: Layers):
    silver = t.stored_silver()
    return gate(validation.validate_retail(t.daily(silver), t.status(silver)))


def _completeness(t: Layers):
    counts = monitors.daily_counts(t.events, F.to_date("ts"), ["event_type"])
    return monitors.completeness(counts, ["event_type"], history=14, width=2.0).select(
        "event_type",
        "day",
        "rows",
        F.round("expected", 4).alias("expected"),
        F.round("spread", 4).alias("spread"),
        "anomaly",
    )


def _weekly(t: Layers):
    counts = monitors.daily_counts(t.events, F.to_date("ts"), ["event_type"])
    return monitors.weekly_completeness(counts, ["event_type"], weeks=6, width=2.0).select(
        "event_type", "day", "rows", F.round("expected", 4).alias("expected"), F.round("spread", 4).alias("spread"), "anomaly"
    )


def _null_rates(t: Layers):
    tx = t.transactions().withColumn("day", F.to_date(F.substring("occurred_at", 1, 10)))
    rates = monitors.null_rates(tx, F.col("day"), ["device_id", "card_number", "amount"])
    return monitors.null_rate_anomalies(rates).select(
        "day",
        "column_name",
        "rows",
        "nulls",
        F.round("null_rate", 6).alias("null_rate"),
        F.round("usual_rate", 6).alias("usual_rate"),
        "anomaly",
    )


def _freshness(t: Layers):
    """Loads are the hours in which an event type arrived."""
    hour = F.unix_date(F.to_date("ts")) * 86400 + F.hour("ts") * 3600
    loads = t.events.select("event_type", hour.cast("bigint").alias("loaded_at")).distinct()
    late = monitors.freshness(loads, ["event_type"]).filter("late")
    return late.groupBy("event_type", "median_gap", "mad").agg(
        F.count("*").alias("late_loads"), F.max("gap").alias("longest_gap")
    )


QUERIES = {
    "expect_warn": query(
        lambda t: flag_rules(_judged_tx(t), TX_RULES)
        .groupBy("currency_known", "amount_reasonable", "amount_positive")
        .agg(F.count("*").alias("rows"))
    ),
    "expect_drop": query(
        lambda t: apply_rules(_judged_sales(t), SALES_RULES).agg(
            F.count("*").alias("rows"), F.sum("amount").alias("amount"), F.min("quantity").alias("least_quantity")
        )
    ),
    "expect_fail": query(
        lambda t: apply_rules(_judged_sales(t), [Rule("id_present", "sale_id IS NOT NULL", FAIL)]).agg(
            F.count("*").alias("rows")
        )
    ),
    "quality_metrics": query(
        lambda t: measure_rules(_judged_sales(t), SALES_RULES, "silver_sales").unionAll(
            measure_rules(_judged_tx(t), TX_RULES, "silver_transactions")
        )
    ),
    "quality_log_latest": query(_log),
    "bad_batch_delta": query(_bad_batch),
    "lossless_join_guard": query(_loss),
    "file_control_sales": query(lambda t: validation.file_control_sales(t.sales(), **SALES_CONTROL)),
    "file_control_tx": query(lambda t: validation.file_control_transactions(t.labelled_transactions(), **TX_CONTROL)),
    "validate_retail": query(_validate_retail),
    "validate_fraud": query(lambda t: gate(validation.validate_fraud(t.risk()))),
    "completeness_anomaly": query(_completeness),
    "weekly_completeness": query(_weekly),
    "null_rate_anomaly": query(_null_rates),
    "freshness_anomaly": query(_freshness),
}

_PREDICATES = {
    "refined": [(r.name, r.predicate, r.action) for r in SALES_RULES],
    "tx_refined": [(r.name, r.predicate, r.action) for r in TX_RULES],
}


def _metric_sql(source: str, dataset: str) -> str:
    return " union all ".join(
        f"""select '{dataset}' as dataset, '{name}' as rule, '{action}' as action,
        count_if(coalesce({predicate}, false))::bigint as passed,
        count_if(not coalesce({predicate}, false))::bigint as failed from {source}"""
        for name, predicate, action in _PREDICATES[source]
    )


def _check(name: str, value: str, ok: str, source: str) -> str:
    return f"select '{name}' as \"check\", ({value})::double as value, ({ok}) as ok from {source}"


SQL = {
    "expect_warn": sql(
        """select currency in ('COP','USD') as currency_known, amount < 1000000 as amount_reasonable,
        amount > 0 as amount_positive, count(*) as rows from tx_refined group by 1, 2, 3""",
        "tx_refined",
    ),
    "expect_drop": sql(
        "select count(*) as rows, sum(amount)::double as amount, min(quantity) as least_quantity from silver", "silver"
    ),
    "expect_fail": sql("select count(*) as rows from refined where sale_id is not null", "refined"),
    "quality_metrics": sql(
        _metric_sql("refined", "silver_sales") + " union all " + _metric_sql("tx_refined", "silver_transactions"),
        "refined",
        "tx_refined",
    ),
    "quality_log_latest": sql(
        "select * from ("
        + " union all ".join(
            f"""select occurred_at::date as logged_at, '{name}' as rule, 'silver_transactions' as dataset,
            count_if(coalesce({predicate}, false))::bigint as passed,
            count_if(not coalesce({predicate}, false))::bigint as failed from tx_refined group by 1"""
            for name, predicate, _ in _PREDICATES["tx_refined"]
        )
        + ") order by logged_at desc, rule limit 5",
        "tx_refined",
    ),
    "bad_batch_delta": sql(
        " union all ".join(
            f"""select '{name}' as rule, count_if(not coalesce({predicate}, false))::bigint as failed_before,
            count_if(not coalesce({predicate}, false))::bigint + {0 if name == 'id_valid' else BAD_ROWS} as failed_after,
            {0 if name == 'id_valid' else BAD_ROWS}::bigint as rise from refined"""
            for name, predicate, _ in _PREDICATES["refined"]
        ),
        "refined",
    ),
    "lossless_join_guard": sql(
        """select (select count(*) from lineitem) as rows_before, count(*) as rows_after,
        count(*) >= (select count(*) from lineitem) * 0.99 as ok from lineitem join part on l_partkey = p_partkey"""
    ),
    "file_control_sales": sql(
        " union all ".join(
            [
                _check("rows", "n", "n > 1000", "c"),
                _check("null_keys", "nulls", "nulls = 0", "c"),
                _check("invalid_share", "invalid", "invalid between 0.01 and 0.03", "c"),
                _check("countries", "countries", "countries = 5", "c"),
                _check("months", "months", "months >= 22", "c"),
            ]
        ),
        "sales",
        c="""select count(*) as n, count_if(product_id is null) as nulls,
            round(count_if(quantity <= 0)::double / count(*)::double, 6) as invalid,
            count(distinct country) as countries,
            datediff('month', min(sold_at[1:10]::date), max(sold_at[1:10]::date)) as months from sales""",
    ),
    "file_control_tx": sql(
        " union all ".join(
            [
                _check("rows", "n", "n > 500", "c"),
                _check("null_keys", "nulls", "nulls = 0", "c"),
                _check("fraud_share", "frauds", "frauds between 0.01 and 0.025", "c"),
                _check("invalid_share", "invalid", "invalid between 0.01 and 0.03", "c"),
                _check("categories", "categories", "categories >= 5", "c"),
            ]
        ),
        "tx",
        c="""select count(*) as n, count_if(customer_id is null) as nulls,
            round(count_if(is_fraud)::double / count(*)::double, 6) as frauds,
            round(count_if(amount <= 0)::double / count(*)::double, 6) as invalid,
            count(distinct merchant_category) as categories from tx""",
    ),
    "validate_retail": sql(
        " union all ".join(
            [
                _check("rows_present", "n", "n > 0", "c"),
                _check("amount_positive", "amount", "amount > 0", "c"),
                _check("enough_months", "months", "months >= 12", "c"),
                _check("restock_known", "restock", "restock is not null", "c"),
            ]
        ),
        "daily",
        "status",
        c="""select count(*) as n, sum(amount) as amount,
            (select count_if(needs_restock) from status) as restock,
            round(case when day(max(day)) = day(min(day))
                    or (max(day) = last_day(max(day)) and min(day) = last_day(min(day)))
                then datediff('month', min(day), max(day))::double
                else datediff('month', min(day), max(day)) + (day(max(day)) - day(min(day))) / 31.0::double end, 8) as months
            from daily""",
    ),
    "validate_fraud": sql(
        " union all ".join(
            [
                _check("rows_present", "n", "n > 0", "c"),
                _check("frauds_present", "frauds", "frauds > 0", "c"),
                _check("rate_in_range", "rate", "rate between 0.005 and 0.05", "c"),
            ]
        ),
        "risk_daily",
        c="""select count(*) as n, sum(frauds) as frauds,
            round(sum(frauds)::double / sum(transactions)::double, 6) as rate from risk_daily""",
    ),
    "completeness_anomaly": sql(
        """select event_type, day, rows, round(s / n, 4) as expected,
        round(sqrt((q * n - s * s) / nullif(n * (n - 1), 0)), 4) as spread,
        coalesce(n >= 7 and abs(rows - s / n) > 2.0 * sqrt((q * n - s * s) / nullif(n * (n - 1), 0)), false) as anomaly
        from (select *, (count(rows) over w)::double as n, (sum(rows) over w)::double as s,
                (sum(rows * rows) over w)::double as q
            from (select event_type, ts::date as day, count(*) as rows from events group by 1, 2)
            window w as (partition by event_type order by day rows between 14 preceding and 1 preceding))"""
    ),
    "weekly_completeness": sql(
        """select event_type, day, rows, round(expected, 4) as expected, round(spread, 4) as spread,
        coalesce(len(past) >= 3 and abs(rows - expected) > 2.0 * spread, false) as anomaly
        from (select *, greatest(list_median(list_transform(past, lambda x: abs(x - expected))) * 1.4826, expected * 0.1) as spread
            from (select *, list_median(past) as expected
                from (select *, list(rows) over (partition by event_type, dayofweek(day) order by day
                        rows between 6 preceding and 1 preceding) as past
                    from (select event_type, day::date as day, count(ts) as rows
                        from (select event_type, unnest(generate_series(min(ts::date), max(ts::date), interval 1 day)) as day
                            from events group by 1) c
                        left join (select event_type as e, ts from events) x on e = event_type and ts::date = day::date
                        group by 1, 2))))"""
    ),
    "null_rate_anomaly": sql(
        """select day, column_name, rows, nulls, round(rate, 6) as null_rate, round(usual, 6) as usual_rate,
        coalesce(n >= 7 and abs(rate - usual) > 0.05, false) as anomaly
        from (select *, nulls::double / rows::double as rate, count(*) over w as n,
                (sum(nulls) over w)::double / (sum(rows) over w)::double as usual
            from daily_nulls
            window w as (partition by column_name order by day rows between 28 preceding and 1 preceding))""",
        "tx1",
        daily_nulls=" union all ".join(
            f"""select occurred_at[1:10]::date as day, '{c}' as column_name, count(*) as rows,
            count_if({c} is null)::bigint as nulls from tx1 group by 1"""
            for c in ("device_id", "card_number", "amount")
        ),
    ),
    "freshness_anomaly": sql(
        """select event_type, median_gap, mad, count(*) as late_loads, max(gap) as longest_gap
        from spread join gaps using (event_type) join middle using (event_type)
        where gap > median_gap + 3.0 * mad group by 1, 2, 3""",
        loads="select distinct event_type, (epoch_us(ts) // 3600000000) * 3600 as loaded_at from events",
        gaps="""select * from (select event_type, loaded_at - lag(loaded_at)
            over (partition by event_type order by loaded_at) as gap from loads) where gap is not null""",
        middle="select event_type, quantile_cont(gap::double, 0.5) as median_gap from gaps group by 1",
        spread="""select event_type, quantile_cont(abs(gap - median_gap), 0.5) as mad
            from gaps join middle using (event_type) group by 1""",
    ),
}
