"""Card fraud: silver, gold, signals, suspicion and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.bands import age_band, risk_band
from oreflow.functions.money import cents
from oreflow.operators.metrics import auc, lift
from oreflow.operators.ordered import extreme_share, exact_quantile
from oreflow.operators.sketches import merged_sketches, quantile_sketches, rank_error, with_quantiles
from oreflow.operators.splits import stratified_split
from oreflow.plans import fraud as fr
from oreflow.plans import fraud_reports as rp
from oreflow.plans.fraud import HOME_COUNTRY, SCORE_SCALE, risk_points
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import TX_AS_OF, ratio, sql
from oreflow.queries.oracle import bucket as q_bucket
from oreflow.session import materialise

# A new customer with a low score adds points to the risk.
FRESH_MONTHS, FRESH_SCORE, FRESH_POINTS = 12, 500, 1.5

_TX = (
    "tx_id, customer_id, card_number, amount::double as amount, currency, merchant_category, channel, country, region, "
    "occurred_at, is_fraud, segment, tenure_months, credit_score"
)

SPLIT_DAY = "2024-01-16"


def _features(t: Layers):
    silver = t.stored_silver_tx()
    return fr.fraud_features(silver, t.stored_means(silver), keep=["tx_id"])


def _suspects(t: Layers):
    silver = t.stored_unlabelled_tx()
    return fr.suspicious(silver, t.stored_means(silver))


def _suspicious(t: Layers):
    high = F.col("amount").cast("double") > F.lit(3.0) * F.col("category_mean")
    return _suspects(t).groupBy("merchant_category").agg(
        F.count("*").alias("suspicious"),
        F.count_if(high).alias("high_amount"),
        F.count_if(F.col("country") != HOME_COUNTRY).alias("abroad"),
    )


def _deviation(t: Layers):
    silver = t.stored_unlabelled_tx()
    return fr.with_deviation(silver, t.stored_means(silver)).select(
        "tx_id", "merchant_category", "amount", F.round("amount_deviation", 6).alias("amount_deviation")
    )


QUANTILES = (0.5, 0.9, 0.985)


def _sketched(t: Layers):
    """Quantiles of the amount per category, from daily sketches merged over all days and over one year.

    The rows of each quantile's value are counted, and must lie within twice the sketch's rank error.
    """
    tx = t.transactions().select(
        "merchant_category", F.substring("occurred_at", 1, 10).cast("date").alias("day"), cents(F.col("amount")).alias("c")
    )
    tx = materialise(tx, "amounts")
    daily = materialise(quantile_sketches(tx, "c", ["merchant_category", "day"]), "sketches")
    out = None
    for span, kept in (("all", F.lit(True)), ("first", F.col("day") < F.lit(SPLIT_DAY))):
        found = with_quantiles(merged_sketches(daily.filter(kept), ["merchant_category"]), QUANTILES)
        rows = tx.filter(kept).join(F.broadcast(found), "merchant_category")
        ranks = rows.groupBy("merchant_category", "n", "p").agg(
            F.count("c").alias("rows"),
            (F.count_if(F.col("c") < F.col("value")) / F.count("c")).alias("below"),
            (F.count_if(F.col("c") <= F.col("value")) / F.count("c")).alias("upto"),
        )
        error = 2 * rank_error()  # twice what 99 of 100 keep
        within = (F.col("below") <= F.col("p") + error) & (F.col("upto") >= F.col("p") - error)
        facts = ranks.select(
            F.lit(span).alias("span"), "merchant_category", "p", "n", (F.col("n") == F.col("rows")).alias("whole"), within.alias("within")
        )
        out = facts if out is None else out.unionAll(facts)
    return out


def _progression(t: Layers):
    """AUC of the amount, of the amount over its category mean, and of the full rule score."""
    tx = materialise(t.labelled_transactions(), "labelled").join(t.customers().drop("region"), "customer_id", "left")
    fresh = (F.col("tenure_months") < FRESH_MONTHS) & (F.col("credit_score") < FRESH_SCORE)
    tx = tx.withColumns(
        {
            "s1": cents(F.col("value")),
            "s2": F.col("risk") - risk_points(),
            "s3": F.col("risk") + F.when(fresh, int(FRESH_POINTS * SCORE_SCALE)).otherwise(0),
        }
    )
    steps = (("amount", "s1"), ("relative_amount", "s2"), ("with_customer", "s3"))
    out = None
    for name, score in steps:
        row = auc(tx, score, F.col("is_fraud")).select(F.lit(name).alias("features"), "auc")
        out = row if out is None else out.unionAll(row)
    return out


def _lift(t: Layers):
    tx = t.labelled_transactions()
    hour = F.substring("occurred_at", 12, 2).cast("int")
    top = exact_quantile(tx.withColumn("_c", cents(F.col("value"))), "_c", 0.98)
    return lift(
        tx,
        F.col("is_fraud"),
        {
            "foreign": F.col("country") != HOME_COUNTRY,
            "night": hour.between(2, 5),
            "top_amount": cents(F.col("value")).cast("double") > F.lit(top),
            "online": F.col("channel") == "online",
            "no_device": F.col("device_id").isNull(),
        },
    )


def _threshold(t: Layers):
    quantile = exact_quantile(t.scored_transactions(), "risk", 0.985)
    return t.scored_transactions().agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("risk").cast("double") > F.lit(quantile)).alias("above"),
        F.round(F.lit(quantile), 4).alias("threshold"),
    )


def _customers_profile(t: Layers):
    return (
        t.customers()
        .groupBy("segment", "region")
        .agg(
            F.count("*").alias("customers"),
            F.round(F.sum("credit_score").cast("double") / F.count("*"), 1).alias("credit_score"),
            F.round(F.sum("tenure_months").cast("double") / F.count("*"), 1).alias("tenure_months"),
        )
        .orderBy("segment", "region")
    )


def _split(t: Layers):
    tx = stratified_split(t.labelled_transactions(), F.concat(F.col("tx_id"), F.lit("split")))
    return tx.groupBy("part", "is_fraud").agg(F.count("*").alias("rows"))


def _risk_bands(t: Layers):
    """Band of a probability; here the risk maps into 0..1 by risk / (risk + 5)."""
    r = F.col("risk").cast("double")
    p = F.try_divide(r, r + 5.0 * SCORE_SCALE)
    return t.scored_transactions().groupBy(risk_band(p).alias("band")).agg(
        F.count("*").alias("rows"), F.max("risk").alias("highest_risk")
    )


QUERIES = {
    "silver_transactions": query(lambda t: t.silver_tx()),
    "gold_daily_risk": query(lambda t: t.risk()),
    "fraud_features": query(_features),
    "kpi_fraud_totals": query(lambda t: rp.kpi_fraud_totals(t.risk())),
    "overall_rate": query(lambda t: rp.overall_rate(t.risk())),
    "avg_of_rates": query(lambda t: rp.avg_of_rates(t.risk())),
    "top_fraud_categories": query(lambda t: rp.top_fraud_categories(t.risk())),
    "top5_fraud_amount": query(lambda t: rp.top_fraud_amount(t.risk())),
    "fraud_amount_by_day": query(lambda t: rp.fraud_amount_by_day(t.risk())),
    "top_fraud_days": query(lambda t: rp.top_fraud_days(t.risk())),
    "cumulative_fraud": query(lambda t: rp.cumulative_fraud(t.risk())),
    "fraud_heatmap": query(lambda t: rp.fraud_heatmap(t.silver_tx())),
    "fraud_rate_by_channel": query(lambda t: rp.fraud_rate_by(t.labelled_transactions(), F.col("channel"))),
    "fraud_rate_foreign": query(
        lambda t: rp.fraud_rate_by(t.labelled_transactions(), (F.col("country") != HOME_COUNTRY).alias("is_foreign"))
    ),
    "night_fraud_channel": query(lambda t: rp.night_fraud_channel(t.silver_tx())),
    "suspicious_transactions": query(_suspicious),
    "suspicious_this_week": query(
        lambda t: fr.this_week(_suspects(t), t.tx_as_of()).agg(F.count("*").alias("suspicious"))
    ),
    "amount_at_risk": query(lambda t: rp.amount_at_risk(_suspects(t), t.tx_as_of())),
    "anomalous_customers": query(lambda t: rp.anomalous_customers(t.unlabelled_tx())),
    "deviation_from_mean": query(_deviation),
    "rule_risk_score": query(lambda t: t.scored_transactions().select("tx_id", "risk")),
    "risk_band": query(_risk_bands),
    "quantile_threshold": query(_threshold),
    "quantile_sketch": query(_sketched),
    "quantile_label": query(lambda t: t.labelled_transactions().filter("is_fraud").select("tx_id", "risk", "is_fraud")),
    "signal_lift": query(_lift),
    "auc_exact": query(lambda t: auc(t.labelled_transactions().withColumn("_c", cents(F.col("value"))), "_c", F.col("is_fraud"))),
    "auc_signed": query(
        lambda t: auc(
            t.labelled_transactions().withColumn(
                "_s", F.when(cents(F.col("value")) % 7 > 0, cents(F.col("value")) - cents(F.lit(150).cast("decimal(18,2)")))
            ),
            "_s",
            F.col("is_fraud"),
        )
    ),
    "auc_progression": query(_progression),
    "top_share_transactions": query(
        lambda t: extreme_share(
            t.transactions().withColumn("_c", cents(F.col("value"))), "_c", 0.02, largest=True
        ).select("tx_id", "value")
    ),
    "stratified_split": query(_split),
    "profile_by_group": query(_customers_profile),
    "age_bands": query(
        lambda t: t.customers().groupBy(age_band(F.col("age")).alias("band")).agg(F.count("*").alias("customers")).orderBy("band")
    ),
    "filter_in": query(
        lambda t: t.transactions()
        .filter(F.col("currency").isin("COP", "EUR") & F.col("channel").isin("online", "atm"))
        .select("tx_id", "currency", "channel")
    ),
    "filter_between": query(
        lambda t: t.transactions()
        .filter(F.substring("occurred_at", 12, 2).cast("int").between(2, 5))
        .select("tx_id", "occurred_at")
    ),
    "filter_nulls": query(
        lambda t: t.transactions()
        .groupBy("channel")
        .agg(
            F.count_if(F.col("device_id").isNull()).alias("without_device"),
            F.count_if(F.col("device_id").isNotNull()).alias("with_device"),
        )
    ),
}

_RISK = "day, region, merchant_category, transactions, total_amount, frauds, fraud_amount, fraud_rate, average_ticket"
_RATE = "round(count_if(is_fraud) * 100.0::double / count(*)::double, 4)"


def _auc_sql(score: str, source: str) -> str:
    return f"""select count_if(is_fraud)::bigint as positives, count_if(not is_fraud)::bigint as negatives,
        round((sum(case when is_fraud then avg_rank end) - count_if(is_fraud)::double * (count_if(is_fraud) + 1) / 2)
            / (count_if(is_fraud)::double * count_if(not is_fraud)), 6) as auc, 0::bigint as unscored
        from (select is_fraud, rank() over (order by {score})
            + (count(*) over (partition by {score}) - 1) / 2.0::double as avg_rank from {source})"""


_SCORED = """select tx.*, value as s1, risk - (case when country <> 'CO' then 2500000 else 0 end
        + case when substring(occurred_at, 12, 2)::int between 2 and 5 then 2000000 else 0 end
        + case channel when 'online' then 1200000 when 'atm' then 800000 else 0 end) as s2,
        risk + case when tenure_months < 12 and credit_score < 500 then 1500000 else 0 end as s3
    from tx left join customers using (customer_id)"""


def _lift_line(name: str, condition: str) -> str:
    return f"""select '{name}' as signal, count_if({condition})::bigint as rows,
        count_if(({condition}) and is_fraud)::bigint as frauds, count(*)::double as n, count_if(is_fraud)::double as f from t"""


SQL = {
    "silver_transactions": sql(f"select {_TX} from silver_tx", "silver_tx"),
    "gold_daily_risk": sql(f"select {_RISK} from risk_daily", "risk_daily"),
    "fraud_features": sql(
        """select tx_id, amount::double as amount, amount::double / nullif(category_mean, 0) as amount_deviation,
        hour(occurred_at)::double as hour, (country <> 'CO')::int::double as is_foreign, merchant_category, channel,
        segment, tenure_months::double as tenure_months, credit_score::double as credit_score, is_fraud::int as is_fraud
        from silver_tx left join means using (merchant_category)
        where segment is not null and tenure_months is not null and credit_score is not null""",
        "silver_tx",
        "means",
    ),
    "kpi_fraud_totals": sql(
        f"""select sum(transactions)::bigint as transactions, sum(frauds)::bigint as frauds,
        sum(fraud_amount) as fraud_amount, {ratio('sum(frauds)', 'sum(transactions)', 6)} as fraud_rate from risk_daily""",
        "risk_daily",
    ),
    "overall_rate": sql(f"select {ratio('sum(frauds)', 'sum(transactions)', 6)} as overall_rate from risk_daily", "risk_daily"),
    "avg_of_rates": sql(
        f"select {ratio('sum(fraud_rate::decimal(10,4))', 'count(fraud_rate)', 6)} as avg_of_rates from risk_daily",
        "risk_daily",
    ),
    "top_fraud_categories": sql(
        "select merchant_category, sum(frauds)::bigint as frauds from risk_daily group by 1 order by 2 desc, 1 limit 10",
        "risk_daily",
    ),
    "top5_fraud_amount": sql(
        "select merchant_category, sum(fraud_amount) as fraud_amount from risk_daily group by 1 order by 2 desc, 1 limit 5",
        "risk_daily",
    ),
    "fraud_amount_by_day": sql(
        "select day, sum(fraud_amount) as fraud_amount from risk_daily group by 1 order by 1", "risk_daily"
    ),
    "top_fraud_days": sql(
        f"select {_RISK} from risk_daily order by fraud_amount desc, day, region, merchant_category limit 20", "risk_daily"
    ),
    "cumulative_fraud": sql(
        """select day, fraud_amount, sum(fraud_amount) over (order by day) as cumulative_amount
        from (select day, sum(fraud_amount) as fraud_amount from risk_daily group by 1)""",
        "risk_daily",
    ),
    "fraud_heatmap": sql(
        "select region, "
        + ", ".join(
            f"count_if(is_fraud and strftime(occurred_at, '%a') = '{d}')::bigint as \"{d}\"" for d in rp.WEEKDAYS
        )
        + " from silver_tx group by 1",
        "silver_tx",
    ),
    "fraud_rate_by_channel": sql(
        f"""select channel, count(*) as transactions, count_if(is_fraud)::bigint as frauds, {_RATE} as fraud_rate_pct
        from tx group by 1""",
        "tx",
    ),
    "fraud_rate_foreign": sql(
        f"""select country <> 'CO' as is_foreign, count(*) as transactions, count_if(is_fraud)::bigint as frauds,
        {_RATE} as fraud_rate_pct from tx group by 1""",
        "tx",
    ),
    "night_fraud_channel": sql(
        f"""select channel, count(*) as transactions, count_if(is_fraud)::bigint as frauds, {_RATE} as fraud_rate_pct
        from silver_tx where hour(occurred_at) between 2 and 5 group by 1 order by 4 desc, 1 limit 1""",
        "silver_tx",
    ),
    "suspicious_transactions": sql(
        """select merchant_category, count(*) as suspicious, count_if(high)::bigint as high_amount,
        count_if(foreign_country)::bigint as abroad from suspects group by 1""",
        "suspects",
    ),
    "suspicious_this_week": sql(
        f"""select count(*) as suspicious from suspects
        where occurred_at::date between {TX_AS_OF} - 6 and {TX_AS_OF}""",
        "suspects",
    ),
    "amount_at_risk": sql(
        f"""select count(*) as transactions, sum(amount)::double as amount_at_risk from suspects
        where occurred_at::date > {TX_AS_OF} - 30""",
        "suspects",
    ),
    "anomalous_customers": sql(
        """select customer_id, transactions, total::double as total, z_score from (
            select *, round((total::double - s / n) / nullif(sqrt((q * n - s * s) / nullif(n * (n - 1), 0)), 0), 4) as z_score
            from per, (select count(*)::double as n, sum(total)::double as s,
                sum(cast(total * total as decimal(38,4)))::double as q from per))
        where z_score > 2""",
        "silver_tx",
        per="select customer_id, count(*) as transactions, sum(amount)::decimal(18,2) as total from silver_tx group by 1",
    ),
    "deviation_from_mean": sql(
        """select tx_id, merchant_category, amount::double as amount,
        round(amount::double / nullif(category_mean, 0), 6) as amount_deviation
        from silver_tx left join means using (merchant_category)""",
        "silver_tx",
        "means",
    ),
    "rule_risk_score": sql("select tx_id, risk from tx2", "tx2"),
    "risk_band": sql(
        """select case when p >= 0.5 then 'high' when p >= 0.2 then 'medium' when p is not null then 'low' end as band,
        count(*) as rows, max(risk) as highest_risk
        from (select risk, risk::double / (risk::double + 5000000.0::double) as p from tx2) group by 1""",
        "tx2",
    ),
    "quantile_sketch": sql(
        f"""select span, merchant_category, unnest([0.5, 0.9, 0.985]::double[]) as p, n, true as whole, true as within
        from (select 'all' as span, merchant_category, count(amount) as n from tx1 group by all
            union all select 'first', merchant_category, count(amount) from tx1
            where occurred_at[1:10]::date < date '{SPLIT_DAY}' group by all)""",
        "tx1",
    ),
    "quantile_threshold": sql(
        """select count(*) as rows, count_if(is_fraud)::bigint as above,
        (select round(quantile_cont(risk::double, 0.985), 4) from tx2) as threshold from tx""",
        "tx",
    ),
    "quantile_label": sql("select tx_id, risk, is_fraud from tx where is_fraud", "tx"),
    "signal_lift": sql(
        f"""select signal, rows, frauds, {ratio('frauds', 'rows', 6)} as rate,
        round((frauds::double / nullif(rows::double, 0)) / nullif(f / n, 0), 4) as lift from ("""
        + " union all ".join(
            _lift_line(name, condition)
            for name, condition in {
                "base": "true",
                "foreign": "country <> 'CO'",
                "night": "substring(occurred_at, 12, 2)::int between 2 and 5",
                "top_amount": "c > top",
                "online": "channel = 'online'",
                "no_device": "device_id is null",
            }.items()
        )
        + ")",
        "tx",
        t="""select *, (value * 100)::bigint::double as c,
            (select quantile_cont((value * 100)::bigint::double, 0.98) from tx) as top from tx""",
    ),
    "auc_exact": sql(_auc_sql("value", "tx"), "tx"),
    "auc_signed": sql(
        f"""select positives, negatives, auc, (select count_if((value * 100)::bigint % 7 = 0)::bigint from tx) as unscored
        from ({_auc_sql("value - 150", "(select * from tx where (value * 100)::bigint % 7 > 0)")})""",
        "tx",
    ),
    "auc_progression": sql(
        " union all ".join(
            f"select '{name}' as features, auc from ({_auc_sql(score, 'scored')})"
            for name, score in (("amount", "s1"), ("relative_amount", "s2"), ("with_customer", "s3"))
        ),
        "tx",
        "customers",
        scored=_SCORED,
    ),
    "top_share_transactions": sql(
        """select tx_id, value::double as value from (select *, rank() over (order by value desc) as rk,
        count(*) over () as n from tx1) where rk <= ceil(n * 0.02)""",
        "tx1",
    ),
    "stratified_split": sql(
        f"""select case when {q_bucket("concat(tx_id, 'split')", 100)} < 25 then 'test' else 'train' end as part,
        is_fraud, count(*) as rows from tx group by 1, 2""",
        "tx",
    ),
    "profile_by_group": sql(
        """select segment, region, count(*) as customers,
        round(sum(credit_score)::double / count(*), 1) as credit_score,
        round(sum(tenure_months)::double / count(*), 1) as tenure_months
        from customers group by 1, 2 order by 1, 2""",
        "customers",
    ),
    "age_bands": sql(
        """select case when age < 25 then '18-24' when age < 35 then '25-34' when age < 45 then '35-44'
        when age < 55 then '45-54' when age < 65 then '55-64' else '65+' end as band, count(*) as customers
        from customers group by 1 order by 1""",
        "customers",
    ),
    "filter_in": sql(
        """select tx_id, currency, channel from tx1
        where currency in ('COP', 'EUR') and channel in ('online', 'atm')""",
        "tx1",
    ),
    "filter_between": sql(
        "select tx_id, occurred_at from tx1 where substring(occurred_at, 12, 2)::int between 2 and 5", "tx1"
    ),
    "filter_nulls": sql(
        """select channel, count_if(device_id is null)::bigint as without_device,
        count_if(device_id is not null)::bigint as with_device from tx1 group by 1""",
        "tx1",
    ),
}

