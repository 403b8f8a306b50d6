"""Scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.buckets import bucket, flag_share, weighted_draw
from oreflow.functions.calendar import calendar_columns, parse_timestamp
from oreflow.functions.text import keep_last_four, padded_id, title_from_code
from oreflow.plans.sales import ratio
from oreflow.plans.season import seasonal_factors
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import bucket as q_bucket
from oreflow.queries.oracle import ratio as q_ratio
from oreflow.queries.oracle import sql
from oreflow.session import materialise

# A weighted list, and a code for each merchant category.
DRAW = [("store", 5), ("online", 3), ("marketplace", 2)]
CATEGORY_CODES = {"click": "C1", "view": "V1", "purchase": "P1", "signup": "S1", "error": "E1"}


def _strings(t: Layers):
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        padded_id("PRD", F.col("p_partkey"), 5).alias("code"),
        padded_id("P", F.col("p_partkey"), 2).alias("short_code"),
        title_from_code(F.regexp_replace("p_name", " ", "_")).alias("title"),
        F.concat_ws(" ", "p_brand", F.initcap("p_type"), F.col("p_size").cast("string")).alias("label"),
        F.substring("p_name", -4, 4).alias("tail"),
        F.regexp_extract("p_brand", "#([0-9]+)$", 1).alias("brand_number"),
        F.col("p_brand").startswith("Brand#1").alias("starts"),
    )


def _maths(t: Layers):
    x = F.col("p_size").cast("double")
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.round(F.pow(x, F.lit(1.5)), 6).alias("power"),
        F.round(F.exp(x / 50.0), 6).alias("exponent"),
        F.abs(F.lit(25) - F.col("p_size")).alias("distance"),
        (F.col("p_size") % 7).alias("remainder"),
        (-F.col("p_retailprice")).alias("negated"),
        F.round(F.sin(x), 6).alias("sine"),
        F.round(F.cos(x), 6).alias("cosine"),
    )


def _parsed(t: Layers):
    """Text timestamps, some of them broken on purpose by a stable rule."""
    broken = F.when(flag_share(F.concat(F.col("tx_id"), F.lit("b")), 50), F.concat(F.lit("x"), "occurred_at"))
    return t.transactions().select(
        "tx_id", parse_timestamp(F.coalesce(broken, F.col("occurred_at"))).alias("parsed")
    )


def _calendar(t: Layers):
    days = materialise(t.daily().select("day").distinct(), "days")
    origin = days.agg(F.min("day")).scalar()
    columns = calendar_columns(F.col("day"), origin)
    waves = {c: F.round(columns[c], 9) for c in ("sin_year", "cos_year")}
    return days.withColumns({**columns, **waves})


def _season(t: Layers):
    """Mean amount per month over the overall mean: the index learned from the daily table."""
    daily = t.series().groupBy("day").agg(F.sum("amount").alias("amount"))
    mean = daily.agg(ratio(F.sum("amount"), F.count("*"), 10)).scalar()
    per_month = daily.groupBy(F.month("day").alias("month")).agg(
        F.count("*").alias("days"), ratio(F.sum("amount"), F.count("*"), 10).alias("_mean")
    )
    return per_month.select("month", "days", F.round(F.col("_mean") / mean, 6).alias("season"))


def _factors(t: Layers):
    daily = t.series().groupBy("day").agg(F.sum("amount").alias("amount"))
    return seasonal_factors(daily).withColumn("factor", F.round("factor", 6))


def _bands(t: Layers):
    price = F.col("p_retailprice")
    band = F.when(price < 950, "low").when(price < 1500, "middle").otherwise("high")
    return t.part.groupBy(band.alias("band")).agg(F.count("*").alias("products"))


QUERIES = {
    "string_ops": query(_strings),
    "math_ops": query(_maths),
    "parse_timestamp": query(_parsed),
    "calendar_features": query(_calendar),
    "seasonal_index": query(_season),
    "seasonal_factors": query(_factors),
    "case_banding": query(_bands),
    "clamp": query(
        lambda t: t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.greatest(F.lit(10), F.least(F.lit(40), F.col("p_size"))).alias("clamped"),
        )
    ),
    "hash_bucket": query(
        lambda t: t.orders.select(F.col("o_orderkey").cast("string").alias("k"))
        .groupBy(bucket(F.concat("k", F.lit("q")), 1000).alias("bucket"))
        .agg(F.count("*").alias("rows"))
    ),
    "array_lookup": query(
        lambda t: t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            weighted_draw(F.concat(F.col("o_orderkey").cast("string"), F.lit("w")), DRAW).alias("drawn"),
        )
    ),
    "map_lookup": query(
        lambda t: t.events.groupBy(
            F.create_map(*[F.lit(x) for pair in CATEGORY_CODES.items() for x in pair])[F.col("event_type")].alias("code")
        ).agg(F.count("*").alias("rows"))
    ),
    "json_path": query(
        lambda t: t.events.select(
            "event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k")
        )
    ),
    "mask_partial": query(
        lambda t: t.transactions().select("tx_id", keep_last_four(F.col("card_number")).alias("card_number"))
    ),
}

_DRAWN = [label for label, times in DRAW for _ in range(times)]

SQL = {
    "string_ops": sql(
        """select p_partkey as product_id,
        concat('PRD', case when p_partkey < 100000 then lpad(p_partkey::varchar, 5, '0') else p_partkey::varchar end) as code,
        concat('P', case when p_partkey < 100 then lpad(p_partkey::varchar, 2, '0') else p_partkey::varchar end) as short_code,
        array_to_string(list_transform(string_split(p_name, ' '),
            lambda w: upper(w[1:1]) || lower(w[2:])), ' ') as title,
        concat_ws(' ', p_brand, upper(p_type[1:1]) || lower(p_type[2:]), p_size::varchar) as label,
        right(p_name, 4) as tail, regexp_extract(p_brand, '#([0-9]+)$', 1) as brand_number,
        starts_with(p_brand, 'Brand#1') as starts from part"""
    ),
    "math_ops": sql(
        """select p_partkey as product_id, round(pow(p_size::double, 1.5), 6) as power,
        round(exp(p_size::double / 50.0::double), 6) as exponent, abs(25 - p_size) as distance, p_size % 7 as remainder,
        -p_retailprice as negated, round(sin(p_size::double), 6) as sine, round(cos(p_size::double), 6) as cosine
        from part"""
    ),
    "parse_timestamp": sql(
        f"""select tx_id, try_cast(case when {q_bucket("concat(tx_id, 'b')", 1000)} < 50
        then concat('x', occurred_at) else occurred_at end as timestamp) as parsed from tx1""",
        "tx1",
    ),
    "calendar_features": sql(
        """select day, day - (select min(day) from daily) as trend,
        round(sin(2.0::double * pi() * dayofyear(day) / 365.25::double), 9) as sin_year,
        round(cos(2.0::double * pi() * dayofyear(day) / 365.25::double), 9) as cos_year,
        isodow(day) - 1 as weekday, month(day) as month, day(day) as month_day
        from (select distinct day from daily)""",
        "daily",
    ),
    "seasonal_index": sql(
        f"""select month(day) as month, count(*) as days,
        round({q_ratio('sum(amount)', 'count(*)', 10)} / (select {q_ratio('sum(amount)', 'count(*)', 10)} from d), 6) as season
        from d group by 1""",
        "daily",
        d="select day, sum(amount) as amount from daily group by 1",
    ),
    "seasonal_factors": sql(
        """select * from (with recursive d as (select day, sum(amount)::double as y from daily group by 1),
        c as (select month(day) as m, dayofweek(day) + 1 as w, count(*)::double as n, sum(y) as y from d group by 1, 2),
        g as (select m, w, coalesce(n, 0) as n, coalesce(y, 0) as y
            from (select unnest(range(1, 13)) as m) cross join (select unnest(range(1, 8)) as w) left join c using (m, w)),
        mn as (select list(ns order by m) as n, list(ys order by m) as y, list(nt order by m) as t
            from (select m, list(n order by w) as ns, sum(y) as ys, sum(n) as nt from g group by m)),
        wn as (select list(ns order by w) as n, list(ys order by w) as y, list(nt order by w) as t
            from (select w, list(n order by m) as ns, sum(y) as ys, sum(n) as nt from g group by w)),
        mean as (select sum(y) / sum(n) as mean from g),
        r as (select 0 as k, [1.0, 1, 1, 1, 1, 1, 1]::double[] as w, [1.0, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1]::double[] as m
            union all
            select k + 1, case when k % 2 = 0 then r.w else list_transform(range(1, 8), lambda j:
                    coalesce(wn.y[j] / nullif(mean * list_inner_product(wn.n[j], r.m), 0), 1.0)) end,
                case when k % 2 = 1 then r.m else list_transform(range(1, 13), lambda i:
                    coalesce(mn.y[i] / nullif(mean * list_inner_product(mn.n[i], r.w), 0), 1.0)) end
            from r, mn, wn, mean where k < 61),
        e as (select r.*, mn.t as mt, wn.t as wt, list_inner_product(r.m, mn.t) / list_sum(mn.t) as level from r, mn, wn where k = 61)
        select * from (
            select 'month' as kind, unnest(range(1, 13)) as part, unnest(mt)::bigint as days,
                round(unnest(list_transform(m, lambda x: x / level)), 6) as factor from e
            union all
            select 'weekday', unnest(range(1, 8)), unnest(wt)::bigint, round(unnest(list_transform(w, lambda x: x * level)), 6) from e)
        where days > 0)""",
        "daily",
    ),
    "case_banding": sql(
        """select case when p_retailprice < 950 then 'low' when p_retailprice < 1500 then 'middle' else 'high' end as band,
        count(*) as products from part group by 1"""
    ),
    "clamp": sql("select p_partkey as product_id, greatest(10, least(40, p_size)) as clamped from part"),
    "hash_bucket": sql(
        f"select {q_bucket("concat(o_orderkey, 'q')", 1000)} as bucket, count(*) as rows from orders group by 1"
    ),
    "array_lookup": sql(
        f"""select o_orderkey as order_id, {_DRAWN}[{q_bucket("concat(o_orderkey, 'w')", len(_DRAWN))} + 1] as drawn
        from orders"""
    ),
    "map_lookup": sql(
        "select case event_type "
        + " ".join(f"when '{k}' then '{v}'" for k, v in CATEGORY_CODES.items())
        + " end as code, count(*) as rows from events group by 1"
    ),
    "json_path": sql("select event_id, json_extract_string(props, '$.k')::bigint as k from events"),
    "mask_partial": sql(
        "select tx_id, concat('****-****-****-', right(card_number, 4)) as card_number from tx1", "tx1"
    ),
}
