"""Sales: silver, gold, reports and forecasts of the baseline."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from oreflow.operators.joins import orphans
from oreflow.operators.splits import recency_split, time_split
from oreflow.operators.metrics import forecast_errors
from oreflow.plans import forecast as fc
from oreflow.plans import sales_reports as rp
from oreflow.plans.sales import ratio
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import SALES_AS_OF, money, sql
from oreflow.queries.oracle import ratio as q_ratio
from oreflow.session import materialise, scratch_dir
from oreflow.sources.catalog import dropped_after, publish_view, run_sql, save_table

COUNTRY = "ASIA"
_STATUS = "product_id, product_name, category, country, stock_now, stock_min, daily_demand, coverage_days, lead_time_days, needs_restock"
_PRODUCT = (
    "product_id, product_name, category, brand, units_sold, total_amount::double as total_amount, "
    "total_profit::double as total_profit, countries_sold, margin_pct"
)
_SALE = (
    "sale_id, sold_at, product_id, country, channel, quantity, unit_price::double as unit_price, "
    "discount_pct::double as discount_pct, amount::double as amount"
)


def _kpi_totals(t: Layers):
    silver = t.stored_silver()
    return rp.kpi_retail_totals(t.daily(silver), t.status(silver))


def _distinct_counts(t: Layers):
    """Exact distinct values per column: one narrow distinct each, no row expansion."""
    sales = t.stored_silver()
    out = None
    for c in ("product_id", "country", "channel", "category"):
        n = sales.select(c).distinct().agg(F.count(c).alias("values")).select(F.lit(c).alias("column_name"), "values")
        out = n if out is None else out.unionAll(n)
    return out


def _recency(t: Layers):
    sold = t.sales().select(F.to_date(F.substring("sold_at", 1, 10)).alias("day"), "amount")
    split = recency_split(sold, "day", 0.045, t.sales_as_of())
    return split.groupBy("batch").agg(
        F.count("*").alias("rows"), F.sum("amount").alias("amount"), F.min("day").alias("first_day")
    )


def _baseline(t: Layers):
    return fc.seasonal_baseline(t.series())


def _backtest(t: Layers):
    split = time_split(t.series(), "day", 60)
    return fc.baseline_backtest(split, "amount").withColumn("amount", F.col("amount").cast("double"))


def _history_forecast(t: Layers):
    series = t.series()
    return fc.history_union_forecast(series, fc.seasonal_baseline(series))


def _actual_vs(t: Layers):
    series = t.series()
    split = time_split(series, "day", 60)
    predicted = fc.baseline_backtest(split, "amount").withColumnRenamed("predicted", "amount_forecast")
    both = fc.actual_vs_forecast(series, predicted)
    return both.groupBy("country").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"),
        F.sum(F.col("amount_forecast").cast("decimal(18,2)")).alias("amount_forecast"),
        F.count("amount_forecast").alias("forecast_days"),
    )


def _future_only(t: Layers):
    series = t.series()
    both = fc.history_union_forecast(series, fc.seasonal_baseline(series)).select("day", "amount_forecast")
    return fc.future_only(both, series)


def _orphans(t: Layers):
    tx = t.transactions().select("customer_id")
    known = t.customers().select("customer_id")
    idle = orphans(known, tx.distinct(), "customer_id").agg(F.count("*").alias("rows"))
    lost = orphans(tx, known, "customer_id").agg(F.count("*").alias("rows"))
    return lost.select(F.lit("transactions without customer").alias("side"), "rows").unionAll(
        idle.select(F.lit("customers without transactions").alias("side"), "rows")
    )


def _forecast_days(t: Layers):
    """The daily forecast of one country: its line in the dashboard."""
    return fc.country_forecast(fc.seasonal_baseline(t.series()), COUNTRY)


DASHBOARD = """
    SELECT day, country, category, units, amount, profit, lines FROM {daily}
    WHERE (:country IS NULL OR country = :country) AND (:category IS NULL OR category = :category)
      AND day BETWEEN coalesce(:first, day) AND coalesce(:last, day)
"""


def _from_sql(t: Layers):
    """The same as ``parameter_filter``, from a SQL text with parameter markers."""
    return run_sql(
        t.spark, DASHBOARD, {"daily": t.daily()}, country=COUNTRY, category=None, first=date(1996, 1, 1), last=date(1997, 12, 31)
    )


def _from_catalog(t: Layers):
    """Gold as a managed table, a view over it, and a consumer's SQL on the view."""
    suffix = scratch_dir(t.spark, "catalog")[-12:]
    table, view = f"oreflow_daily_{suffix}", f"oreflow_top_{suffix}"
    with dropped_after(t.spark, table, view):
        save_table(t.daily(), table, comment="sales by day, country and category")
        publish_view(t.spark, view, f"SELECT country, category, sum(amount) AS amount FROM {table} GROUP BY ALL")
        best = run_sql(t.spark, f"SELECT * FROM {view} WHERE amount > :least", least=0)
        return materialise(best, "from-catalog")


QUERIES = {
    "gold_daily_sales": query(lambda t: t.daily()),
    "silver_sales": query(lambda t: t.silver()),
    "gold_product_sales": query(lambda t: t.product_sales()),
    "recent_window_demand": query(lambda t: t.demand()),
    "inventory_status": query(lambda t: t.status()),
    "dedupe_by_key": query(lambda t: t.unique_sales()),
    "monthly_sales": query(lambda t: rp.monthly_sales(t.daily())),
    "weekday_profile": query(lambda t: rp.weekday_profile(t.daily())),
    "country_daily_series": query(lambda t: rp.country_daily_series(t.daily())),
    "sales_country_category": query(
        lambda t: t.daily().groupBy("country", "category").agg(F.sum("amount").alias("amount"))
    ),
    "sales_by_country": query(lambda t: t.daily().groupBy("country").agg(F.sum("amount").alias("amount"))),
    "sales_by_channel": query(
        lambda t: t.silver().groupBy("channel").agg(F.sum("amount").alias("amount"), F.count("*").alias("lines"))
    ),
    "margin_by_category": query(lambda t: rp.margin_by(t.daily(), "category", "amount", "profit")),
    "margin_by_brand": query(lambda t: rp.margin_by(t.product_sales(), "brand", "total_amount", "total_profit")),
    "ratio_of_avgs": query(
        lambda t: t.products()
        .groupBy("category")
        .agg(
            F.count("*").alias("products"),
            ratio(F.sum("unit_cost"), F.sum("list_price"), 3).alias("cost_over_price"),
        )
    ),
    "kpi_retail_totals": query(_kpi_totals),
    "top_products": query(lambda t: rp.top_products(t.product_sales())),
    "star_products": query(lambda t: rp.star_products(t.stored_product_sales())),
    "star_products_example": query(lambda t: rp.star_products_example(t.product_sales())),
    "low_performers": query(lambda t: rp.low_performers(t.stored_product_sales())),
    "top_margin_products": query(lambda t: rp.top_margin_products(t.product_sales())),
    "quarter_growth": query(lambda t: rp.quarter_growth(t.daily())),
    "top_category_per_country": query(lambda t: rp.top_category_per_country(t.daily())),
    "top_category_last_quarter": query(lambda t: rp.top_category_last_quarter(t.daily(), t.sales_as_of())),
    "parameter_filter": query(
        lambda t: rp.filtered(t.daily(), country=COUNTRY, first=date(1996, 1, 1), last=date(1997, 12, 31))
    ),
    "parameter_filter_sql": query(_from_sql),
    "catalog_view": query(_from_catalog),
    "restock_counts": query(lambda t: rp.restock_counts(t.status())),
    "kpi_restock": query(lambda t: rp.kpi_restock(t.status(), COUNTRY)),
    "restock_list": query(lambda t: rp.restock_list(t.status(), COUNTRY)),
    "purchase_quantity": query(lambda t: rp.purchase_quantity(t.status())),
    "stockout_risk": query(lambda t: rp.stockout_risk(t.status())),
    "filter_boolean_null": query(
        lambda t: t.status().filter("needs_restock").select("product_id", "country", "needs_restock")
    ),
    "filter_compare": query(lambda t: t.sales().filter("quantity <= 0").select("sale_id", "quantity", "amount")),
    "conditional_counts": query(
        lambda t: t.sales().agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("quantity") == 0).alias("zero"),
            F.count_if(F.col("quantity") < 0).alias("negative"),
            F.count_if(F.col("amount") > 50000).alias("large"),
        )
    ),
    "distinct_counts": query(_distinct_counts),
    "distinct_values": query(lambda t: t.inventory().select("country").distinct().orderBy("country")),
    "group_count": query(
        lambda t: t.sales().groupBy("country", "channel").agg(F.count("*").alias("rows"))
    ),
    "cross_join_grid": query(lambda t: t.inventory()),
    "broadcast_inner_join": query(
        lambda t: t.sales()
        .select("sale_id", "product_id", "amount")
        .join(t.products().select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))
    ),
    "orphan_facts": query(_orphans),
    "recency_split": query(_recency),
    "forecast_grid": query(lambda t: fc.forecast_grid(t.series())),
    "seasonal_baseline": query(_baseline),
    "forecast_by_country": query(lambda t: fc.forecast_by_country(_baseline(t))),
    "forecast_country_days": query(_forecast_days),
    "history_union_forecast": query(_history_forecast),
    "actual_vs_forecast": query(_actual_vs),
    "future_only": query(_future_only),
    "time_split": query(
        lambda t: time_split(t.series(), "day", 60)
        .groupBy("part", "country")
        .agg(F.count("*").alias("days"), F.sum("amount").alias("amount"), F.min("day").alias("first_day"))
    ),
    "forecast_metrics": query(
        lambda t: forecast_errors(_backtest(t), "amount", "predicted").select(
            "rows", F.round("mape", 6).alias("mape"), F.round("residual_sd", 2).alias("residual_sd")
        )
    ),
}


def _fit_sql(source: str, measure: str, suffix: str) -> dict[str, str]:
    """Trend and season of one measure, from the day series named ``source``."""
    origin = f"(select min(day) from {source})"
    t = f"(day - {origin})::decimal(18,0)"
    y = f"{measure}::decimal(18,2)"
    return {
        f"sums{suffix}": f"""select country, count(*)::double as n, sum({t})::double as st,
            sum({t} * {t})::double as stt, sum({y})::double as sy, sum(cast({t} * {y} as decimal(38,2)))::double as sty
            from {source} group by country""",
        f"trend{suffix}": f"""select country, slope, (sy - slope * st) / n as level, sy / n as mean from (
            select *, coalesce((n * sty - st * sy) / nullif(n * stt - st * st, 0), 0.0) as slope from sums{suffix})""",
        f"season{suffix}": f"""select country, month, month_mean / nullif(mean, 0) as season from (
            select country, month(day) as month, sum({y})::double / count(*)::double as month_mean
            from {source} group by 1, 2) join trend{suffix} using (country)""",
    }


def _predict_sql(source: str, days: str, suffix: str, name: str, digits: int) -> str:
    origin = f"(select min(day) from {source})"
    return f"""select d.*, round(greatest((level + slope * (day - {origin})) * coalesce(season, 1.0), 0.0::double), {digits})
        as {name} from {days} d join trend{suffix} using (country)
        left join season{suffix} s on s.country = d.country and s.month = month(d.day)"""


_GRID = """select (select max(day) from series) + i::int as day, country
    from range(1, 91) r(i), (select distinct country from series)"""
_BASELINE = {
    "grid": _GRID,
    **_fit_sql("series", "amount", "_a"),
    "with_a": _predict_sql("series", "grid", "_a", "amount_forecast", 2),
    **_fit_sql("series", "units", "_u"),
    "baseline": _predict_sql("series", "with_a", "_u", "units_forecast", 0),
}
_SPLIT = {
    "train": "select * from series where day <= (select max(day) from series) - 60",
    "test": "select * from series where day > (select max(day) from series) - 60",
    **_fit_sql("train", "amount", "_t"),
    "tested": _predict_sql("train", "test", "_t", "predicted", 2),
}

SQL = {
    "gold_daily_sales": sql(f"select day, country, category, units, {money('amount', 'profit')}, lines from daily", "daily"),
    "silver_sales": sql(
        f"""select sale_id, sold_at, product_id, product_name, category, brand, country, channel, quantity,
        {money('unit_price', 'discount_pct', 'amount', 'unit_cost', 'profit')} from silver""",
        "silver",
    ),
    "gold_product_sales": sql(f"select {_PRODUCT} from product_sales", "product_sales"),
    "recent_window_demand": sql("select * from demand", "demand"),
    "inventory_status": sql(f"select {_STATUS} from status", "status"),
    "dedupe_by_key": sql(f"select {_SALE} from sales where rn = 1", "sales"),
    "monthly_sales": sql(
        """select date_trunc('month', day)::date as month, sum(amount)::double as amount, sum(units)::bigint as units,
        sum(profit)::double as profit from daily group by 1 order by 1""",
        "daily",
    ),
    "weekday_profile": sql(
        """select strftime(day, '%a') as weekday, sum(amount)::double as amount, sum(lines)::bigint as lines
        from daily group by 1""",
        "daily",
    ),
    "country_daily_series": sql("select day, country, amount::double as amount, units from series", "series"),
    "sales_country_category": sql(
        "select country, category, sum(amount)::double as amount from daily group by 1, 2", "daily"
    ),
    "sales_by_country": sql("select country, sum(amount)::double as amount from daily group by 1", "daily"),
    "sales_by_channel": sql(
        "select channel, sum(amount)::double as amount, count(*) as lines from silver group by 1", "silver"
    ),
    "margin_by_category": sql(
        f"""select category, sum(amount)::double as amount, sum(profit)::double as profit,
        {q_ratio('sum(profit)', 'sum(amount)', 4)} as margin_pct from daily group by 1""",
        "daily",
    ),
    "margin_by_brand": sql(
        f"""select brand, sum(amount)::double as amount, sum(profit)::double as profit,
        {q_ratio('sum(profit)', 'sum(amount)', 4)} as margin_pct from silver group by 1""",
        "silver",
    ),
    "ratio_of_avgs": sql(
        f"""select category, count(*) as products, {q_ratio('sum(unit_cost)', 'sum(list_price)', 3)} as cost_over_price
        from products group by 1""",
        "products",
    ),
    "kpi_retail_totals": sql(
        """select sum(amount)::double as amount, sum(profit)::double as profit, sum(units)::bigint as units,
        sum(lines)::bigint as lines, (select count(*) from status where needs_restock) as products_to_restock
        from daily""",
        "daily",
        "status",
    ),
    "top_products": sql(
        f"select {_PRODUCT} from product_sales p order by p.total_amount desc, product_id limit 20", "product_sales"
    ),
    "star_products": sql(
        f"""select {_PRODUCT} from (select *, rank() over (order by total_amount desc) as rk,
        count(*) over () as n from product_sales) where rk <= ceil(n * 0.1) and margin_pct > 0.35""",
        "product_sales",
    ),
    "star_products_example": sql(
        f"""select {_PRODUCT} from product_sales p where margin_pct > 0.35
        order by p.total_amount desc, product_id limit 20""",
        "product_sales",
    ),
    "low_performers": sql(
        f"""select {_PRODUCT} from (select *, rank() over (order by total_amount) as rk,
        count(*) over () as n from product_sales) where rk <= ceil(n * 0.1)""",
        "product_sales",
    ),
    "top_margin_products": sql(
        f"select {_PRODUCT} from product_sales order by margin_pct desc, product_id limit 10", "product_sales"
    ),
    "quarter_growth": sql(
        f"""select category, quarter, amount::double as amount, previous_amount::double as previous_amount,
        {q_ratio('amount - previous_amount', 'previous_amount', 4)} as growth
        from (select *, lag(amount) over (partition by category order by quarter) as previous_amount
            from (select category, date_trunc('quarter', day)::date as quarter, sum(amount) as amount
                from daily group by 1, 2))""",
        "daily",
    ),
    "top_category_per_country": sql(
        """select country, category, amount::double as amount, rank from (select *,
            row_number() over (partition by country order by amount desc, category) as rank
            from (select country, category, sum(amount) as amount from daily group by 1, 2)) where rank <= 3""",
        "daily",
    ),
    "top_category_last_quarter": sql(
        f"""select category, sum(amount)::double as amount from daily
        where day >= date_trunc('quarter', {SALES_AS_OF})::date and day <= {SALES_AS_OF}
        group by 1 order by 2 desc, 1 limit 1""",
        "daily",
    ),
    "parameter_filter": sql(
        f"""select day, country, category, units, {money('amount', 'profit')}, lines from daily
        where country = '{COUNTRY}' and day between date '1996-01-01' and date '1997-12-31'""",
        "daily",
    ),
    "restock_counts": sql(
        "select category, country, count(*) as products_to_restock from status where needs_restock group by 1, 2",
        "status",
    ),
    "kpi_restock": sql(
        f"""select count(*) as products, sum(case when needs_restock then 1 else 0 end)::bigint as to_restock,
        sum(case when needs_restock and coverage_days < 7 then 1 else 0 end)::bigint as urgent
        from status where country = '{COUNTRY}'""",
        "status",
    ),
    "restock_list": sql(
        f"""select {_STATUS}, case when coverage_days is null or coverage_days < 7 then 'urgent'
        when coverage_days < 15 then 'soon' else 'watch' end as band
        from status where needs_restock and country = '{COUNTRY}'
        order by coverage_days nulls first, product_id""",
        "status",
    ),
    "purchase_quantity": sql(
        """select product_id, country, stock_now, daily_demand,
        greatest(0, ceil(30.0::double * daily_demand - stock_now))::bigint as buy from status where needs_restock""",
        "status",
    ),
    "stockout_risk": sql(f"select {_STATUS} from status where coverage_days < lead_time_days", "status"),
    "filter_boolean_null": sql("select product_id, country, needs_restock from status where needs_restock", "status"),
    "filter_compare": sql("select sale_id, quantity, amount::double as amount from sales where quantity <= 0", "sales"),
    "conditional_counts": sql(
        """select count(*) as rows, count_if(quantity = 0)::bigint as zero, count_if(quantity < 0)::bigint as negative,
        count_if(amount > 50000)::bigint as large from sales""",
        "sales",
    ),
    "distinct_counts": sql(
        " union all ".join(
            f"select '{c}' as column_name, count(distinct {c}) as values from silver"
            for c in ("product_id", "country", "channel", "category")
        ),
        "silver",
    ),
    "distinct_values": sql("select distinct country from inventory order by country", "inventory"),
    "group_count": sql("select country, channel, count(*) as rows from sales group by 1, 2", "sales"),
    "cross_join_grid": sql("select * from inventory", "inventory"),
    "broadcast_inner_join": sql(
        """select category, count(*) as rows, sum(amount)::double as amount
        from sales join products using (product_id) group by 1""",
        "sales",
        "products",
    ),
    "orphan_facts": sql(
        """select 'transactions without customer' as side, count(*) as rows from events
            where user_id not in (select c_custkey from customer)
        union all select 'customers without transactions', count(*) from customer
            where c_custkey not in (select user_id from events)"""
    ),
    "recency_split": sql(
        f"""select case when age <= cut then 'late' else 'initial' end as batch, count(*) as rows,
        sum(amount)::double as amount, min(day) as first_day
        from (select *, (select quantile_cont(({SALES_AS_OF} - sold_at[1:10]::date)::double, 0.045) from sales) as cut
            from (select sold_at[1:10]::date as day, {SALES_AS_OF} - sold_at[1:10]::date as age, amount from sales))
        group by 1""",
        "sales",
    ),
    "forecast_grid": sql("select * from grid", "series", grid=_GRID),
    "seasonal_baseline": sql(
        "select day, country, amount_forecast, units_forecast from baseline", "series", **_BASELINE
    ),
    "forecast_country_days": sql(
        f"select day, amount_forecast, units_forecast from baseline where country = '{COUNTRY}'", "series", **_BASELINE
    ),
    "forecast_by_country": sql(
        """select country, round(sum(amount_forecast::decimal(18,2))::double, 0) as amount_90d,
        round(sum(units_forecast::decimal(18,2))::double, 0) as units_90d from baseline group by 1 order by 2 desc, 1""",
        "series",
        **_BASELINE,
    ),
    "history_union_forecast": sql(
        """select day, sum(amount)::double as amount, null::double as amount_forecast from series group by 1
        union all select day, null, sum(amount_forecast::decimal(18,2))::double from baseline group by 1""",
        "series",
        **_BASELINE,
    ),
    "actual_vs_forecast": sql(
        """select country, sum(amount)::double as amount, sum(predicted::decimal(18,2))::double as amount_forecast,
        count(predicted) as forecast_days
        from series full join (select day, country, predicted from tested) using (day, country) group by 1""",
        "series",
        **_SPLIT,
    ),
    "future_only": sql(
        """select day, sum(amount_forecast::decimal(18,2))::double as amount_forecast from baseline
        where day > (select max(day) from series) group by 1""",
        "series",
        **_BASELINE,
    ),
    "time_split": sql(
        """select case when day > (select max(day) from series) - 60 then 'test' else 'train' end as part, country,
        count(*) as days, sum(amount)::double as amount, min(day) as first_day from series group by 1, 2""",
        "series",
    ),
    "forecast_metrics": sql(
        """select count(*) as rows,
        round(avg(abs(amount::double - predicted) / greatest(abs(amount::double), 1.0::double)), 6) as mape,
        round(stddev_pop(amount::double - predicted), 2) as residual_sd from tested""",
        "series",
        **_SPLIT,
    ),
}

SQL["parameter_filter_sql"] = SQL["parameter_filter"]
SQL["catalog_view"] = sql(
    "select country, category, sum(amount)::double as amount from daily group by all having sum(amount) > 0", "daily"
)
