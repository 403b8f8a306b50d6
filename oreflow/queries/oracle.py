"""Shared SQL: the business datasets as common table expressions, for checking in another engine."""

from __future__ import annotations


def bucket(key: str, n: int) -> str:
    return f"(('0x' || substring(md5({key}), 1, 8))::bigint % {n})"


def ratio(a: str, b: str, digits: int) -> str:
    return f"round(({a})::double / nullif(({b})::double, 0), {digits})"


SALES_AS_OF = "(select max(o_orderdate)::date from orders)"
TX_AS_OF = "(select max(ts)::date from events)"

_B = bucket("concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey,'q')", 1000)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "lines": (
        f"""select l.*, o_orderdate, o_orderstatus, r_name, {_B} as b, l_quantity::bigint as q,
            round(l_extendedprice * 100)::bigint as c
        from lineitem l join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
        (),
    ),
    "priced": (
        """select *, (case when b < 12 then 0 when b < 20 then -q else q end)::bigint as quantity,
            cast(cast((2 * c + q) // (2 * q) as decimal(18,0)) * 0.01 as decimal(18,2)) as unit_price
        from lines""",
        ("lines",),
    ),
    "sales": (
        """select concat(l_orderkey, '-', l_linenumber) as sale_id,
            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as sold_at, l_partkey as product_id, r_name as country,
            case o_orderstatus when 'F' then 'store' when 'O' then 'online' else 'marketplace' end as channel,
            quantity, unit_price, l_discount::decimal(4,2) as discount_pct,
            case when b < 20 then cast(quantity * unit_price as decimal(18,2))
                else l_extendedprice::decimal(18,2) end as amount,
            row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as rn
        from priced""",
        ("priced",),
    ),
    "products": (
        f"""select p_partkey as product_id, p_name as product_name, p_type as category, p_brand as brand,
            p_retailprice::decimal(18,2) as list_price,
            cast(p_retailprice::decimal(9,2) * (45 + {bucket("concat('c', p_partkey)", 28)})::decimal(4,0)
                * 0.01::decimal(3,2) as decimal(18,2)) as unit_cost
        from part""",
        (),
    ),
    "refined": (
        """select sale_id, sold_at::timestamp as sold_at, product_id, product_name, category, brand, country,
            channel, quantity, unit_price, discount_pct, amount, unit_cost,
            cast(amount - cast(quantity * unit_cost as decimal(18,2)) as decimal(18,2)) as profit
        from sales left join products using (product_id) where rn = 1""",
        ("sales", "products"),
    ),
    "silver": ("select * from refined where sale_id is not null and quantity > 0", ("refined",)),
    "daily": (
        """select sold_at::date as day, country, category, sum(quantity)::bigint as units, sum(amount) as amount,
            sum(profit) as profit, count(*) as lines
        from silver group by 1, 2, 3""",
        ("silver",),
    ),
    "product_sales": (
        f"""select *, {ratio('total_profit', 'total_amount', 4)} as margin_pct from (
            select product_id, product_name, category, brand, sum(quantity)::bigint as units_sold,
                sum(amount) as total_amount, sum(profit) as total_profit,
                count(distinct country) as countries_sold
            from silver group by all)""",
        ("silver",),
    ),
    "demand": (
        f"""select product_id, country, round(sum(quantity) / 90.0::double, 2) as daily_demand
        from silver where sold_at >= {SALES_AS_OF} - 90 group by 1, 2""",
        ("silver",),
    ),
    "inventory": (
        f"""select product_id, country, {bucket("concat('s', product_id, country)", 40)} as stock_now,
            5 + {bucket("concat('m', product_id, country)", 15)} as stock_min,
            3 + {bucket("concat('l', product_id, country)", 25)} as lead_time_days
        from (select p_partkey as product_id, r_name as country from part, region)
        where {bucket("concat(product_id, country)", 100)} < 55""",
        (),
    ),
    "status": (
        """select *, stock_now < stock_min or coverage_days < lead_time_days as needs_restock from (
            select i.product_id, product_name, category, i.country, stock_now, stock_min,
                coalesce(daily_demand, 0.0) as daily_demand,
                case when daily_demand > 0 then round(stock_now / daily_demand, 1) end as coverage_days,
                lead_time_days
            from inventory i left join demand using (product_id, country)
                left join products using (product_id))""",
        ("inventory", "demand", "products"),
    ),
    "series": (
        "select day, country, sum(amount) as amount, sum(units)::bigint as units from daily group by 1, 2",
        ("daily",),
    ),
    "tx0": (
        f"""select event_id, user_id, event_type, ts, value::decimal(18,2) as v,
            {bucket("concat(event_id, 'p')", 1000)} as e, {bucket("concat(event_id, 'h')", 100)} as h,
            {bucket("concat(event_id, 'd')", 100)} as d, {bucket("concat(user_id, 'r')", 100)} as r,
            {bucket("concat(event_id, 'm')", 1000)} as m
        from events""",
        (),
    ),
    "tx1": (
        f"""select concat('TX', event_id) as tx_id, user_id as customer_id,
            concat('4539-', lpad({bucket("concat(user_id, 'a')", 10000)}::varchar, 4, '0'), '-',
                lpad({bucket("concat(user_id, 'b')", 10000)}::varchar, 4, '0'), '-',
                lpad({bucket("concat(user_id, 'c')", 10000)}::varchar, 4, '0')) as card_number,
            event_type as merchant_category,
            case when e < 960 then 'CO' when e < 980 then 'US' when e < 992 then 'MX' else 'PA' end as country,
            case when e < 960 then 'COP' else 'USD' end as currency,
            case when h < 50 then 'in_person' when h < 77 then 'online' when h < 95 then 'mobile' else 'atm' end
                as channel,
            case when r < 28 then 'north' when r < 77 then 'center' else 'south' end as region,
            strftime(ts, '%Y-%m-%d %H:%M:%S') as occurred_at, d,
            case when (h >= 50 and h < 95 and d < 96) or d < 18 then concat('D', user_id) end as device_id,
            case when m < 13 then 0::decimal(18,2) when m < 20 then -v else v end as amount, v as value
        from tx0""",
        ("tx0",),
    ),
    "tx2": (
        """select tx1.*, cast(value::double / mean as decimal(18,6)) as relative,
            cast(cast(value::double / mean as decimal(18,6)) * 1000000 as bigint)
            + case when country <> 'CO' then 2500000 else 0 end
            + case when substring(occurred_at, 12, 2)::int between 2 and 5 then 2000000 else 0 end
            + case channel when 'online' then 1200000 when 'atm' then 800000 else 0 end as risk
        from tx1 join (select event_type as merchant_category,
                sum(value::decimal(18,2))::double / count(value)::double as mean
            from events group by 1) using (merchant_category)""",
        ("tx1",),
    ),
    "tx": (
        "select *, risk::double > (select quantile_cont(risk::double, 0.985) from tx2) as is_fraud from tx2",
        ("tx2",),
    ),
    "customers": (
        f"""select c_custkey as customer_id, c_mktsegment as segment,
            1 + {bucket("concat('t', c_custkey)", 178)} as tenure_months,
            case when {bucket("concat(c_custkey, 'r')", 100)} < 28 then 'north'
                when {bucket("concat(c_custkey, 'r')", 100)} < 77 then 'center' else 'south' end as region,
            18 + {bucket("concat('g', c_custkey)", 71)} as age,
            300 + {bucket("concat('s', c_custkey)", 551)} as credit_score
        from customer""",
        (),
    ),
    "tx_refined": (
        """select tx_id, customer_id, card_number, amount, currency, merchant_category, channel, country, tx.region,
            occurred_at::timestamp as occurred_at, is_fraud, segment, tenure_months, credit_score
        from tx left join customers using (customer_id)""",
        ("tx", "customers"),
    ),
    "silver_tx": ("select * from tx_refined where tx_id is not null and amount > 0", ("tx_refined",)),
    "risk_daily": (
        f"""select *, {ratio('frauds', 'transactions', 4)} as fraud_rate,
            {ratio('total_amount', 'transactions', 0)} as average_ticket from (
            select occurred_at::date as day, region, merchant_category, count(*) as transactions,
                round(sum(amount), 0)::double as total_amount, count_if(is_fraud)::bigint as frauds,
                round(sum(case when is_fraud then amount else 0 end), 0)::double as fraud_amount
            from silver_tx group by 1, 2, 3)""",
        ("silver_tx",),
    ),
    "means": (
        """select merchant_category, sum(amount)::double / count(amount)::double as category_mean
        from silver_tx group by 1""",
        ("silver_tx",),
    ),
    "suspects": (
        """select s.*, amount::double > 3.0::double * category_mean as high, country <> 'CO' as foreign_country
        from silver_tx s join means using (merchant_category)
        where amount::double > 3.0::double * category_mean or country <> 'CO'""",
        ("silver_tx", "means"),
    ),
}


def sql(text: str, *names: str, **extra: str) -> str:
    """``text`` after the named expressions and all that they need; ``extra`` adds local ones."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in CTES[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    parts = [f"{n} as ({CTES[n][0]})" for n in order] + [f"{n} as ({t})" for n, t in extra.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + text


def money(*columns: str) -> str:
    return ", ".join(f"{c}::double as {c}" for c in columns)
