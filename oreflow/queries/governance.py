"""Row filters, masks, tags and the sensitive-data scan on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.operators.classify import classify_tables, kind_tags, policies_from_tags
from oreflow.operators.governance import (
    SENSITIVE_PATTERNS,
    Identity,
    Policy,
    by_attribute,
    by_group,
    find_tagged,
    mask_card,
    mask_to_null,
    policy_from_tags,
    secure,
    sensitive_scan,
    tag_frame,
)
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import sql

ANA = Identity("ana", frozenset({"analysts", "p_ASIA"}), {"countries": ("ASIA",)})
BEN = Identity("ben", frozenset({"finance", "p_EUROPE", "p_AFRICA"}), {"countries": ("EUROPE", "AFRICA")})
CLASS_TABLES = ("transactions", "customers", "products")


def _as_seen(df: DataFrame, policy: Policy, *columns) -> DataFrame:
    """The same query for two callers."""
    seen = [
        secure(df, policy, who).select(F.lit(who.name).alias("caller"), *columns) for who in (ANA, BEN)
    ]
    return seen[0].unionAll(seen[1])


def _by_country(df: DataFrame) -> DataFrame:
    return df.groupBy("caller", "country").agg(F.count("*").alias("rows"))


def _row_filter(t: Layers):
    policy = Policy(row_filter=by_attribute("country", "countries"))
    return _by_country(_as_seen(t.inventory(), policy, "country"))


def _group_filter(t: Layers):
    return _by_country(_as_seen(t.inventory(), Policy(row_filter=by_group("country", "p_")), "country"))


def _mask_null(t: Layers):
    policy = Policy(masks={"unit_cost": mask_to_null}, unmasked_groups=frozenset({"finance"}))
    return _as_seen(t.products(), policy, "product_id", "unit_cost")


def _removed(t: Layers):
    """Distinct countries with the policy, and after it is taken away."""
    stock = t.inventory()
    limited = secure(stock, Policy(row_filter=by_attribute("country", "countries")), ANA)
    seen = lambda df, name: df.select("country").distinct().agg(F.count("*").alias("countries")).select(
        F.lit(name).alias("state"), "countries"
    )
    return seen(limited, "filtered").unionAll(seen(secure(stock, Policy(), ANA), "removed"))


def _scans(t: Layers) -> DataFrame:
    out = None
    for name in CLASS_TABLES:
        scan = sensitive_scan(getattr(t, name)(), name)
        out = scan if out is None else out.unionAll(scan)
    return out


def _tags(t: Layers) -> DataFrame:
    """Tags that the scan of the tables sets: the class of each sensitive column."""
    found = _scans(t).filter("sensitive")
    kinds = found.select("table_name", "column_name", F.lit("kind").alias("tag_name"), F.col("kind").alias("tag_value"))
    marks = found.select(
        "table_name", "column_name", F.lit("classification").alias("tag_name"), F.lit("pii").alias("tag_value")
    )
    return kinds.unionAll(marks)


def _abac(t: Layers):
    policy = policy_from_tags(_tags(t), "transactions", {"card": mask_card}, frozenset({"fraud_desk"}))
    return secure(t.transactions(), policy, ANA).select("tx_id", "card_number", "customer_id")


def _sql_functions(t: Layers):
    """A row filter and a mask as SQL functions, used in plain SQL."""
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION oreflow_may_see(country STRING) RETURNS BOOLEAN RETURN country = 'CO'"
    )
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION oreflow_hide_card(card STRING) RETURNS STRING "
        "RETURN concat('****-****-****-', substring(card, -4, 4))"
    )
    t.transactions().createOrReplaceTempView("oreflow_transactions")
    return t.spark.sql(
        "SELECT tx_id, oreflow_hide_card(card_number) AS card_number FROM oreflow_transactions "
        "WHERE oreflow_may_see(country)"
    )


def _tagged_by_hand(t: Layers):
    """Tags set by hand for the card column, joined to what the scan found."""
    tags = tag_frame(t.spark, [("transactions", "card_number", "owner", "risk_team")]).unionAll(_tags(t))
    return find_tagged(tags, "pii")


def _check_digit(payload):
    """The digit that completes a text of fifteen digits."""
    places = F.sequence(F.lit(1), F.lit(15))
    digit = lambda i: F.substring(payload, i, F.lit(1)).cast("int")
    weighed = lambda i: F.when(i % 2 == 1, digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)).otherwise(digit(i))
    total = F.aggregate(F.transform(places, weighed), F.lit(0), lambda s, x: s + x)
    return ((10 - total % 10) % 10).cast("string")


def _payments(t: Layers) -> DataFrame:
    """Orders with a card number without dashes, a number of 16 digits that is none, and contacts."""
    key = F.col("o_orderkey").cast("string")
    payload = F.concat(F.lit("453900"), F.lpad(key, 9, "0"))
    return t.orders.select(
        key.alias("note"),
        F.concat(payload, _check_digit(payload)).alias("paid_with"),
        F.concat(F.lit("70000000"), F.lpad(key, 8, "0")).alias("order_number"),
        F.concat(F.lit("+57 300 "), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit(" 1234")).alias("contact"),
        F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@shop.example")).alias("mailbox"),
        F.concat(F.lit("10.0."), F.col("o_custkey") % 512, F.lit(".7")).alias("address"),
    )


def _classified(t: Layers) -> DataFrame:
    tables = {"transactions": t.transactions(), "customers": t.customers(), "payments": _payments(t)}
    return classify_tables(tables).select("table_name", "column_name", "kind", "filled", "sensitive")


def _all_masked(t: Layers) -> DataFrame:
    """Card columns of every table, masked by the class that the scan found."""
    tables = {"transactions": t.transactions(), "payments": _payments(t)}
    policies = policies_from_tags(kind_tags(classify_tables(tables)), {"card": mask_card}, frozenset({"fraud_desk"}))
    seen = {name: secure(df, policies[name], ANA) for name, df in tables.items()}
    of_tx = seen["transactions"].select(F.lit("transactions").alias("table_name"), F.col("tx_id").alias("id"), F.col("card_number").alias("card"))
    return of_tx.unionAll(seen["payments"].select(F.lit("payments"), "note", "paid_with"))


QUERIES = {
    "row_filter": query(_row_filter),
    "row_filter_groups": query(_group_filter),
    "mask_null": query(_mask_null),
    "policy_removed": query(_removed),
    "pii_scan": query(_scans),
    "pii_classes": query(_classified),
    "abac_all_tables": query(_all_masked),
    "find_tagged": query(_tagged_by_hand),
    "abac_mask": query(_abac),
    "sql_udf": query(_sql_functions),
}

_TEXT_COLUMNS = {
    "transactions": (
        "tx1",
        "tx_id card_number merchant_category country currency channel region occurred_at device_id".split(),
    ),
    "customers": ("customers", ["segment", "region"]),
    "products": ("products", ["product_name", "category", "brand"]),
}
_SEEN = """select caller, country, count(*) as rows from (
        select 'ana' as caller, country from inventory where country = 'ASIA'
        union all select 'ben', country from inventory where country in ('EUROPE', 'AFRICA')) group by 1, 2"""

SQL = {
    "row_filter": sql(_SEEN, "inventory"),
    "row_filter_groups": sql(_SEEN, "inventory"),
    "mask_null": sql(
        """select 'ana' as caller, product_id, null::double as unit_cost from products
        union all select 'ben', product_id, unit_cost::double from products""",
        "products",
    ),
    "policy_removed": sql(
        """select 'filtered' as state, count(distinct country) as countries from inventory where country = 'ASIA'
        union all select 'removed', count(distinct country) from inventory""",
        "inventory",
    ),
    "pii_scan": sql(
        " union all ".join(
            f"""select '{name}' as table_name, '{c}' as column_name, '{kind}' as kind, count({c}) as filled,
            count_if(regexp_matches({c}, '{pattern}'))::bigint as hits,
            coalesce(count_if(regexp_matches({c}, '{pattern}'))::double / nullif(count({c}), 0) >= 0.8, false) as sensitive
            from {source}"""
            for name, (source, columns) in _TEXT_COLUMNS.items()
            for c in columns
            for kind, pattern in SENSITIVE_PATTERNS.items()
        ),
        "tx1",
        "customers",
        "products",
    ),
    "find_tagged": sql(
        """select 'transactions' as table_name, 'card_number' as column_name, 'classification' as tag_name,
        'pii' as tag_value from tx1 having count_if(regexp_matches(card_number, '^[0-9]{4}(-[0-9]{4}){3}$')) >= 0.8 * count(*)""",
        "tx1",
    ),
    "abac_mask": sql(
        "select tx_id, concat('****-****-****-', right(card_number, 4)) as card_number, customer_id from tx1", "tx1"
    ),
    "sql_udf": sql(
        """select tx_id, concat('****-****-****-', right(card_number, 4)) as card_number from tx1
        where country = 'CO'""",
        "tx1",
    ),
}

# Independent of the classifier: what each class asks, per value, in the other engine's words.
_SHAPED = {
    "card": "regexp_full_match(v, '[0-9]([ -]?[0-9]){12,18}')",
    "email": r"regexp_full_match(v, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}')",
    "ip_address": r"""(regexp_full_match(v, '[0-9]{1,3}(\.[0-9]{1,3}){3}')
        and list_max(list_transform(string_split(v, '.'), lambda x: coalesce(try_cast(x as int), 999))) <= 255)""",
    "phone": r"regexp_full_match(v, '\+?[0-9][0-9 ().-]{5,17}[0-9]')",
}
_LUHN = """list_sum(list_transform(range(1, length(regexp_replace(v, '[ -]', '', 'g')) + 1), lambda i:
    case when i % 2 = 0 then [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][try_cast(reverse(regexp_replace(v, '[ -]', '', 'g'))[i] as int) + 1]
    else try_cast(reverse(regexp_replace(v, '[ -]', '', 'g'))[i] as int) end)) % 10 = 0"""
_MORE = {
    "card": [
        "regexp_matches(v, '^[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}$') or regexp_matches(v, '^[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}$')",
        f"case when {_SHAPED['card']} then {_LUHN} else false end",
    ],
    "phone": [
        r"regexp_matches(v, '^\+[0-9]')",
        r"regexp_matches(v, '^\+?[0-9]{0,3}[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{3,4}$')",
        "regexp_matches(lower(c), '(^|[^a-z0-9])(phone|mobile|tel)([^a-z0-9]|$)')",
    ],
}
_PAYLOAD = "'453900' || lpad(o_orderkey::varchar, 9, '0')"
_PAYMENTS = f"""select o_orderkey::varchar as note,
    payload || ((10 - list_sum(list_transform(range(1, 16), lambda i: case when i % 2 = 1
        then [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][payload[i]::int + 1] else payload[i]::int end)) % 10) % 10)::bigint::varchar as paid_with,
    '70000000' || lpad(o_orderkey::varchar, 8, '0') as order_number,
    '+57 300 ' || lpad((o_custkey % 1000)::varchar, 3, '0') || ' 1234' as contact,
    'c' || o_custkey || '@shop.example' as mailbox, '10.0.' || (o_custkey % 512) || '.7' as address
    from (select *, {_PAYLOAD} as payload from orders)"""


def _class_sql() -> str:
    texts = {
        "transactions": "tx_id card_number merchant_category country currency channel region occurred_at device_id".split(),
        "customers": ["segment", "region"],
        "payments": "note paid_with order_number contact mailbox address".split(),
    }
    rows = []
    for table, source in (("transactions", "tx1"), ("customers", "customers"), ("payments", "payments")):
        listed = ", ".join(f"{c}::varchar as {c}" for c in texts[table])
        rows.append(f"select '{table}' as tbl, c, trim(v) as v from (unpivot (select {listed} from {source}) on columns(*) into name c value v)")
    kinds = []
    for kind, shape in _SHAPED.items():
        rates = [f"avg(case when {x} then 1.0 else 0 end) >= 0.8" for x in _MORE.get(kind, ["true"])]
        kinds.append(
            f"""select tbl as table_name, c as column_name, '{kind}' as kind, count(*) as filled,
            avg(case when {shape} then 1.0 else 0 end) >= 0.8 and ({' or '.join(rates)}) as sensitive from texts group by 1, 2"""
        )
    return f"select * from (with texts as ({' union all '.join(rows)}) {' union all '.join(kinds)})"


SQL["pii_classes"] = sql(_class_sql(), "tx1", "customers", payments=_PAYMENTS)
SQL["abac_all_tables"] = sql(
    """select 'transactions' as table_name, tx_id as id, '****-****-****-' || right(card_number, 4) as card from tx1
    union all select 'payments', note, '****-****-****-' || right(paid_with, 4) from payments""",
    "tx1",
    payments=_PAYMENTS,
)
