"""SQL for each query, written for DuckDB over the same order tables."""

from __future__ import annotations

import re

from starloom.schemas import ARTICLES

RUN = "timestamp '2019-03-01 12:00:00'"
LATER = "timestamp '2019-04-01 12:00:00'"
INGESTED = "timestamp '2019-03-01 12:00:00'"
NULL_KEY = "'_dbt_utils_surrogate_key_null_'"
IN_MONTH = "between date '2021-05-01' and date '2021-05-31'"


def _id(column: str) -> str:
    return f"lpad(cast({column} as varchar), 10, '0')"


def _sk(column: str) -> str:
    return f"md5(coalesce(cast({column} as varchar), {NULL_KEY}))"


def _transactions(price: str) -> str:
    return f"""
        select cast(cast(o_orderdate as date) + interval '24' year as date) as t_dat,
               {_id('o_custkey')} as customer_id,
               {_id('l_partkey')} as article_id,
               {price} as price,
               case when l_linestatus = 'F' then 1 else 2 end as sales_channel_id,
               {INGESTED} as ingestion_ts
        from lineitem join orders on l_orderkey = o_orderkey"""


def _article_columns(sources: dict[str, str]) -> str:
    return ", ".join(
        f"{sources.get(name, 'cast(null as varchar)')} as {name}" for name in ARTICLES.names
    )


_PART = {
    "article_id": _id("p_partkey"),
    "product_code": "cast(p_partkey as integer)",
    "prod_name": "p_name",
    "product_type_name": "p_type",
    "product_group_name": "p_brand",
    "department_name": "'D' || cast(p_size as varchar)",
    "detail_desc": "p_name || ' \"' || p_brand || '\",' || chr(10) || p_type",
}
_SUPPLIER = {
    "article_id": "'S' || lpad(cast(s_suppkey as varchar), 9, '0')",
    "product_code": "cast(s_suppkey as integer)",
    "prod_name": "s_name",
}


def _history(snapshot: str) -> str:
    return f"""
        select md5(article_id || '-' || cast(dbt_valid_from as varchar)) as price_version_sk,
               article_id, median_price, price_month,
               dbt_valid_from as valid_from, dbt_valid_to as valid_to,
               dbt_valid_to is null as is_current
        from {snapshot}"""


def _open(source: str, run: str) -> str:
    return f"""
        select article_id, price_month, median_price,
               md5(article_id || '|' || cast({run} as varchar)) as dbt_scd_id,
               {run} as dbt_updated_at, {run} as dbt_valid_from,
               cast(null as timestamp) as dbt_valid_to
        from {source}"""


def _monthly(transactions: str) -> str:
    return f"""
        select article_id, cast(date_trunc('month', t_dat) as date) as price_month,
               median(price) as median_price
        from {transactions} group by 1, 2"""


def _latest(monthly: str) -> str:
    return f"""
        select article_id, price_month, median_price from {monthly}
        qualify row_number() over (partition by article_id order by price_month desc) = 1"""


def _stg(transactions: str) -> str:
    return f"""
        select cast(t_dat as date) as sale_date, customer_id, article_id,
               cast(price as decimal(12, 8)) as price,
               cast(sales_channel_id as tinyint) as sales_channel_id, ingestion_ts
        from {transactions}"""


def _fact(stg: str) -> str:
    return f"""
        select {_sk('customer_id')} as customer_sk, {_sk('article_id')} as article_sk,
               {_sk('sales_channel_id')} as channel_sk, sale_date,
               cast(date_trunc('month', sale_date) as date) as sale_month,
               customer_id, article_id, count(*) as quantity,
               cast(sum(price) as decimal(38, 8)) as sales_amount
        from {stg} group by all"""


# Named queries, in the order they build on one another.
_CTES = {
    "tx": _transactions("l_extendedprice / cast(100000.0 as double)"),
    "tx_long": _transactions("l_extendedprice / cast(70001.0 as double)"),
    "tx_rounded": _transactions("round(l_extendedprice / cast(100000.0 as double), 0)"),
    "articles": f"""
        select {_article_columns(_PART)}, {INGESTED} as ingestion_ts from part
        union all
        select {_article_columns(_SUPPLIER)}, {INGESTED} from supplier""",
    "customers": f"""
        select {_id('c_custkey')} as customer_id,
               cast(case when c_custkey % 3 = 0 then 1.0 end as double) as fn,
               cast(case when c_custkey % 4 = 0 then 1.0 end as double) as active,
               c_mktsegment as club_member_status,
               case c_custkey % 5 when 0 then 'None' when 1 then 'NONE' when 2 then 'Regularly'
                    when 3 then 'Monthly' end as fashion_news_frequency,
               cast(case when c_custkey % 11 = 0 then null else c_custkey % 131 end as integer)
                   as age,
               md5(c_name) as postal_code, {INGESTED} as ingestion_ts
        from customer""",
    "stg": _stg("tx"),
    "stg_long": _stg("tx_long"),
    "stg_rounded": _stg("tx_rounded"),
    "stg_articles": """
        select article_id, cast(product_code as integer) as product_code,
               prod_name as product_name, product_type_name, product_group_name,
               graphical_appearance_name, colour_group_name, perceived_colour_value_name,
               perceived_colour_master_name, department_name, index_name, index_group_name,
               section_name, garment_group_name, detail_desc as detail_description
        from articles""",
    "stg_customers": """
        select customer_id, cast(coalesce(fn, 0) as boolean) as has_fashion_news,
               cast(coalesce(active, 0) as boolean) as is_active, club_member_status,
               case when upper(fashion_news_frequency) = 'NONE' then 'NONE'
                    else fashion_news_frequency end as fashion_news_frequency,
               cast(age as smallint) as age, postal_code
        from customers""",
    # The two lookups.
    "bands": """
        select band_name, cast(min_age as smallint) as min_age, cast(max_age as smallint) as max_age
        from (values ('16-24', 16, 24), ('25-34', 25, 34), ('35-44', 35, 44), ('45-54', 45, 54),
                     ('55-64', 55, 64), ('65+', 65, 120)) as t(band_name, min_age, max_age)""",
    "channels": """
        select cast(sales_channel_id as tinyint) as sales_channel_id, channel_name
        from (values (1, 'store'), (2, 'online')) as t(sales_channel_id, channel_name)""",
    "monthly": _monthly("tx"),
    "monthly_rounded": _monthly("tx_rounded"),
    "latest": _latest("monthly"),
    "snap": _open("latest", RUN),
    "kept": """
        select * from monthly_rounded
        window article as (partition by article_id order by price_month)
        qualify row_number() over article = 1
             or lag(median_price) over article is distinct from median_price""",
    "replayed": """
        select article_id, price_month, median_price,
               md5(article_id || '|' || cast(cast(price_month as timestamp) as varchar))
                   as dbt_scd_id,
               cast(price_month as timestamp) as dbt_updated_at,
               cast(price_month as timestamp) as dbt_valid_from,
               cast(lead(price_month) over (partition by article_id order by price_month)
                    as timestamp) as dbt_valid_to
        from kept""",
    "history": _history("replayed"),
    "dim_customer": f"""
        select {_sk('customer_id')} as customer_sk, customer_id, has_fashion_news, is_active,
               club_member_status, fashion_news_frequency, age, band_name as age_band, postal_code
        from stg_customers left join bands on age between min_age and max_age""",
    "dim_channel": f"""
        select {_sk('sales_channel_id')} as channel_sk, sales_channel_id, channel_name
        from channels""",
    "dim_article": f"""
        select {_sk('a.article_id')} as article_sk, a.article_id, product_code, product_name,
               product_type_name, product_group_name, graphical_appearance_name,
               colour_group_name, perceived_colour_value_name, perceived_colour_master_name,
               department_name, index_name, index_group_name, section_name, garment_group_name,
               s.median_price as current_price
        from stg_articles a
        left join (select * from snap where dbt_valid_to is null) s using (article_id)""",
    "fact": _fact("stg"),
    "calendar": """
        select cast(unnest(generate_series(date '2018-09-01', date '2099-12-31',
                                           interval 1 day)) as date) as date_day""",
}


def _sql(body: str, **others: str) -> str:
    """The body with the named queries it needs, directly or through one another.

    `others` replace named queries.
    """
    known = {**_CTES, **others}
    needed, text = [], body
    for name in reversed(known):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += known[name]
    return "with " + ",\n".join(f"{n} as ({known[n]})" for n in needed) + "\n" + body


_ATTRIBUTES = """cast(extract(year from {0}) as integer) as year,
    cast(extract(quarter from {0}) as integer) as quarter,
    cast(extract(month from {0}) as integer) as month,
    strftime({0}, '%B') as month_name,
    cast(extract(isodow from {0}) as integer) as iso_weekday,
    strftime({0}, '%A') as weekday_name,
    extract(isodow from {0}) in (6, 7) as is_weekend"""

_PER_DAY = "(select sale_date as date_day, count(*) as n_sales from stg group by 1)"

_STAR = """
    select cast(extract(year from sale_date) as integer) as year,
           cast(extract(month from sale_date) as integer) as month, age_band, channel_name,
           cast(sum(quantity) as bigint) as quantity,
           cast(sum(sales_amount) as decimal(38, 8)) as sales_amount
    from fact join dim_customer using (customer_sk) join dim_channel using (channel_sk)
    join calendar on sale_date = date_day
    group by all"""

_MONTH_COLUMN = "strftime(t_dat, '%Y-%m') as load_month"

# (name, table, number of failing rows) of the 38 declared checks
_NOT_NULL = "select count(*) from {0} where {1} is null"
_UNIQUE = (
    "select count(*) from (select {1} from {0} where {1} is not null"
    " group by 1 having count(*) > 1)"
)
_REFERS = (
    "select count(*) from {0} c where c.{1} is not null"
    " and not exists (select 1 from {2} p where p.{3} = c.{1})"
)
_RELATION = {
    "raw_articles": "articles",
    "raw_customers": "customers",
    "stg_transactions": "stg",
    "stg_articles": "stg_articles",
    "stg_customers": "stg_customers",
    "dim_date": "calendar",
    "dim_channel": "dim_channel",
    "dim_customer": "dim_customer",
    "dim_article_price_history": f"({_history('snap')})",
    "dim_article": "dim_article",
    "fct_sales": "fact",
}
_KEYS = [
    ("raw_articles", "article_id"),
    ("raw_customers", "customer_id"),
    ("stg_articles", "article_id"),
    ("stg_customers", "customer_id"),
    ("dim_date", "date_day"),
    ("dim_channel", "channel_sk"),
    ("dim_customer", "customer_sk"),
    ("dim_article_price_history", "price_version_sk"),
    ("dim_article", "article_sk"),
]
_REFERENCES = [
    ("stg_transactions", "article_id", "stg_articles", "article_id"),
    ("stg_transactions", "customer_id", "stg_customers", "customer_id"),
    ("fct_sales", "customer_sk", "dim_customer", "customer_sk"),
    ("fct_sales", "article_sk", "dim_article", "article_sk"),
    ("fct_sales", "channel_sk", "dim_channel", "channel_sk"),
    ("fct_sales", "sale_date", "dim_date", "date_day"),
]


def _report_rows() -> list[tuple[str, str, str]]:
    rows = []
    for table, column in _KEYS + [("stg_transactions", "sale_date"),
                                  ("stg_transactions", "sales_channel_id")]:
        rows.append((f"not_null_{table}_{column}", table,
                     _NOT_NULL.format(_RELATION[table], column)))
    for table, column in _KEYS:
        rows.append((f"unique_{table}_{column}", table,
                     _UNIQUE.format(_RELATION[table], column)))
    for table, column, parent, field in _REFERENCES:
        rows.append((f"not_null_{table}_{column}", table,
                     _NOT_NULL.format(_RELATION[table], column)))
        rows.append((f"relationships_{table}_{column}", table,
                     _REFERS.format(_RELATION[table], column, _RELATION[parent], field)))
    rows += [
        ("between_stg_transactions_price", "stg_transactions",
         "select count(*) from stg where price <= 0"),
        ("accepted_values_stg_transactions_sales_channel_id", "stg_transactions",
         "select count(*) from stg where sales_channel_id not in (1, 2)"),
        ("unique_dim_article_price_history_article_id_where_is_current",
         "dim_article_price_history",
         "select count(*) from (select article_id from snap where dbt_valid_to is null"
         " group by 1 having count(*) > 1)"),
        ("between_dim_article_current_price", "dim_article",
         "select count(*) from dim_article where current_price <= 0"),
        ("unique_combination_fct_sales_sale_date_customer_id_article_id_channel_sk", "fct_sales",
         "select count(*) from (select 1 from fact"
         " group by sale_date, customer_id, article_id, channel_sk having count(*) > 1)"),
        ("between_fct_sales_quantity", "fct_sales",
         "select count(*) from fact where quantity < 1"),
    ]
    return rows


def _report() -> str:
    parts = [
        f"select '{name}' as check_name, '{table}' as table_name, ({count}) as failures"
        for name, table, count in _report_rows()
    ]
    return (
        "select *, case when failures = 0 then 'pass' else 'fail' end as status from ("
        + " union all ".join(parts)
        + ")"
    )


_RAW = "t_dat, customer_id, article_id, price, sales_channel_id, ingestion_ts"
_SNAPSHOT_COLUMNS = (
    "article_id, price_month, median_price, dbt_scd_id, dbt_updated_at, dbt_valid_from,"
    " dbt_valid_to"
)


def _group_check(table: str, column: str, alias: str, where: str, having: str = "") -> str:
    return (
        f"select {column} as {alias}, count(*) as n_records from {table} where {where} group by 1"
        + (f" having {having}" if having else "")
    )


def _refers_check(child: str, column: str, parent: str, field: str) -> str:
    return _group_check(
        child, column, "from_field",
        f"{column} is not null and {column} not in (select {field} from {parent}"
        f" where {field} is not null)",
    )


def _second_run(first: str, second: str) -> str:
    """Versions after two runs: the first one's rows, closed where the price moved, and the new ones."""
    return f"""
        select {_SNAPSHOT_COLUMNS} from (
            select f.* replace (case when n.article_id is not null
                                      and n.median_price is distinct from f.median_price
                                 then {LATER} end as dbt_valid_to)
            from {first} f left join {second} n using (article_id)
            union all
            select n.* from ({_open(second, LATER)}) n left join {first} f using (article_id)
            where f.article_id is null or n.median_price is distinct from f.median_price)"""


def _reports(months: list[tuple[str, str, str, str]]) -> str:
    """What the checks say after each month: label, first day sold, first day not sold yet, customers."""
    parts = []
    for month, first, end, customers in months:
        sales = f"select * from sold where t_dat >= date '{first}' and t_dat < date '{end}'"
        parts.append(
            f"select '{month}' as month, * from ({_sql(_report(), tx=sales, customers=customers)})"
        )
    return f"with sold as materialized ({_CTES['tx_rounded']}) " + " union all ".join(parts)


_LACKING = _CTES["customers"] + " where c_custkey % 50 <> 7"


def _every_month() -> str:
    """What the checks say after each of 80 months, from the rows that are there by its end."""
    relation = _RELATION | {
        "stg_transactions": "stg_by", "fct_sales": "fact_by", "dim_article": "article_by",
        "dim_article_price_history": "history_by",
    }
    counts = {}
    for table, column in _KEYS + [("stg_transactions", "sale_date"), ("stg_transactions", "sales_channel_id")]:
        counts[f"not_null_{table}_{column}", table] = f"from {relation[table]} where {column} is null"
    for table, column in _KEYS:
        by = "month, " * (relation[table] != _RELATION[table])
        counts[f"unique_{table}_{column}", table] = (
            f"from (select {by}{column} from {relation[table]} where {column} is not null"
            f" group by {by}{column} having count(*) > 1)"
        )
    for table, column, parent, field in _REFERENCES:
        counts[f"not_null_{table}_{column}", table] = f"from {relation[table]} where {column} is null"
        counts[f"relationships_{table}_{column}", table] = (
            f"from {relation[table]} where {column} is not null"
            f" and {column} not in (select {field} from {_RELATION[parent]} where {field} is not null)"
        )
    grain = "sale_date, customer_id, article_id, channel_sk"
    counts |= {
        ("between_stg_transactions_price", "stg_transactions"): "from stg_by where price <= 0",
        ("accepted_values_stg_transactions_sales_channel_id", "stg_transactions"):
            "from stg_by where sales_channel_id not in (1, 2)",
        ("unique_dim_article_price_history_article_id_where_is_current", "dim_article_price_history"):
            "from (select month, article_id from history_by where valid_to is null or valid_to >= ends"
            " group by 1, 2 having count(*) > 1)",
        ("between_dim_article_current_price", "dim_article"): "from article_by where current_price <= 0",
        ("unique_combination_fct_sales_" + grain.replace(", ", "_"), "fct_sales"):
            f"from (select month, {grain} from fact_by group by all having count(*) > 1)",
        ("between_fct_sales_quantity", "fct_sales"): "from fact_by where quantity < 1",
    }
    parts = []
    for (name, table), found in counts.items():
        month = "month" if relation[table] != _RELATION[table] else "cast(null as varchar)"
        parts.append(
            f"select '{name}' as check_name, '{table}' as table_name, {month} as month,"
            f" count(*) as n {found} group by all"
        )
    names = ", ".join(f"('{name}', '{table}')" for name, table in counts)
    others = {
        "tx": _CTES["tx_rounded"],
        "customers": _LACKING,
        "months": """select strftime(d, '%Y-%m') as month, cast(d + interval 1 month as date) as ends
            from generate_series(date '2019-01-01', date '2025-08-01', interval 1 month) t(d)""",
        "stg_by": "select month, s.* from months join stg s on sale_date < ends",
        "fact_by": "select month, f.* from months join fact f on sale_date < ends",
        "history_by": "select month, ends, h.* from months join history h on valid_from < ends",
        "price_by": """select month, article_id, arg_max(median_price, price_month) as current_price
            from months join monthly on price_month < ends group by all""",
        "article_by": f"""select m.month, {_sk('a.article_id')} as article_sk, current_price from months m
            cross join stg_articles a left join price_by p on p.month = m.month and p.article_id = a.article_id""",
    }
    return _sql(
        f"""select m.month, c.check_name, c.table_name, cast(coalesce(n, 0) as bigint) as failures,
            case when coalesce(n, 0) = 0 then 'pass' else 'fail' end as status
        from months m cross join (values {names}) c(check_name, table_name)
        left join ({" union all ".join(parts)}) f
            on f.check_name = c.check_name and coalesce(f.month, m.month) = m.month""",
        **others,
    )


_BODIES = {
    "csv_typed_scan": f"""select c.customer_id, fn as "FN", active as "Active", club_member_status,
        fashion_news_frequency, age, postal_code, cast(c_custkey % 1000 as bigint) as visits,
        cast(c_acctbal as double) as balance,
        cast(date '2020-01-01' + cast(c_custkey % 365 as integer) as date) as since,
        case when c_custkey % 7 <> 3 then c_custkey % 2 = 0 end as vip,
        case when c_custkey = 1 then 'n/a' else cast(c_custkey as varchar) end as remark
        from customers c join customer on c.customer_id = {_id('c_custkey')}""",
    "csv_to_parquet": """select a.article_id, prod_name, detail_desc, n_rows from articles a left join (select article_id, count(*) as n_rows from tx group by 1) t
        on a.article_id = t.article_id""",
    "load_dimension": f"""select customer_id, fn as "FN", active as "Active", club_member_status,
        fashion_news_frequency, age, postal_code, {RUN} as ingestion_ts from customers""",
    "load_month": f"select {_RAW}, {_MONTH_COLUMN} from tx where t_dat {IN_MONTH}",
    "load_month_rerun": f"""
        select {_RAW}, {_MONTH_COLUMN} from tx_rounded where not t_dat {IN_MONTH}
        union all
        select * replace ({LATER} as ingestion_ts), {_MONTH_COLUMN} from tx
        where t_dat {IN_MONTH}""",
    "load_history": f"select {_RAW}, {_MONTH_COLUMN} from tx",
    "failed_load_keeps_month": f"select {_RAW}, {_MONTH_COLUMN} from tx",
    "dimension_allow_list": """select 'articles' as name, count(*) as n_rows from articles
        union all select 'customers', count(*) from customers
        union all select 'transactions', null""",
    "one_layer": "select * from stg_customers",
    "load_log": f"""
        select 'articles' as table_name, 'full' as "partition", count(*) as "rows",
               {RUN} as loaded_at, 'ok' as status from articles
        union all select 'customers', 'full', count(*), {RUN}, 'ok' from customers
        union all select 'transactions', strftime(t_dat, '%Y-%m'), count(*), {RUN}, 'ok'
                  from tx group by 2
        union all select 'transactions', '2021-05', count(*), {LATER}, 'ok'
                  from tx where t_dat {IN_MONTH}""",
    "month_row_count":
        "select strftime(t_dat, '%Y-%m') as month, count(*) as n_rows from tx group by 1",
    "list_months": "select distinct strftime(t_dat, '%Y-%m') as month from tx",
    "seed_age_bands": """select bands.*, n_customers from bands left join
        (select band_name, count(*) as n_customers from stg_customers join bands
         on age between min_age and max_age group by 1) using (band_name)""",
    "seed_channels": """select channels.*, n_sales from channels left join
        (select sales_channel_id, count(*) as n_sales from stg group by 1)
        using (sales_channel_id)""",
    "seeds_from_csv": """select band_name as age_band, count(*) as n_customers,
        (select count(*) from channels) as n_channels
        from stg_customers left join bands on age between min_age and max_age group by 1""",
    "fct_sales_rebuild_month": f"""
        select * from ({_fact('stg_rounded')}) where sale_month <> date '2021-05-01'
        union all select * from fact where sale_month = date '2021-05-01'""",
    "raw_articles": "select * from articles",
    "raw_transactions": f"select {_RAW} from tx",
    "raw_customers": "select * from customers",
    "stg_articles": "select * from stg_articles",
    "stg_transactions": "select * from stg",
    "stg_customers": "select * from stg_customers",
    "stg_transactions_long_price": "select * from stg_long",
    "month_filter": f"select {_RAW} from tx where t_dat {IN_MONTH}",
    "surrogate_key_single": f"""select customer_id, {_sk('customer_id')} as customer_sk,
        {_sk('fashion_news_frequency')} as nullable_sk from stg_customers""",
    "surrogate_key_multi": "select customer_id, md5(" + " || '-' || ".join(
        f"coalesce(cast({c} as varchar), {NULL_KEY})"
        for c in ("customer_id", "age", "fashion_news_frequency", "ingestion_ts")
    ) + ") as sk from customers",
    "date_spine": "select date_day from calendar where date_day not in (select sale_date from stg)",
    "date_attributes":
        f"select customer_id, article_id, sale_date, {_ATTRIBUTES.format('sale_date')} from stg",
    "monthly_median_price": "select * from monthly",
    "median_by_rank":
        "select sales_channel_id, median(price) as median_price from tx group by 1",
    "latest_median_price": "select * from latest",
    "snapshot_first_run": "select * from snap",
    "snapshot_one_change": _second_run("first_run", "second_run"),
    "snapshot_vanished_key": _second_run("whole_run", "vanished_run"),
    "snapshot_replay": "select * from replayed",
    "current_price":
        "select article_id, median_price as current_price from replayed"
        " where dbt_valid_to is null",
    "dim_date": f"""select date_day, {_ATTRIBUTES.format('date_day')},
        coalesce(n_sales, 0) as n_sales from calendar left join {_PER_DAY} using (date_day)""",
    "dim_channel": """select c.*, quantity, sales_amount from dim_channel c left join
        (select channel_sk, cast(sum(quantity) as bigint) as quantity,
                cast(sum(sales_amount) as decimal(38, 8)) as sales_amount
         from fact group by 1) using (channel_sk)""",
    "dim_customer": "select * from dim_customer",
    "dim_article": "select * from dim_article",
    "dim_article_price_history": "select * from history",
    "run_month_out_of_order": "select * from history",
    "fct_sales": "select * from fact",
    "fct_sales_month": "select * from fact where sale_month = date '2021-05-01'",
    "sales_between":
        "select * from fact where sale_date >= date '2021-03-15' and sale_date < date '2021-09-10'",
    "article_price_versions": """select article_id, product_name, product_group_name, median_price,
        price_month, valid_from, valid_to, is_current
        from stg_articles join history using (article_id)""",
    "star_sales_by_month_band_channel": _STAR,
    "dq_not_null": "select * from stg_customers where fashion_news_frequency is null",
    "dq_unique": _group_check("stg", "customer_id", "unique_field", "customer_id is not null",
                              "count(*) > 1"),
    "dq_unique_passing": _group_check("stg_customers", "customer_id", "unique_field",
                                      "customer_id is not null", "count(*) > 1"),
    "dq_unique_where": _group_check("history", "article_id", "unique_field", "not is_current",
                                    "count(*) > 1"),
    "dq_unique_combination": """select sale_date, customer_id, article_id, sales_channel_id,
        count(*) as n_records from stg group by 1, 2, 3, 4 having count(*) > 1""",
    "dq_accepted_values": _group_check(
        "stg_customers", "fashion_news_frequency", "value_field",
        "fashion_news_frequency not in ('NONE', 'Regularly')"),
    "dq_between_strict": "select * from stg_rounded where price <= 0",
    "dq_between_inclusive": "select * from fact where quantity < 2",
    "dq_relationships_article": _refers_check("stg", "article_id", "stg_articles", "article_id"),
    "dq_relationships_customer":
        _refers_check("fact", "customer_sk", "dim_customer", "customer_sk"),
    "dq_relationships_unsold": _refers_check("stg_articles", "article_id", "fact", "article_id"),
    "dq_relationships_date": _refers_check(
        "fact", "sale_date", "(select * from calendar where date_day < date '2024-01-01')",
        "date_day"),
    "dq_report": _report(),
    "source_freshness": f"""
        select source_name, max_loaded_at,
               case when max_loaded_at >= {RUN} - interval 48 hour then 'pass' else 'warn' end
                   as status
        from (select 'transactions' as source_name, max(o_orderdate) as max_loaded_at from orders
              union all select 'articles', max(ingestion_ts) from articles
              union all select 'empty', max(o_orderdate) from orders
                        where o_orderdate > timestamp '2100-01-01')""",
    "build_all": _STAR,
    "run_month": _history("month_snap"),
    "run_month_twice": _history("(" + _second_run("may", "may_june") + ")"),
    "replay_history": f"""select {_sk('a.article_id')} as article_sk, a.article_id, product_name,
        r.median_price as current_price from stg_articles a
        left join (select * from replayed where dbt_valid_to is null) r using (article_id)""",
}

_CTES["first_run"] = _open(
    "(" + _latest("(select * from monthly_rounded where price_month < date '2022-01-01')") + ")",
    RUN,
)
_CTES["second_run"] = _latest("monthly_rounded")
_CTES["whole_run"] = _open("second_run", RUN)
_CTES["vanished_run"] = _latest(
    "(select * from monthly_rounded where price_month < date '2022-01-01'"
    " and cast(article_id as int) % 7 <> 0)"
)
_CTES["may"] = _open(
    "(" + _latest("(select * from monthly_rounded where price_month = date '2021-05-01')") + ")", RUN
)
_CTES["may_june"] = _latest(
    "(select * from monthly_rounded where price_month in (date '2021-05-01', date '2021-06-01'))"
)
_CTES["month_snap"] = _open(
    "(" + _latest("(" + _monthly(f"(select * from tx where t_dat {IN_MONTH})") + ")") + ")", RUN
)

ORACLES = {name: _sql(body) for name, body in _BODIES.items()}
ORACLES["run_month_reports"] = _reports(
    [
        ("2021-05", "2021-05-01", "2021-06-01", _CTES["customers"]),
        ("2021-06", "2021-05-01", "2021-07-01", _LACKING),
    ]
)
ORACLES["replay_months"] = _every_month()
