"""The retail landing shapes, derived from the order tables that the checks run on.

Every mapping is plain SQL that Spark and DuckDB both run, so queries and their reference SQL
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import ARTICLES, INGESTION_TS

INGESTED = "2019-03-01 12:00:00"

_ID = "lpad(cast({0} as varchar(20)), 10, '0')"

TRANSACTION_COLUMNS = [
    # The order dates, moved into the years of the date dimension. Leap years keep step.
    "cast(cast(o_orderdate as date) + interval '24' year as date) as t_dat",
    _ID.format("o_custkey") + " as customer_id",
    _ID.format("l_partkey") + " as article_id",
    "l_extendedprice / 100000.0D as price",
    "case when l_linestatus = 'F' then 1 else 2 end as sales_channel_id",
]
# Prices rounded to few distinct values, so that an article's median can stay equal for months.
REPEATED_PRICE = "round(l_extendedprice / 100000.0D, 0) as price"
# Prices with as many decimals as a double holds, so that the cast to a decimal has to round.
LONG_PRICE = "l_extendedprice / 70001.0D as price"

CUSTOMER_COLUMNS = [
    _ID.format("c_custkey") + " as customer_id",
    "cast(case when c_custkey % 3 = 0 then 1.0 end as double) as FN",
    "cast(case when c_custkey % 4 = 0 then 1.0 end as double) as Active",
    "c_mktsegment as club_member_status",
    "case c_custkey % 5 when 0 then 'None' when 1 then 'NONE' when 2 then 'Regularly'"
    " when 3 then 'Monthly' end as fashion_news_frequency",
    "cast(case when c_custkey % 11 = 0 then null else c_custkey % 131 end as int) as age",
    "md5(c_name) as postal_code",
]

_ARTICLE_SOURCES = {
    "article_id": _ID.format("p_partkey"),
    "product_code": "cast(p_partkey as int)",
    "prod_name": "p_name",
    "product_type_name": "p_type",
    "product_group_name": "p_brand",
    "department_name": "concat('D', cast(p_size as varchar(20)))",
    "detail_desc": "concat(p_name, ' \"', p_brand, '\",', chr(10), p_type)",
}
ARTICLE_COLUMNS = [
    f"{_ARTICLE_SOURCES.get(name, 'cast(null as varchar(20))')} as {name}"
    for name in ARTICLES.names
]
# One article per supplier that no order line mentions, so that some articles have no price.
_UNSOLD_SOURCES = {
    "article_id": "concat('S', lpad(cast(s_suppkey as varchar(20)), 9, '0'))",
    "product_code": "cast(s_suppkey as int)",
    "prod_name": "s_name",
}
UNSOLD_COLUMNS = [
    f"{_UNSOLD_SOURCES.get(name, 'cast(null as varchar(20))')} as {name}"
    for name in ARTICLES.names
]


# Columns that no contract names, as a CSV file might add them; one value of the last is no number.
UNDECLARED_COLUMNS = [
    "c_custkey % 1000 as visits",
    "c_acctbal as balance",
    "date_add(date'2020-01-01', cast(c_custkey % 365 as int)) as since",
    "case when c_custkey % 7 <> 3 then c_custkey % 2 = 0 end as vip",
    "case when c_custkey = 1 then 'n/a' else cast(c_custkey as string) end as remark",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, price: str | None = None) -> DataFrame:
    """Landing transactions, with another price expression if one is given."""
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    columns = list(TRANSACTION_COLUMNS)
    if price is not None:
        columns[3] = price
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(*columns)


def customers(spark: SparkSession, sf_dir: str, more: list[str] = ()) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_COLUMNS, *more)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = _table(spark, sf_dir, "part").selectExpr(*ARTICLE_COLUMNS)
    return sold.unionByName(_table(spark, sf_dir, "supplier").selectExpr(*UNSOLD_COLUMNS))


def landed(rows: DataFrame) -> DataFrame:
    """Rows as the landing layer holds them, stamped with a fixed time."""
    return rows.withColumn(INGESTION_TS, F.lit(INGESTED).cast("timestamp_ntz"))
