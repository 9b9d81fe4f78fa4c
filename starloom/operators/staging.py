"""The pass-through and cleaning layers.

Each model is one list of SQL expressions, used both by the lazy DataFrame functions here and by
the persistent views the jobs create, so there is a single definition of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.schemas import ARTICLES, INGESTION_TS, TRANSACTIONS

RAW_ARTICLES = ARTICLES.fieldNames() + [INGESTION_TS]
RAW_TRANSACTIONS = TRANSACTIONS.fieldNames() + [INGESTION_TS]
RAW_CUSTOMERS = [
    "customer_id",
    "FN as fn",
    "Active as active",
    "club_member_status",
    "fashion_news_frequency",
    "age",
    "postal_code",
    INGESTION_TS,
]

# The columns of the cleaned layer and where each comes from.
STG_TRANSACTIONS = [
    "cast(t_dat as date) as sale_date",
    "customer_id",
    "article_id",
    "cast(price as decimal(12,8)) as price",
    "cast(sales_channel_id as tinyint) as sales_channel_id",
    INGESTION_TS,
]
STG_ARTICLES = [
    "article_id",
    "cast(product_code as int) as product_code",
    "prod_name as product_name",
    "product_type_name",
    "product_group_name",
    "graphical_appearance_name",
    "colour_group_name",
    "perceived_colour_value_name",
    "perceived_colour_master_name",
    "department_name",
    "index_name",
    "index_group_name",
    "section_name",
    "garment_group_name",
    "detail_desc as detail_description",
]
# A missing flag means "not opted in". Any spelling of "none" becomes NONE; real nulls stay null.
# bround: a fractional age rounds half to even before it narrows, where a bare cast would truncate.
STG_CUSTOMERS = [
    "customer_id",
    "cast(coalesce(fn, 0) as boolean) as has_fashion_news",
    "cast(coalesce(active, 0) as boolean) as is_active",
    "club_member_status",
    "case when upper(fashion_news_frequency) = 'NONE' then 'NONE'"
    " else fashion_news_frequency end as fashion_news_frequency",
    "cast(bround(age) as smallint) as age",
    "postal_code",
]

# view name -> (name it reads, its columns), per layer
RAW_VIEWS = {
    "raw_articles": ("articles", RAW_ARTICLES),
    "raw_transactions": ("transactions", RAW_TRANSACTIONS),
    "raw_customers": ("customers", RAW_CUSTOMERS),
}
STG_VIEWS = {
    "stg_articles": ("raw_articles", STG_ARTICLES),
    "stg_transactions": ("raw_transactions", STG_TRANSACTIONS),
    "stg_customers": ("raw_customers", STG_CUSTOMERS),
}


def raw_articles(landing: DataFrame) -> DataFrame:
    return landing.selectExpr(*RAW_ARTICLES)


def raw_transactions(landing: DataFrame) -> DataFrame:
    return landing.selectExpr(*RAW_TRANSACTIONS)


def raw_customers(landing: DataFrame) -> DataFrame:
    return landing.selectExpr(*RAW_CUSTOMERS)


def stg_articles(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*STG_ARTICLES)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Casts only. Repeated rows are repeat purchases and are kept."""
    return raw.selectExpr(*STG_TRANSACTIONS)


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*STG_CUSTOMERS)
