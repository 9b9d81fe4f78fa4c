"""Dimensions, the sales fact and the star join."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import (
    date_attributes,
    date_spine,
    in_month,
    month_start,
    surrogate_key,
    surrogate_key_sql,
)
from starloom.schemas import VALID_FROM, VALID_TO

# The calendar covered by the date dimension, end excluded.
CALENDAR_START = date(2018, 9, 1)
CALENDAR_END = date(2100, 1, 1)

# The attributes of the article dimension, in order.
ARTICLE_ATTRIBUTES = [
    "article_id",
    "product_code",
    "product_name",
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
]


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    return date_spine(spark, start, end).select("date_day", *date_attributes("date_day"))


def dim_channel(channels: DataFrame) -> DataFrame:
    return channels.select(
        surrogate_key("sales_channel_id").alias("channel_sk"), "sales_channel_id", "channel_name"
    )


def dim_customer(customers: DataFrame, age_bands: DataFrame) -> DataFrame:
    """Customers with the band their age falls in, both ends included; no band gives null.

    Ages are whole numbers, so each band is spelled out as one row per age and the range join
    becomes an equi-join. That lookup is bounded by the 65,536 smallint values per band, hence
    the broadcast. A band whose ends are swapped holds no age.
    """
    band_of_age = age_bands.where("min_age <= max_age").select(
        F.explode(F.sequence("min_age", "max_age")).alias("age"),
        F.col("band_name").alias("age_band"),
    )
    return customers.join(F.broadcast(band_of_age), "age", "left").select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id",
        "has_fashion_news",
        "is_active",
        "club_member_status",
        "fashion_news_frequency",
        "age",
        "age_band",
        "postal_code",
    )


def current_price(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(F.col(VALID_TO).isNull()).select(
        "article_id", F.col("median_price").alias("current_price")
    )


def dim_article(articles: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Articles with the price of their open version; articles never sold have none.

    Spark sizes two columns of the versions many times too low, so the join asks for a merge: else the prices
    of a million articles go to the driver.
    """
    return articles.join(current_price(snapshot).hint("merge"), "article_id", "left").select(
        surrogate_key("article_id").alias("article_sk"), *ARTICLE_ATTRIBUTES, "current_price"
    )


# One row per article and price version. Kept as expressions because the warehouse serves it as a
# view: the snapshot already stores these rows, and closed ones never change.
PRICE_HISTORY = [
    surrogate_key_sql("article_id", VALID_FROM) + " as price_version_sk",
    "article_id",
    "median_price",
    "price_month",
    f"{VALID_FROM} as valid_from",
    f"{VALID_TO} as valid_to",
    f"{VALID_TO} is null as is_current",
]


def dim_article_price_history(snapshot: DataFrame) -> DataFrame:
    return snapshot.selectExpr(*PRICE_HISTORY)


def sales_grain(transactions: DataFrame, month: str | None = None) -> DataFrame:
    """Cleaned transactions summed to date x customer x article x channel, on natural keys.

    The sum is widened to decimal(38,8) first: the default decimal(22,8) would overflow once a
    single group holds a few hundred billion rows.
    """
    if month is not None:
        transactions = transactions.where(in_month("sale_date", month))
    return (
        transactions.groupBy("sale_date", "customer_id", "article_id", "sales_channel_id")
        .agg(
            F.count(F.lit(1)).alias("quantity"),
            F.sum(F.col("price").cast("decimal(28,8)")).alias("sales_amount"),
        )
        .withColumn("sale_month", month_start("sale_date"))
    )


def with_sales_keys(grain: DataFrame) -> DataFrame:
    """Hash keys are added after the sum, so rows are shuffled narrow and hashed once per group."""
    return grain.select(
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("article_id").alias("article_sk"),
        surrogate_key("sales_channel_id").alias("channel_sk"),
        "sale_date",
        "sale_month",
        "customer_id",
        "article_id",
        "quantity",
        "sales_amount",
    )


def fct_sales(transactions: DataFrame, month: str | None = None) -> DataFrame:
    return with_sales_keys(sales_grain(transactions, month))


def sales_between(fact: DataFrame, start: date, end: date) -> DataFrame:
    """Sales with start <= sale_date < end, plus the bound on the partition column it implies."""
    first_month = date(start.year, start.month, 1)
    return fact.where(
        (F.col("sale_month") >= F.lit(first_month))
        & (F.col("sale_month") < F.lit(end))
        & (F.col("sale_date") >= F.lit(start))
        & (F.col("sale_date") < F.lit(end))
    )


def sales_on(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales with the attributes of their day, of the days in `dates` alone.

    The month follows from the day; joined on as well, it lets a filter on the date dimension, such as
    one year, reach the fact's partitions when the query runs.
    """
    days = dates.withColumn("__month", month_start("date_day"))
    same = (F.col("sale_date") == F.col("date_day")) & (F.col("sale_month") == F.col("__month"))
    return fact.join(F.broadcast(days), same).drop("__month")


def star_sales_by_month_band_channel(
    fact: DataFrame, dates: DataFrame, customers: DataFrame, channels: DataFrame
) -> DataFrame:
    """Units and amount per calendar month, age band and channel.

    The fact is summed per customer before it meets the customer dimension, so a customer with a
    large share of all sales reaches the join as a handful of rows. The date and channel
    dimensions have a fixed size and are broadcast; the customer side is left to Spark.
    """
    per_customer = (
        sales_on(fact, dates.select("date_day", "year", "month"))
        .groupBy("year", "month", "customer_sk", "channel_sk")
        .agg(F.sum("quantity").alias("quantity"), F.sum("sales_amount").alias("sales_amount"))
    )
    return (
        per_customer.join(customers.select("customer_sk", "age_band"), "customer_sk")
        .join(F.broadcast(channels.select("channel_sk", "channel_name")), "channel_sk")
        .groupBy("year", "month", "age_band", "channel_name")
        .agg(F.sum("quantity").alias("quantity"), F.sum("sales_amount").alias("sales_amount"))
    )


def article_price_versions(articles: DataFrame, history: DataFrame) -> DataFrame:
    """Each article with all its price versions."""
    return articles.select("article_id", "product_name", "product_group_name").join(
        history.drop("price_version_sk"), "article_id"
    )
