"""Keys, months and the calendar."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.functions import (
    date_attributes,
    in_month,
    month_bounds,
    scd_id,
    surrogate_key,
    timestamp,
)
from starloom.operators import marts


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


NULL = "_dbt_utils_surrogate_key_null_"


def test_surrogate_key_of_one_and_many_columns(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', 1, TIMESTAMP_NTZ'2019-01-01 00:00:00.120000'),"
        " (NULL, NULL, NULL), ('', 2, TIMESTAMP_NTZ'2019-01-01 00:00:00') AS t(a, n, ts)"
    )
    out = rows.select(
        surrogate_key("a").alias("one"), surrogate_key("a", "n", "ts").alias("many")
    ).collect()
    assert [tuple(r) for r in out] == [
        (md5("a"), md5("a-1-2019-01-01 00:00:00.12")),
        (md5(NULL), md5(f"{NULL}-{NULL}-{NULL}")),
        (md5(""), md5("-2-2019-01-01 00:00:00")),
    ]


def test_scd_id_joins_with_a_bar(spark):
    row = spark.range(1).select(
        scd_id(F.lit("a1"), timestamp(datetime(2019, 1, 1, 12))).alias("k"),
        scd_id(F.lit(None), timestamp(datetime(2019, 1, 1))).alias("n"),
    ).first()
    assert row.k == md5("a1|2019-01-01 12:00:00")
    assert row.n == md5("|2019-01-01 00:00:00")


def test_month_bounds():
    assert month_bounds("2019-01") == (date(2019, 1, 1), date(2019, 2, 1))
    assert month_bounds("2019-12") == (date(2019, 12, 1), date(2020, 1, 1))
    for bad in ("2019-13", "2019-1", "2019-00", "x", "2019-01-01"):
        with pytest.raises(ValueError):
            month_bounds(bad)


def test_month_filter_reaches_the_scan(spark, parquet_dir):
    rows = spark.read.parquet(f"{parquet_dir}/transactions_train.parquet")
    january = rows.where(in_month("t_dat", "2019-01"))
    assert january.count() == 2
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t_dat,2019-01-01), LessThan(t_dat,2019-02-01)" in plan


def test_standard_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 29707
    ends = days.agg(F.min("date_day"), F.max("date_day")).first()
    assert tuple(ends) == (date(2018, 9, 1), date(2099, 12, 31))


def test_date_attributes(spark):
    days = spark.sql("SELECT EXPLODE(ARRAY(DATE'2019-06-02', DATE'2019-06-03')) AS d")
    out = [tuple(r) for r in days.select(*date_attributes("d")).collect()]
    assert out == [
        (2019, 2, 6, "June", 7, "Sunday", True),
        (2019, 2, 6, "June", 1, "Monday", False),
    ]


def test_literal_timestamp_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        value = spark.range(1).select(timestamp(datetime(2019, 1, 1, 5)).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert value == datetime(2019, 1, 1, 5)
