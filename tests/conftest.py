from __future__ import annotations

import itertools
import sys
from pathlib import Path

import pytest
from landing_files import write_articles
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_numbers = itertools.count()


@pytest.fixture
def warehouse(spark, tmp_path):
    from starloom.sinks.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse"), prefix=f"t{next(_numbers)}_")


@pytest.fixture
def parquet_dir(spark, tmp_path):
    """Three tiny input files: three sales in two months, two articles, three customers."""
    folder = tmp_path / "parquet"
    spark.sql(
        """SELECT * FROM VALUES
             (DATE'2019-01-14', 'k1', 'm1', 0.25, 1),
             (DATE'2019-01-20', 'k1', 'm2', 0.4, 2),
             (DATE'2019-02-11', 'k2', 'm1', 0.25, 2)
           AS t(t_dat, customer_id, article_id, price, sales_channel_id)"""
    ).write.parquet(str(folder / "transactions_train.parquet"))
    write_articles(spark, folder, ["m1", "m2"])
    spark.sql(
        """SELECT * FROM VALUES
             ('k1', 1.0D, CAST(NULL AS DOUBLE), 'ACTIVE', 'None', 15, 'p1'),
             ('k2', CAST(NULL AS DOUBLE), 1.0D, 'ACTIVE', 'Regularly', 16, 'p2'),
             ('k3', 0.0D, 0.0D, CAST(NULL AS STRING), CAST(NULL AS STRING), NULL, 'p3')
           AS t(customer_id, FN, Active, club_member_status, fashion_news_frequency, age,
                postal_code)"""
    ).write.parquet(str(folder / "customers.parquet"))
    return str(folder)
