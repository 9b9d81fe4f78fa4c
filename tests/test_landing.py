"""Landing loads: idempotent months, whole dimensions, and what a failure leaves behind."""

from datetime import datetime

import pytest

from starloom.sinks.landing import Landing
from starloom.sinks.warehouse import KEPT

RUN = datetime(2019, 3, 1, 12, 0, 0)


def log_rows(landing):
    rows = landing.warehouse.table("raw", "load_log").collect()
    return sorted((r.table_name, r.partition, r.rows, r.status) for r in rows)


def test_months_of_unequal_size_and_a_reload_that_shrinks_one(spark, warehouse, parquet_dir):
    def put(sizes):
        spark.range(max(sizes.values())).crossJoin(
            spark.createDataFrame(list(sizes.items()), "month STRING, n INT")
        ).where("id < n").selectExpr(
            "to_date(concat(month, '-11')) as t_dat", "concat('k', id) as customer_id", "'m1' as article_id",
            "0.5D as price", "1 as sales_channel_id",
        ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")

    landing = Landing(warehouse, parquet_dir)
    put({"2020-02": 7, "2020-03": 1, "2020-05": 4})
    assert landing.load_months() == {"2020-02": 7, "2020-03": 1, "2020-05": 4}
    put({"2020-02": 3, "2020-03": 9})
    assert landing.load_month("2020-02") == 3
    counts = warehouse.table("raw", "transactions").groupBy("load_month").count().collect()
    assert dict(map(tuple, counts)) == {"2020-02": 3, "2020-03": 1, "2020-05": 4}
    assert log_rows(landing)[0:2] == [("transactions", "2020-02", 3, "ok"), ("transactions", "2020-02", 7, "ok")]


def test_a_dimension_that_loses_a_column(spark, warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    assert landing.load_dimension("customers", RUN) == 3
    spark.sql("SELECT 'k8' AS customer_id, 41 AS age").write.mode("overwrite").parquet(
        f"{parquet_dir}/customers.parquet"
    )
    assert landing.load_dimension("customers", RUN) == 1
    customers = warehouse.table("raw", "customers")
    assert customers.columns == ["customer_id", "age", "ingestion_ts"]
    assert customers.first() == ("k8", 41, RUN)


def test_months_are_listed_in_order(warehouse, parquet_dir):
    assert Landing(warehouse, parquet_dir).months() == ["2019-01", "2019-02"]


def test_unknown_dimension_is_refused(warehouse, parquet_dir):
    with pytest.raises(ValueError):
        Landing(warehouse, parquet_dir).load_dimension("transactions; drop table x")


def test_malformed_month_is_refused(warehouse, parquet_dir):
    with pytest.raises(ValueError):
        Landing(warehouse, parquet_dir).load_month("2019-13")


def test_month_gone_from_source_is_emptied(spark, warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    landing.load_months()
    spark.sql(
        "SELECT DATE'2019-02-03' AS t_dat, 'k9' AS customer_id, 'm1' AS article_id,"
        " 0.5D AS price, 1 AS sales_channel_id"
    ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")
    assert landing.load_month("2019-01") == 0
    assert landing.load_month("2019-02") == 1
    left = warehouse.table("raw", "transactions").collect()
    assert [(r.customer_id, r.load_month) for r in left] == [("k9", "2019-02")]


def test_failed_load_keeps_the_old_month(spark, warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    landing.load_month("2019-01")
    spark.sql(
        "SELECT DATE'2019-01-03' AS t_dat, 'k9' AS customer_id, 'm1' AS article_id,"
        " 'not a price' AS price, 1 AS sales_channel_id"
    ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")
    with pytest.raises(Exception, match="not a price"):
        landing.load_month("2019-01")
    assert warehouse.table("raw", "transactions").count() == 2
    assert log_rows(landing) == [
        ("transactions", "2019-01", 0, "failed"),
        ("transactions", "2019-01", 2, "ok"),
    ]


def test_failed_dimension_is_logged(warehouse, tmp_path):
    landing = Landing(warehouse, str(tmp_path / "nothing"))
    with pytest.raises(Exception):
        landing.load_dimension("articles")
    assert log_rows(landing) == [("articles", "full", 0, "failed")]


def test_rows_without_a_date_never_load(spark, warehouse, parquet_dir):
    spark.sql(
        "SELECT * FROM VALUES (CAST(NULL AS DATE), 'k1', 'm1', 0.5D, 1),"
        " (DATE'2019-01-03', 'k1', 'm1', 0.5D, 1)"
        " AS t(t_dat, customer_id, article_id, price, sales_channel_id)"
    ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")
    landing = Landing(warehouse, parquet_dir)
    assert landing.months() == ["2019-01"]
    assert landing.load_months() == {"2019-01": 1}


def test_one_pass_history_equals_month_by_month(spark, parquet_dir, tmp_path):
    from starloom.sinks.warehouse import Warehouse

    one = Landing(Warehouse(spark, str(tmp_path / "one"), prefix="one_"), parquet_dir)
    many = Landing(Warehouse(spark, str(tmp_path / "many"), prefix="many_"), parquet_dir)
    loaded = one.load_history(RUN)
    assert loaded == {"articles": 2, "customers": 3, "2019-01": 2, "2019-02": 1}
    for name in ("articles", "customers"):
        many.load_dimension(name, RUN)
    for month in many.months():
        assert many.load_month(month, RUN) == loaded[month]
    assert log_rows(one) == log_rows(many)
    left = one.warehouse.table("raw", "transactions")
    right = many.warehouse.table("raw", "transactions")
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_month_filter_reads_one_partition(warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    landing.load_months()
    rows = warehouse.table("raw", "transactions").where("load_month = '2019-01'")
    assert len(rows.inputFiles()) >= 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_month" in plan


def test_reader_planned_before_a_reload_goes_on(spark, warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    landing.load_months(RUN)
    reader = warehouse.table("raw", "transactions").where("load_month = '2019-01'")
    files = reader.inputFiles()
    old = spark.read.parquet(*files)
    landing.load_month("2019-01")
    assert old.count() == 2
    spark.sql(
        "SELECT DATE'2019-02-03' AS t_dat, 'k9' AS customer_id, 'm1' AS article_id,"
        " 0.5D AS price, 1 AS sales_channel_id"
    ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")
    again = spark.read.parquet(*warehouse.table("raw", "transactions").inputFiles())
    assert landing.load_month("2019-01") == 0
    assert again.count() == 3
    assert reader.sparkSession.table(warehouse.name("raw", "transactions")).count() == 1


def test_replaced_files_go_when_their_commit_is_no_longer_kept(warehouse, parquet_dir):
    import os

    landing = Landing(warehouse, parquet_dir)
    at = []
    for _ in range(KEPT):
        landing.load_month("2019-01")
        at.append(warehouse.partition_location("raw", "transactions", "load_month=2019-01"))
    landing.load_month("2019-02")
    assert not os.path.isdir(at[0].removeprefix("file:"))
    assert all(os.path.isdir(x.removeprefix("file:")) for x in at[1:])
    found = warehouse.commits("raw", "transactions")
    assert found.select("commit").distinct().count() == KEPT
    assert {r.partition for r in found.where("commit = 4").collect()} == {"load_month=2019-01", "load_month=2019-02"}


def test_failed_clean_up_is_no_failed_load(warehouse, parquet_dir, monkeypatch):
    from starloom.sources import files

    def refuse(*args):
        raise OSError("no permission")

    landing = Landing(warehouse, parquet_dir)
    for _ in range(KEPT):
        landing.load_month("2019-01")
    monkeypatch.setattr(files, "delete", refuse)
    with pytest.warns(UserWarning, match="left behind"):
        assert landing.load_month("2019-01") == 2
    assert log_rows(landing) == [("transactions", "2019-01", 2, "ok")] * (KEPT + 1)
