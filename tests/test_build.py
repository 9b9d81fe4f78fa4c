"""Whole jobs over tiny inputs."""

from datetime import datetime

import pytest

from starloom.plans import build
from starloom.schemas import VALID_FROM, VALID_TO
from starloom.sinks.landing import Landing
from starloom.sinks.warehouse import Warehouse

RUN = datetime(2019, 3, 1)
LATER = datetime(2019, 3, 2)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def put_transactions(spark, parquet_dir, values):
    spark.sql(
        f"SELECT * FROM VALUES {values} "
        "AS t(t_dat, customer_id, article_id, price, sales_channel_id)"
    ).write.mode("overwrite").parquet(f"{parquet_dir}/transactions_train.parquet")


@pytest.fixture
def built(warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    landing.load_history(RUN)
    report = build.build(warehouse, RUN)
    return landing, report


def test_every_check_passes_on_clean_data(built):
    report = built[1].collect()
    assert len(report) == 38
    assert {r.status for r in report} == {"pass"}


def test_star_contents(built):
    w = built[0].warehouse
    assert rows(w.table("dwh", "fct_sales"), "customer_id", "article_id", "quantity") == [
        ("k1", "m1", 1), ("k1", "m2", 1), ("k2", "m1", 1),
    ]
    bands = {r.customer_id: r.age_band for r in w.table("dwh", "dim_customer").collect()}
    assert bands == {"k1": None, "k2": "16-24", "k3": None}
    prices = {r.article_id: r.current_price for r in w.table("dwh", "dim_article").collect()}
    assert prices == {"m1": 0.25, "m2": 0.4}
    assert w.table("dwh", "dim_date").count() == 29707
    assert w.table("dwh", "fct_sales").columns == build._FACT_COLUMNS


def test_layer_names_are_database_names(spark, tmp_path):
    Warehouse(spark, str(tmp_path / "plain"))
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"raw", "stg", "dwh"} <= names


def test_databases_of_another_root_are_refused(spark, tmp_path):
    Warehouse(spark, str(tmp_path / "a"), prefix="placed_")
    Warehouse(spark, str(tmp_path / "a") + "/", prefix="placed_")
    with pytest.raises(ValueError):
        Warehouse(spark, str(tmp_path / "b"), prefix="placed_")


def test_unknown_layer_is_refused(warehouse):
    with pytest.raises(ValueError):
        build.build_layer(warehouse, "mart")


def test_one_layer_can_be_built(built):
    w = built[0].warehouse
    build.build_layer(w, "stg", LATER)
    assert w.table("stg", "stg_transactions").count() == 3


def test_rebuilding_one_month_leaves_the_others(spark, built, parquet_dir):
    landing, _ = built
    w = landing.warehouse
    put_transactions(
        spark, parquet_dir,
        "(DATE'2019-01-09', 'k1', 'm1', 0.5D, 1), (DATE'2019-02-09', 'k3', 'm2', 0.5D, 1)",
    )
    landing.load_months(LATER)
    build.build_fact(w, LATER, month="2019-01")
    fact = w.table("dwh", "fct_sales")
    assert rows(fact, "customer_id", "article_id") == [("k1", "m1"), ("k2", "m1")]
    build.build_fact(w, LATER)
    assert rows(fact := w.table("dwh", "fct_sales"), "customer_id", "article_id") == [
        ("k1", "m1"), ("k3", "m2"),
    ]
    assert fact.where("sale_month = DATE'2019-02-01'").count() == 1


def test_month_without_rows_stays_in_the_fact(spark, built, parquet_dir):
    landing, _ = built
    put_transactions(spark, parquet_dir, "(DATE'2019-02-09', 'k3', 'm2', 0.5D, 1)")
    assert landing.load_month("2019-01", LATER) == 0
    build.build_fact(landing.warehouse, LATER)
    assert landing.warehouse.table("dwh", "fct_sales").count() == 3


def test_unchanged_months_are_not_rebuilt(built):
    w = built[0].warehouse
    location = w.partition_location("dwh", "fct_sales_months", "sale_month=2019-01-01")
    built[0].load_month("2019-02", LATER)
    build.build_fact(w, LATER)
    assert w.partition_location("dwh", "fct_sales_months", "sale_month=2019-01-01") == location
    assert w.partition_location("dwh", "fct_sales_months", "sale_month=2019-02-01") != location


def test_build_without_any_sale(warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    reports = build.run_month(landing, "2018-01", RUN)
    assert {r.status for r in reports[0].collect()} == {"pass"}
    assert warehouse.table("dwh", "fct_sales").count() == 0
    assert {r.current_price for r in warehouse.table("dwh", "dim_article").collect()} == {None}
    stale = {r.source_name: r.status for r in reports[1].collect()}
    assert stale == {"transactions": "warn", "articles": "pass", "customers": "pass"}


def test_date_range_prunes_fact_months(built):
    from datetime import date

    from starloom.operators import marts

    fact = built[0].warehouse.table("dwh", "fct_sales")
    january = marts.sales_between(fact, date(2019, 1, 20), date(2019, 2, 11))
    assert rows(january, "article_id") == [("m2",)]
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "(sale_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert marts.sales_between(fact, date(2019, 1, 20), date(2019, 2, 12)).count() == 2


def test_a_year_of_the_date_dimension_prunes_fact_months(spark, built, parquet_dir):
    from starloom.operators import marts

    landing, _ = built
    w = landing.warehouse
    put_transactions(
        spark, parquet_dir,
        "(DATE'2020-06-09', 'k2', 'm1', 0.7D, 2), (DATE'2020-07-10', 'k2', 'm2', 0.2D, 1),"
        "(DATE'2021-01-01', 'k2', 'm2', 0.2D, 1)",
    )
    landing.load_months(LATER)
    build.build_fact(w, LATER)
    fact, days = w.table("dwh", "fct_sales"), w.table("dwh", "dim_date").where("year = 2020")
    answer = marts.star_sales_by_month_band_channel(
        fact, days, w.table("dwh", "dim_customer"), w.table("dwh", "dim_channel")
    )
    assert rows(answer, "year", "month", "quantity") == [(2020, 6, 1), (2020, 7, 1)]
    joined = marts.sales_on(fact, days)
    assert rows(joined, "sale_date") == rows(fact.where("year(sale_date) = 2020"), "sale_date")
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(sale_month" in plan


def test_second_run_tracks_the_change(spark, built, parquet_dir):
    landing, _ = built
    w = landing.warehouse
    put_transactions(spark, parquet_dir, "(DATE'2019-02-09', 'k2', 'm1', 0.7D, 2)")
    reports = build.run_month(landing, "2019-02", LATER)
    assert {r.status for r in reports[1].collect()} == {"pass"}
    assert rows(w.table("stg", "snap_article_price"), "article_id", "median_price", VALID_FROM,
                VALID_TO) == sorted(
        [("m1", 0.25, RUN, LATER), ("m2", 0.4, RUN, None), ("m1", 0.7, LATER, None)],
        key=lambda r: r[:2],
    )
    history = w.table("dwh", "dim_article_price_history")
    assert rows(history.where("is_current"), "article_id", "median_price") == [
        ("m1", 0.7), ("m2", 0.4),
    ]


def test_snapshot_runs_cannot_go_back(built):
    with pytest.raises(ValueError):
        build.build_snapshot(built[0].warehouse, datetime(2019, 2, 28))


def test_repeated_snapshot_run_replaces_itself(spark, built, parquet_dir):
    landing, _ = built
    w = landing.warehouse
    for price in ("0.7D", "0.25D", "0.9D"):
        put_transactions(spark, parquet_dir, f"(DATE'2019-02-09', 'k2', 'm1', {price}, 2)")
        landing.load_month("2019-02", LATER)
        build.build_snapshot(w, LATER)
    prices = ("article_id", "median_price", VALID_FROM, VALID_TO)
    expected = [("m1", 0.25, RUN, LATER), ("m1", 0.9, LATER, None), ("m2", 0.4, RUN, None)]
    assert rows(w.table("stg", "snap_article_price"), *prices) == expected
    after = datetime(2019, 3, 5)
    put_transactions(spark, parquet_dir, "(DATE'2019-02-09', 'k2', 'm1', 0.3D, 2)")
    landing.load_month("2019-02", after)
    build.build_snapshot(w, after)
    assert rows(w.table("stg", "snap_article_price"), *prices[:2]) == [
        ("m1", 0.25), ("m1", 0.3), ("m1", 0.9), ("m2", 0.4),
    ]


def test_price_history_of_open_rows_reads_one_partition(built):
    w = built[0].warehouse
    run = w.properties("stg", "snap_article_price")["starloom.version"]
    assert len(build._open_rows(w, run).inputFiles()) >= 1
    plan = build._open_rows(w, run)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan


def test_what_a_dead_snapshot_run_wrote_is_ignored(built, monkeypatch):
    w = built[0].warehouse
    before = rows(w.table("stg", "snap_article_price"), "article_id", "median_price")

    def die(*args, **kwargs):
        raise RuntimeError("killed before publishing")

    built[0].load_month("2019-02", LATER)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "create_view", die)
        with pytest.raises(RuntimeError):
            build.build_snapshot(w, LATER)
    assert rows(w.table("stg", "snap_article_price"), "article_id", "median_price") == before
    build.build_snapshot(w, datetime(2019, 3, 3))
    assert rows(w.table("stg", "snap_article_price"), "article_id", "median_price") == before


def test_replay_in_one_pass_equals_the_monthly_job(spark, parquet_dir, tmp_path):
    put_transactions(
        spark, parquet_dir,
        "(DATE'2019-01-05','k1','m1',0.15D,1), (DATE'2019-02-05','k1','m1',0.15D,1),"
        "(DATE'2019-03-05','k1','m1',0.3D,1), (DATE'2019-03-06','k2','m1',0.5D,2),"
        "(DATE'2019-02-05','k1','m2',0.2D,1), (DATE'2019-04-05','k1','m2',0.9D,1),"
        "(DATE'2019-04-06','k1','m2',0.9D,1)",
    )
    one = Landing(Warehouse(spark, str(tmp_path / "o"), prefix="replay1_"), parquet_dir)
    many = Landing(Warehouse(spark, str(tmp_path / "m"), prefix="replay2_"), parquet_dir)
    build.replay_history(one, RUN)
    build.replay_months(many)
    assert many.warehouse.table("stg", "snap_article_price").count() == 4
    for layer, table in [
        ("stg", "snap_article_price"),
        ("dwh", "fct_sales"),
        ("dwh", "dim_article"),
        ("dwh", "dim_article_price_history"),
        ("dwh", "dim_customer"),
    ]:
        assert same(one.warehouse.table(layer, table), many.warehouse.table(layer, table)), table
    # The next monthly run goes on from the replay.
    build.run_month(one, "2019-04", datetime(2019, 5, 1))
    assert one.warehouse.table("stg", "snap_article_price").count() == 4


def test_build_from_csv(spark, warehouse, tmp_path):
    raw, seeds = tmp_path / "data" / "raw", tmp_path / "seeds"
    raw.mkdir(parents=True)
    seeds.mkdir()
    (raw / "transactions_train.csv").write_text(
        "t_dat,customer_id,article_id,price,sales_channel_id\n"
        "2020-06-30,0x7,0042,1.5,2\n2020-06-30,0x7,0042,1.5,2\n"
    )
    from starloom.schemas import ARTICLES, CUSTOMERS

    blank = "," * (len(ARTICLES) - 3)
    (raw / "articles.csv").write_text(
        ",".join(ARTICLES.names) + f',season\n0042,42,"Oak ""chair""\nfolding"{blank},summer\n'
    )
    (raw / "customers.csv").write_text(
        ",".join(CUSTOMERS.names) + "\n0x7,1.0,,LEFT,Monthly,30,q\n"
    )
    (seeds / "seed_age_bands.csv").write_text("band_name,min_age,max_age\nall,0,120\nnone,40,20\n")
    (seeds / "seed_sales_channels.csv").write_text("sales_channel_id,channel_name\n1,a\n2,b\n")
    report = build.build_all(warehouse, str(tmp_path / "data"), RUN, str(seeds))
    assert {r.status for r in report.collect()} == {"pass"}
    sale = warehouse.table("dwh", "fct_sales").collect()
    assert [(r.article_id, r.quantity, str(r.sales_amount)) for r in sale] == [
        ("0042", 2, "3.00000000")
    ]
    assert warehouse.table("dwh", "dim_article").first().product_name == 'Oak "chair"\nfolding'
    assert warehouse.table("raw", "articles").first().season == "summer"
    assert warehouse.table("dwh", "dim_customer").first().age_band == "all"
    assert warehouse.table("dwh", "dim_channel").where("channel_name = 'b'").count() == 1


def test_replay_returns_the_reports_and_can_stop(spark, warehouse, parquet_dir):
    put_transactions(
        spark, parquet_dir,
        "(DATE'2019-01-14', 'k1', 'm1', 0.5D, 1), (DATE'2019-02-14', 'k1', 'gone', 0.5D, 1),"
        "(DATE'2019-03-14', 'k1', 'm1', 0.5D, 1)",
    )
    landing = Landing(warehouse, parquet_dir)
    said = build.replay_months(landing).collect()
    assert len(said) == 3 * 38
    failed = {(r.month, r.check_name) for r in said if r.status == "fail"}
    assert failed == {
        (month, check)
        for month in ("2019-02", "2019-03")  # a sale without its article goes on failing
        for check in ("relationships_stg_transactions_article_id", "relationships_fct_sales_article_sk")
    }
    whole = build.quality.report(build.warehouse_tables(warehouse)).where("status = 'fail'")
    assert whole.count() == 2


def test_failed_check_stops_a_job_on_request(spark, warehouse, parquet_dir):
    put_transactions(spark, parquet_dir, "(DATE'2019-01-14', 'k1', 'gone', 0.5D, 1)")
    landing = Landing(warehouse, parquet_dir)
    with pytest.raises(build.ChecksFailed):
        build.replay_months(landing, ["2019-01"], stop_on_failure=True)
    with pytest.raises(build.ChecksFailed, match="relationships_fct_sales_article_sk: 1"):
        build.run_month(landing, "2019-01", RUN, stop_on_failure=True)


def test_a_key_lost_by_a_dimension_fails_sales_of_earlier_months(spark, warehouse, parquet_dir):
    landing = Landing(warehouse, parquet_dir)
    report, _ = build.run_month(landing, "2019-01", RUN)
    assert report.where("status = 'fail'").count() == 0
    customers = spark.read.parquet(f"{parquet_dir}/customers.parquet").where("customer_id <> 'k1'")
    kept = spark.createDataFrame(customers.collect(), customers.schema)
    kept.write.mode("overwrite").parquet(f"{parquet_dir}/customers.parquet")
    expected = {
        ("relationships_stg_transactions_customer_id", 2),
        ("relationships_fct_sales_customer_sk", 2),
    }
    for _ in range(2):  # a second run, to which the file is no news, says so too
        report, _ = build.run_month(landing, "2019-02", LATER)
        failed = report.where("status = 'fail'").collect()
        assert {(r.check_name, r.failures) for r in failed} == expected
    with pytest.raises(build.ChecksFailed):
        build.run_month(landing, "2019-02", LATER, stop_on_failure=True)


def test_vanished_article_keeps_its_open_version(spark, built, parquet_dir):
    landing, _ = built
    put_transactions(spark, parquet_dir, "(DATE'2019-01-09', 'k1', 'm1', 0.25D, 1)")
    landing.load_months(LATER)
    landing.load_month("2019-02", LATER)
    build.build_snapshot(landing.warehouse, LATER)
    kept = landing.warehouse.table("stg", "snap_article_price")
    assert rows(kept, "article_id", "median_price", VALID_TO) == [
        ("m1", 0.25, None), ("m2", 0.4, None),
    ]
