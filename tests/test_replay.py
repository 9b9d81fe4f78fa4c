"""Check reports: over all rows after every monthly job, and of a whole replay from one pass."""

import re
from datetime import datetime

import pytest

from starloom.operators import marts, quality
from starloom.plans import build, replay
from starloom.sinks.landing import Landing
from starloom.sinks.warehouse import Warehouse

RUN, LATER = datetime(2019, 3, 1, 12), datetime(2019, 4, 1, 12)


def put(spark, folder, name, rows, columns):
    spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})").write.mode("overwrite").parquet(
        f"{folder}/{name}.parquet"
    )


def put_sales(spark, folder, rows):
    put(spark, folder, "transactions_train", rows, "t_dat, customer_id, article_id, price, sales_channel_id")


def put_articles(spark, folder, ids):
    from landing_files import write_articles

    write_articles(spark, folder, ids)


def said(report, *more):
    return sorted((*[r[m] for m in more], r.check_name, r.table_name, r.failures, r.status) for r in report.collect())


def whole(w):
    return said(quality.report(build.warehouse_tables(w)))


MESSY = (
    "(DATE'2019-01-05', 'k1', 'm1', 0.25D, 1), (DATE'2019-01-05', 'k1', 'm1', 0.25D, 1),"
    "(DATE'2019-01-07', 'lost', 'm1', 0D, 3), (DATE'2019-01-08', 'k2', 'm3', 0D, 2),"
    "(DATE'2019-02-05', 'k1', 'gone', 0.5D, 2), (DATE'2019-02-06', NULL, 'm1', 0.7D, 1),"
    "(DATE'2019-02-07', 'k1', 'm3', 0.1D, 2), (DATE'2019-03-05', 'k2', 'm2', 0D, NULL),"
    "(DATE'2019-03-06', 'k2', 'm3', 0D, 2), (DATE'2019-03-06', 'lost', NULL, 0.2D, 2),"
    "(DATE'2019-05-01', 'k1', 'm2', 0.3D, 1), (DATE'2019-05-02', 'k3', 'm1', NULL, 1)"
)


def test_an_orphan_of_an_earlier_month_goes_on_failing(spark, warehouse, parquet_dir):
    put_sales(spark, parquet_dir, MESSY)
    landing = Landing(warehouse, parquet_dir)
    first, _ = build.run_month(landing, "2019-01", RUN)
    assert said(first) == whole(warehouse)
    with pytest.raises(build.ChecksFailed, match="relationships_fct_sales_customer_sk: 1"):
        build.run_month(landing, "2019-05", LATER, stop_on_failure=True)
    second, _ = build.run_month(landing, "2019-05", LATER)
    assert said(second) == whole(warehouse)
    failed = {r.check_name: r.failures for r in second.where("status = 'fail'").collect()}
    assert failed["between_stg_transactions_price"] == 2
    assert failed["accepted_values_stg_transactions_sales_channel_id"] == 1


def test_reports_follow_parents_that_come_and_go(spark, warehouse, parquet_dir):
    put_sales(spark, parquet_dir, MESSY)
    landing = Landing(warehouse, parquet_dir)
    missing = {}
    for ids, month in ((["m1"], "2019-01"), (["m1", "m3", "gone"], "2019-02"), (["m2"], "2019-03")):
        put_articles(spark, parquet_dir, ids)
        report, _ = build.run_month(landing, month, datetime(2019, 6, int(month[-1])))
        assert said(report) == whole(warehouse)
        missing[month] = {r.check_name: r.failures for r in report.collect()}["relationships_stg_transactions_article_id"]
    assert missing == {"2019-01": 1, "2019-02": 0, "2019-03": 8}


def test_a_month_loaded_again_is_checked_again(spark, warehouse, parquet_dir):
    put_sales(spark, parquet_dir, MESSY)
    landing = Landing(warehouse, parquet_dir)
    build.run_month(landing, "2019-01", RUN)
    put_sales(spark, parquet_dir, "(DATE'2019-01-05', 'k1', 'm1', 0.25D, 1), (DATE'2019-02-05', 'k1', 'm1', 0.25D, 1)")
    report, _ = build.run_month(landing, "2019-01", LATER)
    assert said(report) == whole(warehouse)
    assert report.where("status = 'fail'").count() == 0
    put_sales(spark, parquet_dir, "(DATE'2019-02-05', 'k1', 'x', 0.25D, 1)")
    report, _ = build.run_month(landing, "2019-01", datetime(2019, 5, 1))  # emptied; the fact keeps its month
    assert said(report) == whole(warehouse)


def test_checked_months_are_read_once(spark, warehouse, parquet_dir, monkeypatch):
    landing = Landing(warehouse, parquet_dir)
    build.run_month(landing, "2019-01", RUN)
    seen = []
    real = quality.states
    monkeypatch.setattr(quality, "states", lambda rows, *a: seen.append(rows) or real(rows, *a))
    build.run_month(landing, "2019-02", LATER)
    months = {r[0].isoformat() for rows in seen for r in rows.select("sale_month").distinct().collect()}
    assert months == {"2019-02-01"}
    monkeypatch.setattr(quality, "SUITE", [c for c in quality.SUITE if c.kind != "between"])
    seen.clear()
    build.check(warehouse, LATER)  # other checks: every month is taken again
    months = {r[0].isoformat() for rows in seen for r in rows.select("sale_month").distinct().collect()}
    assert months == {"2019-01-01", "2019-02-01"}


def test_uniqueness_has_no_states(spark):
    with pytest.raises(ValueError):
        quality.states(spark.range(1), "raw_articles", "id")


@pytest.mark.parametrize("articles", [["m1", "m1", "m2"], ["m3", "m3", "m3", "m2", None, None]])
def test_reports_of_one_pass_equal_those_of_the_jobs(spark, parquet_dir, tmp_path, articles):
    put_sales(spark, parquet_dir, MESSY)
    put_articles(spark, parquet_dir, articles)
    name = f"r{len(articles)}{articles.count('m1')}"
    one = Landing(Warehouse(spark, str(tmp_path / "o"), prefix=f"{name}1_"), parquet_dir)
    many = Landing(Warehouse(spark, str(tmp_path / "m"), prefix=f"{name}2_"), parquet_dir)
    reports = replay.replay_reports(one, RUN)
    expected = build.replay_months(many)
    assert sorted(reports.columns) == sorted(expected.columns)
    assert said(reports, "month") == said(expected, "month")
    last = [r[1:] for r in said(reports, "month") if r[0] == "2019-05"]
    assert last == whole(one.warehouse)


def versions(w):
    names = ["article_id", "price_month", "median_price", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"]
    return sorted((tuple(r) for r in w.table("stg", "snap_article_price").select(*names).collect()), key=str)


#: m1 stays, moves and moves back; m2 begins late; m3 is there in the middle month alone.
STEPS = (
    "(DATE'2019-01-05','k1','m1',0.1D,1), (DATE'2019-02-05','k1','m1',0.2D,1), (DATE'2019-03-05','k1','m1',0.1D,1),"
    "(DATE'2019-04-05','k1','m1',0.1D,1), (DATE'2019-02-06','k1','m3',0.5D,1), (DATE'2019-03-06','k1','m2',0.3D,1),"
    "(DATE'2019-04-06','k1','m2',0.3D,1)"
)


@pytest.mark.parametrize("order", [[3, 1, 2, 4], [4, 2, 1, 3]])
def test_months_in_any_order_leave_the_same_versions(spark, parquet_dir, tmp_path, order):
    put_sales(spark, parquet_dir, STEPS)
    name = f"v{order[0]}"
    inorder = Landing(Warehouse(spark, str(tmp_path / "o"), prefix=f"{name}1_"), parquet_dir)
    build.replay_history(inorder, RUN)
    w = Warehouse(spark, str(tmp_path / "m"), prefix=f"{name}2_")
    landing = Landing(w, parquet_dir)
    for m in order:
        landing.load_month(f"2019-0{m}", datetime(2019, m, 1))
        build.build_snapshot(w, datetime(2019, m, 1))
    assert versions(w) == versions(inorder.warehouse)
    for x in (w, inorder.warehouse):  # and later runs go on from there
        build.build_snapshot(x, datetime(2019, 6, 1))
    put_sales(spark, parquet_dir, "(DATE'2019-06-05','k1','m1',0.9D,1)")
    for x in (w, inorder.warehouse):
        Landing(x, parquet_dir).load_month("2019-06", datetime(2019, 6, 2))
        build.build_snapshot(x, datetime(2019, 6, 2))
    assert versions(w) == versions(inorder.warehouse)
    assert len(versions(w)) == 6
    with pytest.raises(ValueError, match="first days"):  # the last run was stamped otherwise
        build.build_snapshot(w, datetime(2019, 2, 1))


def test_a_spliced_month_that_dies_leaves_the_versions(spark, warehouse, parquet_dir, monkeypatch):
    put_sales(spark, parquet_dir, STEPS)
    landing = Landing(warehouse, parquet_dir)
    for m in (1, 3):
        landing.load_month(f"2019-0{m}")
        build.build_snapshot(warehouse, datetime(2019, m, 1))
    before = versions(warehouse)
    landing.load_month("2019-02")
    real = Warehouse.create_view

    def die(self, layer, view, *args, **kwargs):
        if view == build.SNAPSHOT:
            raise RuntimeError("killed before publishing")
        return real(self, layer, view, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "create_view", die)
        with pytest.raises(RuntimeError):
            build.build_snapshot(warehouse, datetime(2019, 2, 1))
    assert versions(warehouse) == before
    build.build_snapshot(warehouse, datetime(2019, 2, 1))
    assert [(v[0], v[2]) for v in versions(warehouse)] == [
        ("m1", 0.1), ("m1", 0.2), ("m1", 0.1), ("m2", 0.3), ("m3", 0.5)
    ]


def test_articles_and_parents_are_not_broadcast(spark, warehouse, parquet_dir):
    """The tables are small here; at any size, what a replay's reports bring to the driver does not grow with them."""
    put_sales(spark, parquet_dir, MESSY)
    build.replay_history(Landing(warehouse, parquet_dir), RUN)
    plan = replay.monthly_reports(warehouse)._jdf.queryExecution().executedPlan().toString()
    joins = {how: re.findall(rf"{how}Join \[(\w+)#\d+(?:, (\w+)#)?", plan) for how in ("SortMerge", "BroadcastHash")}
    assert {("article_id", ""), ("reference", "key")} <= set(joins["SortMerge"])
    assert {k for pair in joins["BroadcastHash"] for k in pair}.isdisjoint({"article_id", "key"})


def test_open_prices_are_not_broadcast(spark, warehouse, parquet_dir):
    build.replay_history(Landing(warehouse, parquet_dir), RUN)
    rows = marts.dim_article(warehouse.table("stg", "stg_articles"), warehouse.table("stg", build.SNAPSHOT))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [article_id" in plan and "Broadcast" not in plan


def test_a_report_needs_sales(warehouse, parquet_dir, spark):
    put_sales(spark, parquet_dir, "(CAST(NULL AS DATE), 'k1', 'm1', 0.5D, 1)")
    with pytest.raises(ValueError):
        replay.replay_reports(Landing(warehouse, parquet_dir), RUN)
