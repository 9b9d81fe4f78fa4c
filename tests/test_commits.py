"""Commits of partitioned tables: all months at once, and only one of two writers of the same month."""

import pytest
from pyspark.sql import types as T

from starloom.plans import build
from starloom.sinks.landing import Landing
from starloom.sinks.warehouse import KEPT, Conflict, State, Warehouse

SCHEMA = T.StructType([T.StructField("v", T.LongType())])
KEYS = T.StructType([T.StructField("m", T.StringType())])


def folders(w, values):
    """A staged folder with one row per partition."""
    rows = w.spark.createDataFrame([(v, m) for m, v in values.items()], "v LONG, m STRING")
    folder = f"{w.root}/it's/{w.new_run(build.utc_now())}"
    rows.write.partitionBy("m").parquet(folder)
    return w.staged(folder)


def held(w):
    return {r.m: r.v for r in w.table("raw", "t").collect()}


@pytest.fixture
def table(warehouse):
    warehouse.create_partitioned("raw", "t", SCHEMA, KEYS)
    warehouse.commit("raw", "t", folders(warehouse, {"a": 1, "b": 1}), notes={"run": "1"})
    return warehouse


def put_sales(spark, folder, rows):
    spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(t_dat, customer_id, article_id, price, sales_channel_id)"
    ).write.mode("overwrite").parquet(f"{folder}/transactions_train.parquet")


def test_an_empty_table_has_a_state(warehouse):
    assert warehouse.state("raw", "t") == State(-1, {}, {})
    warehouse.create_partitioned("raw", "t", SCHEMA, KEYS)
    warehouse.create_partitioned("raw", "t", SCHEMA, KEYS)
    assert warehouse.state("raw", "t") == State(0, {}, {}) and held(warehouse) == {}
    assert warehouse.table("raw", "t").columns == ["v", "m"]


def test_put_drop_and_note_in_one_commit(table):
    after = table.commit("raw", "t", folders(table, {"b": 2, "c": 2}), ["m=a"], {"more": "x"})
    assert held(table) == {"b": 2, "c": 2}
    assert after == table.state("raw", "t") and after.notes == {"run": "1", "more": "x"}


@pytest.mark.parametrize("dies", ["_create_commit", "_point", "create_view"])
def test_a_reader_sees_all_months_or_none(table, monkeypatch, dies):
    """The job stops at each step of publishing; then the next writer goes on."""

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    put = folders(table, {"a": 5, "b": 5, "c": 5})
    reader = table.table("raw", "t")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, dies, stop)
        with pytest.raises(KeyboardInterrupt):
            table.commit("raw", "t", put)
    assert held(table) == {"a": 1, "b": 1}
    table.commit("raw", "t", folders(table, {"d": 7}))
    happened = {"a": 5, "b": 5, "c": 5} if dies != "_create_commit" else {"a": 1, "b": 1}
    assert held(table) == happened | {"d": 7}
    assert {r.m: r.v for r in reader.collect()} == {"a": 1, "b": 1}


def test_of_two_writers_of_a_partition_the_second_fails(table):
    since = table.state("raw", "t")
    mine, other = folders(table, {"a": 2}), folders(table, {"a": 3})
    table.commit("raw", "t", mine, since=since)
    with pytest.raises(Conflict, match="m=a"):
        table.commit("raw", "t", other, since=since)
    with pytest.raises(Conflict, match="m=a"):
        table.commit("raw", "t", {}, ["m=a"], since=since)
    assert held(table) == {"a": 2, "b": 1}


def test_writers_of_different_partitions_both_win(table, monkeypatch):
    """The other commit comes between this one's look and its own, so its number is taken."""
    since = table.state("raw", "t")
    mine, other = folders(table, {"a": 2, "c": 2}), folders(table, {"b": 3})
    real, raced = Warehouse._create_commit, []

    def race(w, layer, name, state, *args):
        if not raced:
            raced.append(state.number)
            w.commit(layer, name, other)
        return real(w, layer, name, state, *args)

    monkeypatch.setattr(Warehouse, "_create_commit", race)
    after = table.commit("raw", "t", mine, since=since)
    assert held(table) == {"a": 2, "b": 3, "c": 2}
    assert after.number == raced[0] + 1


def test_a_slow_writer_does_not_turn_back_the_view(table, monkeypatch):
    late, real = folders(table, {"b": 9}), Warehouse.create_view

    def slow(w, *args, **kwargs):
        monkeypatch.setattr(Warehouse, "create_view", real)
        w.commit("raw", "t", late)  # a faster writer commits and publishes in the meantime
        return real(w, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "create_view", slow)
    table.commit("raw", "t", folders(table, {"a": 8}))
    assert held(table) == {"a": 8, "b": 9}


def test_old_commits_go_with_the_files_only_they_name(table):
    import os

    first = table.state("raw", "t").partitions
    for v in range(KEPT):
        table.commit("raw", "t", folders(table, {"a": v}))
    assert not os.path.exists(first["m=a"].removeprefix("file:"))
    assert os.path.exists(first["m=b"].removeprefix("file:"))
    numbers = {r.commit for r in table.commits("raw", "t").select("commit").collect()}
    assert numbers == {2, 3, 4}


def test_of_two_interleaved_loads_of_a_month_one_fails_and_is_logged(spark, warehouse, parquet_dir, monkeypatch):
    landing, other = Landing(warehouse, parquet_dir), Landing(warehouse, parquet_dir)
    landing.load_months()
    real, raced = Landing._stage, []

    def interleaved(self, *args):
        real(self, *args)
        if not raced:
            raced.append(True)
            other.load_month("2019-01")

    monkeypatch.setattr(Landing, "_stage", interleaved)
    with pytest.raises(Conflict, match="load_month=2019-01"):
        landing.load_month("2019-01")
    raced.clear()
    assert landing.load_month("2019-02") == 1  # the other one loads January
    logged = warehouse.table("raw", "load_log").collect()
    assert [(r.partition, r.status) for r in logged if r.status != "ok"] == [("2019-01", "failed")]
    assert warehouse.table("raw", "transactions").count() == 3


def test_history_is_published_whole(spark, warehouse, parquet_dir, monkeypatch):
    """Three months are loaded again and the job dies while publishing: not one of them changes."""
    put_sales(spark, parquet_dir, "(DATE'2019-01-05','k1','m1',1D,1), (DATE'2019-02-05','k1','m1',1D,1),"
                                  "(DATE'2019-03-05','k1','m1',1D,1)")
    landing = Landing(warehouse, parquet_dir)
    landing.load_history()
    build.build(warehouse)
    put_sales(spark, parquet_dir, "(DATE'2019-01-05','k1','m1',2D,1), (DATE'2019-02-05','k1','m1',2D,1),"
                                  "(DATE'2019-03-05','k1','m1',2D,1)")
    landing.load_months()

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    def amounts():
        return [float(r[0]) for r in warehouse.table("dwh", "fct_sales").select("sales_amount").collect()]

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "create_view", stop)
        with pytest.raises(KeyboardInterrupt):
            build.build_fact(warehouse)
    assert amounts() == [1, 1, 1]
    build.build_fact(warehouse)
    assert amounts() == [2, 2, 2]
