"""Every check on a passing and a failing input."""

from datetime import datetime

import pyarrow as pa
import pytest

from starloom.operators import quality
from starloom.sinks.landing import Landing


@pytest.fixture(scope="module")
def rows(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('a', 1, 0), ('a', 2, 1), ('b', NULL, 2), (NULL, 1, 3), (NULL, 1, 3)"
        " AS t(k, v, n)"
    )


def out(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_not_null(rows):
    assert out(quality.not_null(rows, "v")) == [("b", None, 2)]
    assert out(quality.not_null(rows, "n")) == []


def test_unique_ignores_nulls(rows):
    assert out(quality.unique(rows, "k")) == [("a", 2)]
    assert out(quality.unique(rows.where("v = 2"), "k")) == []


def test_unique_combination_groups_nulls(rows):
    assert out(quality.unique_combination(rows, ["k", "v"])) == [(None, 1, 2)]
    assert out(quality.unique_combination(rows.where("k IS NOT NULL"), ["k", "v"])) == []


def test_unique_combination_is_lazy_and_keeps_to_one_commit(spark, warehouse, parquet_dir):
    """The frame is only a plan: building it runs nothing. It reads the commit its table was taken from."""
    landing = Landing(warehouse, parquet_dir)
    landing.load_month("2019-01")
    sales = warehouse.table("raw", "transactions")
    spark.sparkContext.setJobGroup("building", "unique_combination")
    repeats = quality.unique_combination(sales, ["sales_channel_id"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext._jsc.clearJobGroup()
    landing.load_month("2019-02")
    assert out(repeats) == []
    now = warehouse.table("raw", "transactions")
    assert out(quality.unique_combination(now, ["sales_channel_id"])) == [(2, 2)]


def test_unique_combination_tells_equal_hashes_apart(spark):
    """Nulls do not enter the hash, so these two rows share one."""
    rows = spark.sql("SELECT * FROM VALUES ('a', NULL), (NULL, 'a') AS t(k, v)")
    assert out(quality.unique_combination(rows, ["k", "v"])) == []


def test_relationships_pass_null_keys(rows, spark):
    parents = spark.sql("SELECT * FROM VALUES ('b'), ('b'), (NULL) AS p(id)")
    assert out(quality.relationships(rows, "k", parents, "id")) == [("a", 2)]
    assert out(quality.relationships(rows.where("k = 'b'"), "k", parents, "id")) == []
    nobody = parents.where("id = 'x'")
    assert out(quality.relationships(rows, "k", nobody, "id")) == [("a", 2), ("b", 1)]


def test_accepted_values_pass_null(rows):
    assert out(quality.accepted_values(rows, "v", [2])) == [(1, 3)]
    assert out(quality.accepted_values(rows, "v", [1, 2])) == []


def test_between(rows):
    assert out(quality.between(rows, "n", minimum=0, strictly=True)) == [("a", 1, 0)]
    assert out(quality.between(rows, "n", minimum=0)) == []
    assert out(quality.between(rows, "n", maximum=2)) == [(None, 1, 3), (None, 1, 3)]
    assert out(quality.between(rows, "v", minimum=1)) == []


def test_freshness(spark):
    now = datetime(2019, 3, 3, 12)
    stamped = spark.sql("SELECT TIMESTAMP_NTZ'2019-03-01 12:00:00' AS ingestion_ts")
    older = spark.sql("SELECT TIMESTAMP_NTZ'2019-03-01 11:59:59' AS ingestion_ts")
    sources = {"new": stamped, "old": older, "none": older.where("false")}
    statuses = {r.source_name: r.status for r in quality.freshness(sources, now).collect()}
    assert statuses == {"new": "pass", "old": "warn", "none": "warn"}


def test_report_counts_failing_rows(spark, rows):
    suite = [
        quality.Check("t", "not_null", "v"),
        quality.Check("t", "unique", "k"),
        quality.Check("t", "unique", "k", where="v = 2"),
        quality.Check("t", "between", "n", minimum=0, strictly=True),
        quality.Check("t", "accepted_values", "v", values=(1,)),
        quality.Check("t", "unique_combination", "", columns=("k", "v")),
        quality.Check("t", "relationships", "k", parent=("p", "id")),
        quality.Check("absent", "not_null", "v"),
    ]
    parents = spark.sql("SELECT 'b' AS id")
    report = quality.report({"t": rows, "p": parents}, suite).collect()
    assert {(r.check_name, r.failures, r.status) for r in report} == {
        ("not_null_t_v", 1, "fail"),
        ("unique_t_k", 1, "fail"),
        ("unique_t_k_where_v = 2", 0, "pass"),
        ("between_t_n", 1, "fail"),
        ("accepted_values_t_v", 1, "fail"),
        ("unique_combination_t_k_v", 1, "fail"),
        ("relationships_t_k", 2, "fail"),
    }


def test_suite_has_all_declared_checks():
    kinds = [c.kind for c in quality.SUITE]
    assert len(kinds) == 38
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 17, "unique": 10, "relationships": 6, "between": 3, "accepted_values": 1,
        "unique_combination": 1,
    }


def test_key_states_stay_in_the_tasks_that_read_them(spark):
    suite = [c for c in quality.SUITE if c.table == "stg_transactions" and c.kind == "relationships"]
    sold = [(1, "m1", "k1"), (1, "m1", "k1"), (1, None, "k1"), (2, "m1", None), (2, "", "k1"), (None, "m1", "k2")]
    rows = spark.createDataFrame(sold, "sale_month int, article_id string, customer_id string").repartition(3)
    rows = rows.localCheckpoint()
    found = quality.states(rows, "stg_transactions", "sale_month", suite)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    counts = {}
    for r in found.collect():
        place = (r.sale_month, r.check_name.rsplit("transactions_")[-1], r.key)
        counts[place] = counts.get(place, 0) + r.n_records
    assert counts == {
        (1, "article_id", "m1"): 2, (2, "article_id", "m1"): 1, (2, "article_id", ""): 1, (None, "article_id", "m1"): 1,
        (1, "customer_id", "k1"): 3, (2, "customer_id", "k1"): 1, (None, "customer_id", "k2"): 1,
    }


def test_keys_are_combined_a_bounded_part_at_a_time(monkeypatch):
    batch = pa.record_batch({"by": pa.array([1, 1, 1]), "key0": ["a", "a", None], "key1": ["b", "c", "b"]})
    schema = pa.schema({"by": pa.int64(), "reference": pa.int32(), "key": pa.string(), "n_records": pa.int64()})

    def counts():
        found = quality._combined(iter([batch, batch]), "by", schema)
        return sorted((r["reference"], r["key"], r["n_records"]) for b in found for r in b.to_pylist())

    assert counts() == [(0, "a", 4), (1, "b", 4), (1, "c", 2)]
    monkeypatch.setattr(quality, "COMBINED_BYTES", 1)
    assert counts() == [(0, "a", 2), (0, "a", 2), (1, "b", 2), (1, "b", 2), (1, "c", 1), (1, "c", 1)]
