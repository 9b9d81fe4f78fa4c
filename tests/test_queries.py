"""Every registered query against its SQL on DuckDB, at the smallest scale."""

from pathlib import Path

import pytest

from retail_checks import compare, queries
from retail_checks.oracles import ORACLES
from retail_checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_rows_that_queries_store_are_as_small_as_the_warehouse(spark):
    import pyarrow.parquet as pq

    kept = queries.stored(spark.range(1000).selectExpr("id", "md5(cast(id AS string)) AS sk"))
    for file in kept.inputFiles():
        columns = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
        assert {columns.column(k).compression for k in range(2)} == {"ZSTD"}


def test_a_changed_input_is_read_from_the_same_files(spark):
    loader = queries.landing(spark, SF_DIR, queries.adapter.REPEATED_PRICE)
    lacking = queries.lacking_customers(loader)
    assert lacking.warehouse is loader.warehouse
    for name in ("transactions", "articles", "customers"):
        assert sorted(lacking.source(name).inputFiles()) == sorted(loader.source(name).inputFiles())
    gone = loader.source("customers").exceptAll(lacking.source("customers"))
    assert {int(r.customer_id) % 50 for r in gone.collect()} == {7}
    assert lacking.source("transactions").count() == loader.source("transactions").count()
