"""The cleaning models on awkward values."""

from decimal import Decimal

import pytest

from starloom.operators import marts, staging
from starloom.sources import seeds


def landed_customers(spark, values):
    return staging.raw_customers(
        spark.sql(
            f"SELECT * FROM VALUES {values} AS t(customer_id, FN, Active, club_member_status,"
            " fashion_news_frequency, age, postal_code, ingestion_ts)"
        )
    )


def customer(key, fn="NULL", active="NULL", news="NULL", age="NULL"):
    return (
        f"('{key}', CAST({fn} AS DOUBLE), CAST({active} AS DOUBLE), 'ACTIVE',"
        f" CAST({news} AS STRING), {age}, 'p', TIMESTAMP_NTZ'2019-01-01 00:00:00')"
    )


def test_flags_and_none_spellings(spark):
    raw = landed_customers(
        spark,
        ", ".join([
            customer("a", "1.0", "0.0", "'None'", "CAST(NULL AS INT)"),
            customer("b", news="'nOnE'", age="20"),
            customer("c", news="'Regularly'", age="20"),
            customer("d", age="20"),
        ]),
    )
    assert raw.columns[1:3] == ["fn", "active"]
    out = {r.customer_id: r for r in staging.stg_customers(raw).collect()}
    assert [(out[k].has_fashion_news, out[k].is_active) for k in "ab"] == [
        (True, False), (False, False),
    ]
    assert [out[k].fashion_news_frequency for k in "abcd"] == ["NONE", "NONE", "Regularly", None]


def test_fractional_age_rounds_half_to_even(spark):
    raw = landed_customers(
        spark, ", ".join(customer(k, age=f"{v}D") for k, v in
                         [("a", 24.5), ("b", 25.5), ("c", 24.4), ("d", 24.6)])
    )
    ages = {r.customer_id: r.age for r in staging.stg_customers(raw).collect()}
    assert ages == {"a": 24, "b": 26, "c": 24, "d": 25}


def test_age_band_edges(spark):
    edges = {15: None, 16: "16-24", 24: "16-24", 25: "25-34", 64: "55-64", 65: "65+",
             120: "65+", 121: None}
    values = [customer(str(a), age=str(a)) for a in edges] + [customer("none", age="NULL")]
    customers = staging.stg_customers(landed_customers(spark, ", ".join(values)))
    out = marts.dim_customer(customers, seeds.age_bands(spark)).collect()
    assert {r.customer_id: r.age_band for r in out} == {
        **{str(a): b for a, b in edges.items()}, "none": None,
    }
    assert len(out) == len(edges) + 1


def landed_sales(spark, values):
    return staging.raw_transactions(
        spark.sql(
            f"SELECT *, TIMESTAMP_NTZ'2019-01-01 00:00:00' AS ingestion_ts FROM VALUES {values}"
            " AS t(t_dat, customer_id, article_id, price, sales_channel_id)"
        )
    )


def test_transaction_types_and_repeats(spark):
    sale = "(DATE'2019-01-05', 'c1', 'a1', 0.05D, 1)"
    stg = staging.stg_transactions(landed_sales(spark, f"{sale}, {sale}"))
    types = {f.name: f.dataType.simpleString() for f in stg.schema}
    assert types["price"] == "decimal(12,8)"
    assert types["sales_channel_id"] == "tinyint"
    assert stg.count() == 2
    fact = marts.fct_sales(stg).collect()
    assert [(r.quantity, r.sales_amount) for r in fact] == [(2, Decimal("0.10000000"))]


def test_bad_values_raise(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW|out of range|overflow"):
        staging.stg_transactions(
            landed_sales(spark, "(DATE'2019-01-05', 'c1', 'a1', 0.05D, 1000)")
        ).collect()
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        staging.stg_transactions(
            landed_sales(spark, "(DATE'2019-01-05', 'c1', 'a1', 1e9D, 1)")
        ).collect()


def test_seed_types(spark, tmp_path):
    assert seeds.age_bands(spark).schema.simpleString() == (
        "struct<band_name:string,min_age:smallint,max_age:smallint>"
    )
    assert seeds.sales_channels(spark).schema.simpleString() == (
        "struct<sales_channel_id:tinyint,channel_name:string>"
    )
    (tmp_path / "channels.csv").write_text("sales_channel_id,channel_name\n3,phone\n")
    from_file = seeds.sales_channels(spark, str(tmp_path / "channels.csv"))
    assert [tuple(r) for r in from_file.collect()] == [(3, "phone")]
