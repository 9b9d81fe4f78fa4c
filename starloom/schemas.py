"""Column contracts of the landing files, the audit log, the seeds and the snapshot.

Nothing is inferred: ids stay text so that leading zeros survive, and every cast is named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


TRANSACTIONS = T.StructType(
    [
        T.StructField("t_dat", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("sales_channel_id", T.IntegerType()),
    ]
)

ARTICLES = T.StructType(
    _fields(T.StringType(), "article_id")
    + _fields(T.IntegerType(), "product_code")
    + _fields(
        T.StringType(),
        "prod_name",
        "product_type_no",
        "product_type_name",
        "product_group_name",
        "graphical_appearance_no",
        "graphical_appearance_name",
        "colour_group_code",
        "colour_group_name",
        "perceived_colour_value_id",
        "perceived_colour_value_name",
        "perceived_colour_master_id",
        "perceived_colour_master_name",
        "department_no",
        "department_name",
        "index_code",
        "index_name",
        "index_group_no",
        "index_group_name",
        "section_no",
        "section_name",
        "garment_group_no",
        "garment_group_name",
        "detail_desc",
    )
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("FN", T.DoubleType()),
        T.StructField("Active", T.DoubleType()),
        T.StructField("club_member_status", T.StringType()),
        T.StructField("fashion_news_frequency", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("postal_code", T.StringType()),
    ]
)

LOAD_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)

INGESTION_TS = "ingestion_ts"


@dataclass(frozen=True)
class Dataset:
    """One landing file. `multi_line` is set only where free text can hold a line break, because
    lines then have to be put together to records. `order` is the column that loads select by."""

    file_name: str
    schema: T.StructType
    multi_line: bool = False
    order: str | None = None


# Names of the three input files.
DATASETS = {
    "transactions": Dataset("transactions_train", TRANSACTIONS, order="t_dat"),
    "articles": Dataset("articles", ARTICLES, multi_line=True),
    "customers": Dataset("customers", CUSTOMERS),
}
DIMENSIONS = ("articles", "customers")

AGE_BANDS = T.StructType(
    [
        T.StructField("band_name", T.StringType()),
        T.StructField("min_age", T.ShortType()),
        T.StructField("max_age", T.ShortType()),
    ]
)
SALES_CHANNELS = T.StructType(
    [
        T.StructField("sales_channel_id", T.ByteType()),
        T.StructField("channel_name", T.StringType()),
    ]
)

# The two lookup tables.
AGE_BAND_ROWS = [
    ("16-24", 16, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
    ("65+", 65, 120),
]
SALES_CHANNEL_ROWS = [(1, "store"), (2, "online")]

# Bookkeeping columns of a change-tracked table.
SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def dimension(name: str) -> Dataset:
    """Dataset of a dimension that may be loaded whole; any other name is refused."""
    if name not in DIMENSIONS:
        raise ValueError(f"not a dimension: {name!r} (expected one of {DIMENSIONS})")
    return DATASETS[name]
