"""Change tracking: keep every version of a checked column with its validity interval."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import scd_id, timestamp
from starloom.schemas import SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO

BOOKKEEPING = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]


def open_versions(source: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """A first run: every source row becomes an open version."""
    now = timestamp(run_ts)
    return source.select(
        "*",
        scd_id(key, now).alias(SCD_ID),
        now.alias(UPDATED_AT),
        now.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def changed_versions(
    open_rows: DataFrame, source: DataFrame, key: str, check_cols: list[str], run_ts: datetime
) -> DataFrame:
    """Rows that replace `open_rows` after comparing them with `source`.

    A key seen for the first time gets an open row. If a checked column differs (nulls compare
    equal) the old row is closed and a new one opened. Otherwise the old row stays as it is,
    unchecked columns included; so does the row of a key that left the source.

    One full outer join yields both the old and the new row of a key, so the join runs once.
    """
    columns = [c for c in source.columns] + BOOKKEEPING
    old = open_rows.select(F.struct(*columns).alias("old"), F.col(key).alias("old_key"))
    new = open_versions(source, key, run_ts).select(
        F.struct(*columns).alias("new"), F.col(key).alias("new_key")
    )
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    differs = F.lit(False)
    for column in check_cols:
        differs = differs | ~F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    closed = F.col("old").withField(VALID_TO, timestamp(run_ts))
    kept = F.when(both & differs, closed).otherwise(F.col("old"))
    added = F.when(F.col("old").isNull() | differs, F.col("new"))
    return (
        old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")
        .select(F.explode(F.array(kept, added)).alias("version"))
        .where(F.col("version").isNotNull())
        .select("version.*")
    )


def snapshot_check(
    previous: DataFrame | None,
    source: DataFrame,
    key: str,
    check_cols: list[str],
    run_ts: datetime,
) -> DataFrame:
    """The whole change-tracked table after one run; `previous` is None on the first."""
    if previous is None:
        return open_versions(source, key, run_ts)
    columns = [c for c in source.columns] + BOOKKEEPING
    previous = previous.select(*columns)
    return previous.where(F.col(VALID_TO).isNotNull()).unionByName(
        changed_versions(
            previous.where(F.col(VALID_TO).isNull()), source, key, check_cols, run_ts
        )
    )


def replay(monthly: DataFrame) -> DataFrame:
    """All price versions that one snapshot run after each month, in order, would leave.

    Closed form in one pass: a month opens a version when its median differs from the article's
    previous month, and the next such month closes it. Runs are stamped with the month's first
    day. An article has at most one row per calendar month, which bounds the window.
    """
    article = Window.partitionBy("article_id").orderBy("price_month")
    previous = F.lag("median_price").over(article)
    first = F.row_number().over(article) == 1
    versions = monthly.withColumn(
        "opens", first | ~previous.eqNullSafe(F.col("median_price"))
    ).where("opens")
    started = F.col("price_month").cast("timestamp_ntz")
    return versions.select(
        "article_id",
        "price_month",
        "median_price",
        scd_id(F.col("article_id"), started).alias(SCD_ID),
        started.alias(UPDATED_AT),
        started.alias(VALID_FROM),
        F.lead(started).over(article).alias(VALID_TO),
    )
