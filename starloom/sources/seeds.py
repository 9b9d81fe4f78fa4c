"""The two lookup tables, with their narrow column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.functions import known_rows
from starloom.schemas import AGE_BAND_ROWS, AGE_BANDS, SALES_CHANNEL_ROWS, SALES_CHANNELS
from starloom.sources.csv_files import read_csv


def _lookup(
    spark: SparkSession, rows: list[tuple], schema: T.StructType, csv_path: str | None
) -> DataFrame:
    if csv_path is not None:
        return read_csv(spark, csv_path, schema)
    return known_rows(spark, rows, schema)


def age_bands(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The standard bands, or those of a CSV with the same columns."""
    return _lookup(spark, AGE_BAND_ROWS, AGE_BANDS, csv_path)


def sales_channels(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    return _lookup(spark, SALES_CHANNEL_ROWS, SALES_CHANNELS, csv_path)
