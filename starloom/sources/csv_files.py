"""Typed CSV reads and their one-time conversion to Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import DATASETS
from starloom.sources import files
from starloom.sources.csv_records import read_records
from starloom.sources.inference import typed


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row. Quotes are escaped by doubling; a bad value fails the read, and so
    does a header that lacks a column of the schema.

    Columns come in the order of the header. Those that the schema does not name get the narrowest type
    that all their values fit, which takes a scan of its own.

    A multi-line read puts lines together again, which takes three scans, so ask for it only where a
    quoted field can hold a line break.
    """
    declared = schema.names
    schema = _with_extra_columns(_header(spark, path, multi_line), schema, path)
    if multi_line:
        rows = read_records(spark, path, schema)
    else:
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path)
        )
    return typed(rows, [n for n in schema.names if n not in declared])


def _header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    """Column names of the first file; without type inference Spark reads no more than its first rows.

    A name may hold a line break only in a multi-line read.
    """
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
        .columns
    )


def _with_extra_columns(header: list[str], schema: T.StructType, path: str) -> T.StructType:
    lacking = [name for name in schema.names if name not in header]
    if lacking:
        raise ValueError(f"CSV header does not conform to the schema: {path} lacks {lacking}")
    declared = {f.name: f for f in schema}
    return T.StructType(
        [declared.get(name, T.StructField(name, T.StringType())) for name in header]
    )


def convert(
    spark: SparkSession,
    src: str,
    dst: str,
    schema: T.StructType,
    multi_line: bool = False,
    force: bool = False,
    order: str | None = None,
) -> int:
    """Write one CSV as Parquet and return its row count; 0 if the target is already complete.

    With `order`, rows are dealt out by ranges of that column and sorted by it, so that a read of
    one range skips the other files and row groups by their statistics. A value that many rows share is
    still spread, by a hash of the rows.

    What a broken run left is not complete and is written again. The count comes from the written
    files, so it is right even when tasks were retried.
    """
    if files.is_written(spark, dst) and not force:
        return 0
    rows = read_csv(spark, src, schema, multi_line)
    if order is not None:
        spread = F.xxhash64(*[F.col(f"`{c.replace('`', '``')}`") for c in rows.columns])
        rows = rows.repartitionByRange(order, spread).sortWithinPartitions(order)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(dst)
    return spark.read.parquet(dst).count()


def convert_all(spark: SparkSession, data_dir: str, force: bool = False) -> dict[str, int]:
    """Convert every input file from `raw/` to `parquet/` below `data_dir`."""
    return {
        d.file_name: convert(
            spark,
            f"{data_dir}/raw/{d.file_name}.csv",
            f"{data_dir}/parquet/{d.file_name}.parquet",
            d.schema,
            d.multi_line,
            force,
            d.order,
        )
        for d in DATASETS.values()
    }
