"""A few known rows as a DataFrame, without a Python round trip."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.calendar import timestamp


def _literal(value, kind: T.DataType) -> Column:
    literal = timestamp(value) if isinstance(value, datetime) else F.lit(value)
    return literal.cast(kind)


def known_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    records = [
        F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(row, schema)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))
