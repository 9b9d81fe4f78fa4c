"""Types of CSV columns that no contract names, from all their values.

Every value fits some of the types below, told by a bit each. What fits a column is the intersection over
its rows, which Spark folds in each task before one row per task moves; so a single value at the end
of a file widens its column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types a column may get, narrowest first, with what their values look like.
TYPES = [
    ("boolean", r"(?i)^(true|false)$"),
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"),
]
_ANY = (1 << len(TYPES)) - 1


def _fits(name: str) -> Column:
    """The types a text fits, as bits; a null fits all. It must look like a value of the type and be one."""
    value = F.col(f"`{name.replace('`', '``')}`")
    bits = [
        F.when(value.rlike(pattern) & value.try_cast(kind).isNotNull(), 1 << k).otherwise(0)
        for k, (kind, pattern) in enumerate(TYPES)
    ]
    return F.when(value.isNull(), _ANY).otherwise(reduce(Column.bitwiseOR, bits))


def inferred(rows: DataFrame, names: list[str]) -> dict[str, str]:
    """The narrowest type that all values of each text column fit: text itself, if there is none or no value.

    Whole numbers fit double, dates fit timestamp. Numbers beyond bigint become doubles, and leading zeros
    do not keep a number from being one: ids belong in the contract.
    """
    if not names:
        return {}
    found = rows.agg(*[F.bit_and(_fits(n)).alias(f"c{k}") for k, n in enumerate(names)]).first()
    kinds = {}
    for name, bits in zip(names, found):
        fits = [kind for k, (kind, _) in enumerate(TYPES) if bits is not None and bits >> k & 1]
        kinds[name] = fits[0] if fits and bits != _ANY else "string"
    return kinds


def typed(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows with the given text columns cast to the types that fit them."""
    kinds = inferred(rows, names)
    columns = []
    for name in rows.columns:
        column = F.col(f"`{name.replace('`', '``')}`")
        columns.append(column.cast(kinds[name]).alias(name) if name in kinds else column)
    return rows.select(*columns)
