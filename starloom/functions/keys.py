"""Hash keys as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for a null key part, and the separators between parts.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
SCD_SEPARATOR = "|"


def surrogate_key_sql(*columns: str) -> str:
    """SQL text of a surrogate key, for views."""
    texts = ", ".join(f"coalesce(cast(`{c}` as string), '{NULL_KEY}')" for c in columns)
    return f"md5(concat_ws('{KEY_SEPARATOR}', {texts}))"


def surrogate_key(*columns: str) -> Column:
    """md5 over the text of one or more natural key columns."""
    return F.expr(surrogate_key_sql(*columns))


def scd_id(*parts: str | Column) -> Column:
    """md5 that identifies one version row of a change-tracked table."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(SCD_SEPARATOR, *texts))
