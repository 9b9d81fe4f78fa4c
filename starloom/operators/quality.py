"""Data-quality checks. Each returns its failing rows; an empty result is a pass.

Checks over groups return one row per offending value with the number of rows behind it, so that
a value shared by a third of the table is one row, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.functions import timestamp
from starloom.schemas import INGESTION_TS

# Fixed value: age at which a landing table counts as stale.
FRESHNESS = timedelta(hours=48)
# Bytes of rows that a task holds at a time to combine their keys.
COMBINED_BYTES = 64 << 20


def _outside(
    column: str, minimum: float | None, maximum: float | None, strictly: bool
) -> Column:
    value, bad = F.col(column), F.lit(False)
    if minimum is not None:
        bad = bad | ((value <= minimum) if strictly else (value < minimum))
    if maximum is not None:
        bad = bad | ((value >= maximum) if strictly else (value > maximum))
    return bad


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def unique_combination(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Column combinations that occur more than once; nulls group together.

    Repeats combine before the shuffle, and rows move once. Narrowing the rows down by a hash first
    would move them twice, unless the repeated hashes were brought to the driver.
    """
    return (
        rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent; a null key passes.

    Both sides are reduced to one row per key first, so no key is large in the join. It is an
    outer join on purpose: Spark would move an anti join below the counting, onto the raw rows.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = (
        parent.select(F.col(field).alias("to_field")).distinct().withColumn("found", F.lit(True))
    )
    return (
        keys.join(parents, F.col("from_field") == F.col("to_field"), "left")
        .where(F.col("found").isNull())
        .select("from_field", "n_records")
    )


def accepted_values(rows: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their row counts; null passes."""
    return (
        rows.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def between(
    rows: DataFrame,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    strictly: bool = False,
) -> DataFrame:
    """Rows outside the bounds; null passes."""
    return rows.where(_outside(column, minimum, maximum, strictly))


def freshness(sources: dict[str, DataFrame], run_ts: datetime) -> DataFrame:
    """Newest load per source; 'warn' if it is older than 48 hours or there is none."""
    reports = [
        rows.agg(F.max(INGESTION_TS).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"), "max_loaded_at"
        )
        for name, rows in sources.items()
    ]
    merged = reports[0]
    for report in reports[1:]:
        merged = merged.unionByName(report)
    fresh = F.col("max_loaded_at") >= timestamp(run_ts - FRESHNESS)
    return merged.withColumn("status", F.when(fresh, "pass").otherwise("warn"))


@dataclass(frozen=True)
class Check:
    """One declared check on a column (or, for a combination, columns) of a table."""

    table: str
    kind: str
    column: str
    columns: tuple[str, ...] = ()
    where: str | None = None
    parent: tuple[str, str] | None = None
    values: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    strictly: bool = False

    @property
    def name(self) -> str:
        parts = [self.kind, self.table, self.column or "_".join(self.columns)]
        if self.where:
            parts.append(f"where_{self.where}")
        return "_".join(parts)


def _keyed(table: str, column: str) -> list[Check]:
    return [Check(table, "not_null", column), Check(table, "unique", column)]


def _refers(table: str, column: str, parent: str, field: str) -> list[Check]:
    return [
        Check(table, "not_null", column),
        Check(table, "relationships", column, parent=(parent, field)),
    ]


# The 38 checks declared on the warehouse.
SUITE: list[Check] = [
    *_keyed("raw_articles", "article_id"),
    *_keyed("raw_customers", "customer_id"),
    Check("stg_transactions", "not_null", "sale_date"),
    *_refers("stg_transactions", "article_id", "stg_articles", "article_id"),
    *_refers("stg_transactions", "customer_id", "stg_customers", "customer_id"),
    Check("stg_transactions", "between", "price", minimum=0, strictly=True),
    Check("stg_transactions", "not_null", "sales_channel_id"),
    Check("stg_transactions", "accepted_values", "sales_channel_id", values=(1, 2)),
    *_keyed("stg_articles", "article_id"),
    *_keyed("stg_customers", "customer_id"),
    *_keyed("dim_date", "date_day"),
    *_keyed("dim_channel", "channel_sk"),
    *_keyed("dim_customer", "customer_sk"),
    *_keyed("dim_article_price_history", "price_version_sk"),
    Check("dim_article_price_history", "unique", "article_id", where="is_current"),
    *_keyed("dim_article", "article_sk"),
    Check("dim_article", "between", "current_price", minimum=0, strictly=True),
    Check(
        "fct_sales",
        "unique_combination",
        "",
        columns=("sale_date", "customer_id", "article_id", "channel_sk"),
    ),
    *_refers("fct_sales", "customer_sk", "dim_customer", "customer_sk"),
    *_refers("fct_sales", "article_sk", "dim_article", "article_sk"),
    *_refers("fct_sales", "channel_sk", "dim_channel", "channel_sk"),
    *_refers("fct_sales", "sale_date", "dim_date", "date_day"),
    Check("fct_sales", "between", "quantity", minimum=1),
]

_ROW_KINDS = ("not_null", "accepted_values", "between")


def fails(check: Check) -> Column:
    """Whether a row fails a check on single rows."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    return _outside(check.column, check.minimum, check.maximum, check.strictly)


def _row_failures(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """All single-row checks of one table from one scan."""
    counts = rows.agg(
        *[F.count_if(fails(c)).alias(f"c{i}") for i, c in enumerate(checks)]
    )
    pairs = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.table).alias("table_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def _group_failures(check: Check, rows: DataFrame) -> DataFrame:
    if check.where:
        rows = rows.where(check.where)
    if check.kind == "unique":
        failing = unique(rows, check.column)
    else:
        failing = unique_combination(rows, list(check.columns))
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"), "failures"
    )


def references(table: str, suite: list[Check] = SUITE) -> list[Check]:
    """The checks on foreign keys of one table."""
    return [c for c in suite if c.table == table and c.kind == "relationships"]


def reference_keys(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """All foreign keys of one table from one scan, as reference (place in checks), key and n_records.

    Keys are counted by column and value before the shuffle, so a key that a third of the rows hold is
    one row from each task.
    """
    pairs = [
        F.struct(F.lit(i).alias("reference"), F.col(c.column).cast("string").alias("key"))
        for i, c in enumerate(checks)
    ]
    return (
        rows.select(F.inline(F.array(*pairs)))
        .where(F.col("key").isNotNull())
        .groupBy("reference", "key")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _combined(batches: Iterator[pa.RecordBatch], by: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of `by` and one column for each reference: the counts of their values, some rows at a time."""

    def counts(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        for i, name in enumerate(table.column_names[1:]):
            keys = table.select([by, name]).rename_columns([by, "key"])
            keys = keys.filter(keys["key"].is_valid()).group_by([by, "key"], use_threads=False)
            found = keys.aggregate([([], "count_all")]).rename_columns({"count_all": "n_records"})
            found = found.append_column("reference", pa.array([i] * len(found), pa.int32()))
            yield from found.select(schema.names).cast(schema).to_batches(max_chunksize=10_000)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= COMBINED_BYTES:
            yield from counts(held)
            held, size = [], 0
    if held:
        yield from counts(held)


def _reference_states(rows: DataFrame, checks: list[Check], by: str) -> DataFrame:
    """All foreign keys of one table from one scan, as `by`, reference (place in checks), key and n_records.

    Equal keys are combined within their task, a bounded number of rows at a time, and nothing is
    shuffled: rows that lie by `by` in files stay where they lie. So a key can have several rows, whose
    counts add up.
    """
    found = T.StructType(
        [
            rows.schema[by],
            T.StructField("reference", T.IntegerType()),
            T.StructField("key", T.StringType()),
            T.StructField("n_records", T.LongType()),
        ]
    )
    columns = [F.col(c.column).cast("string").alias(f"key{i}") for i, c in enumerate(checks)]
    keyed = rows.select(by, *columns)
    schema = to_arrow_schema(found)
    return keyed.mapInArrow(lambda batches: _combined(batches, by, schema), found)


def with_parents(keys: DataFrame, checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Add found to keys: true, or null without a parent. As in relationships(), the join is an outer one.

    It is a merge on purpose: Spark takes one column of wide tables for far smaller than it is, and would
    bring the keys of all parents to the driver to broadcast them.
    """
    parents = None
    for i, c in enumerate(checks):
        table, field = c.parent
        own = tables[table].select(F.lit(i).alias("reference"), F.col(field).cast("string").alias("key"))
        parents = own if parents is None else parents.unionByName(own)
    parents = parents.distinct().withColumn("found", F.lit(True))
    return keys.join(parents.hint("merge"), ["reference", "key"], "left")


def _missing(keys: DataFrame, checks: list[Check], tables: dict[str, DataFrame], *by: str) -> DataFrame:
    """Of one table's keys, as reference_keys() gives them: a row without parents counts once per key.

    Keys may come in several rows, whose counts add up.
    """
    missing = F.when(F.col("found").isNull(), F.col("n_records")).otherwise(0)
    return with_parents(keys, checks, tables).groupBy(*by, "reference").agg(F.sum(missing).alias("failures"))


def _listed(found: DataFrame, checks: list[Check]) -> DataFrame:
    """check_name, table_name and failures of every check, by reference, 0 where there is no row."""
    names = F.array(
        *[
            F.struct(
                F.lit(i).alias("reference"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.table).alias("table_name"),
            )
            for i, c in enumerate(checks)
        ]
    )
    listed = found.sparkSession.range(0, 1, 1, 1).select(F.inline(names))
    return listed.join(found, "reference", "left").select(
        "check_name", "table_name", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def _reference_failures(
    keys: DataFrame, checks: list[Check], tables: dict[str, DataFrame]
) -> DataFrame:
    return _listed(_missing(keys, checks, tables), checks)


# -- states ----------------------------------------------------------------------------------------


def states(rows: DataFrame, table: str, by: str, suite: list[Check] = SUITE) -> DataFrame:
    """What the checks of a table need to know of its rows, by a column: `by`, check_name, key, n_records.

    States of different values of `by` add up, so those of rows that did not change need not be taken
    again. Checks on single rows and on groups have one row each, key null, with their failures;
    foreign keys have rows for each value, as its parent may come and go. A group must lie within one value
    of `by`, as the grain of a fact does within its month; uniqueness over all rows has no such state.
    The few rows of the former are put together by `by`; those of keys stay in the tasks that read them.
    """
    own = [c for c in suite if c.table == table]
    if any(c.kind == "unique" for c in own):
        raise ValueError(f"uniqueness over all rows of {table} cannot be added up")
    single = [c for c in own if c.kind in _ROW_KINDS]
    none = F.lit(None).cast("string").alias("key")
    parts = []
    if single:
        counts = rows.groupBy(by).agg(*[F.count_if(fails(c)).alias(f"c{i}") for i, c in enumerate(single)])
        pairs = [
            F.struct(F.lit(c.name).alias("check_name"), none, F.col(f"c{i}").alias("n_records"))
            for i, c in enumerate(single)
        ]
        parts.append(counts.select(by, F.inline(F.array(*pairs))))
    for c in own:
        if c.kind == "unique_combination":
            failing = unique_combination(rows, [by, *c.columns]).groupBy(by)
            counts = failing.agg(F.count(F.lit(1)).alias("n_records"))
            parts.append(counts.select(by, F.lit(c.name).alias("check_name"), none, "n_records"))
    if parts:
        few = parts[0]
        for part in parts[1:]:
            few = few.unionByName(part)
        parts = [few.hint("rebalance", F.col(by))]
    referring = references(table, own)
    if referring:
        names = F.array(*[F.lit(c.name) for c in referring])
        keys = _reference_states(rows, referring, by)
        parts.append(keys.select(by, F.get(names, "reference").alias("check_name"), "key", "n_records"))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def _place(checks: list[Check]) -> Column:
    return (F.array_position(F.array(*[F.lit(c.name) for c in checks]), F.col("check_name")) - 1).cast("int")


def state_failures(
    held: DataFrame, table: str, tables: dict[str, DataFrame], *by: str, suite: list[Check] = SUITE
) -> DataFrame:
    """Failures of a table's checks from their states, added up; by the columns in `by`, if any."""
    own = [c for c in suite if c.table == table]
    referring = references(table, own)
    others = [c for c in own if c not in referring]
    place = [F.struct(F.lit(c.name), F.lit(c.table)) for c in own]
    summed = held.withColumn("reference", _place(others)).where("reference >= 0")
    summed = summed.groupBy(*by, "reference").agg(F.sum("n_records").alias("failures"))
    found = summed.withColumn("reference", _place_of(others, own))
    if referring:
        keys = held.withColumn("reference", _place(referring)).where("reference >= 0")
        if not by:
            keys = keys.groupBy("reference", "key").agg(F.sum("n_records").alias("n_records"))
        # by month, a key has a row from each task at most a few times: they meet its parent as they are
        missing = _missing(keys, referring, tables, *by)
        found = found.unionByName(missing.withColumn("reference", _place_of(referring, own)))
    if not by:
        return _listed(found, own)
    return found.withColumn("_", F.get(F.array(*place), "reference")).select(
        *by, F.col("_.col1").alias("check_name"), F.col("_.col2").alias("table_name"), "failures"
    )


def _place_of(some: list[Check], own: list[Check]) -> Column:
    """The place of a check among others, given its place among some of them."""
    return F.get(F.array(*[F.lit(own.index(c)) for c in some]), F.col("reference"))


def report(
    tables: dict[str, DataFrame],
    suite: list[Check] = SUITE,
    held: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per declared check whose tables are given: name, table, failures, status.

    `held` has, by table, states() of it; they are added up instead of reading the table's rows.
    """
    held = held or {}
    known = [
        c for c in suite if c.table in tables and (c.parent is None or c.parent[0] in tables)
    ]
    parts = [state_failures(rows, table, tables, suite=known) for table, rows in held.items()]
    known = [c for c in known if c.table not in held]
    for table in dict.fromkeys(c.table for c in known):
        on_rows = [c for c in known if c.table == table and c.kind in _ROW_KINDS]
        if on_rows:
            parts.append(_row_failures(tables[table], on_rows))
        referring = references(table, known)
        if referring:
            given = reference_keys(tables[table], referring)
            parts.append(_reference_failures(given, referring, tables))
    parts += [
        _group_failures(c, tables[c.table])
        for c in known
        if c.kind in ("unique", "unique_combination")
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return with_status(merged)


def with_status(failures: DataFrame) -> DataFrame:
    return failures.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
