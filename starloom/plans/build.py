"""Jobs that build the warehouse from the landing tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import month_bounds, month_start, utc_now
from starloom.operators import marts, median, quality, snapshot, staging
from starloom.schemas import DATASETS, SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO
from starloom.sinks.landing import LOAD_MONTH, Landing, loaded_months
from starloom.sinks.warehouse import LAYERS, VERSION, Warehouse, write_partitioned
from starloom.sources import csv_files, files, seeds

SNAPSHOT = "snap_article_price"
_SNAPSHOT_DATA = "snap_article_price_versions"
_SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("article_id", T.StringType()),
        T.StructField("price_month", T.DateType()),
        T.StructField("median_price", T.DoubleType()),
        T.StructField(SCD_ID, T.StringType()),
        T.StructField(UPDATED_AT, T.TimestampNTZType()),
        T.StructField(VALID_FROM, T.TimestampNTZType()),
        T.StructField(VALID_TO, T.TimestampNTZType()),
    ]
)
_SNAPSHOT_PARTS = T.StructType(
    [T.StructField("run", T.StringType()), T.StructField("state", T.StringType())]
)

_MONTHLY = "article_month_price"
_MONTHLY_SCHEMA = T.StructType(
    [T.StructField("article_id", T.StringType()), T.StructField("median_price", T.DoubleType())]
)

# Names of the two lookups.
SEEDS = ("seed_age_bands", "seed_sales_channels")

FACT = "fct_sales"
_FACT_DATA = "fct_sales_months"
_FACT_COLUMNS = [
    "customer_sk",
    "article_sk",
    "channel_sk",
    "sale_date",
    "sale_month",
    "customer_id",
    "article_id",
    "quantity",
    "sales_amount",
]
_FACT_SCHEMA = T.StructType(
    [
        T.StructField("customer_sk", T.StringType()),
        T.StructField("article_sk", T.StringType()),
        T.StructField("channel_sk", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("sales_amount", T.DecimalType(38, 8)),
    ]
)

_STATES = "sales_checks"
_STATES_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("n_records", T.LongType()),
    ]
)
# The tables of sales.
_SALES = ("stg_transactions", FACT)
_BUILT = "starloom.built."
_BASE = "starloom.base"


# -- month by month ------------------------------------------------------------------------------


def _refresh_months(
    w: Warehouse,
    layer: str,
    table: str,
    schema: T.StructType,
    partition: str,
    build: Callable[[DataFrame, list[str]], DataFrame],
    run_ts: datetime,
    months: list[str] | None = None,
    version: str = "",
) -> tuple[dict[str, str], list[str]]:
    """Rebuild the months of a derived table that were loaded again since its last build.

    `months` rebuilds exactly those instead. Months that no load touched would come out the same,
    so they are neither read nor written, unless they were built by another `version` of the table's
    rule. Returns the loaded months, and those rebuilt.
    """
    w.create_partitioned(
        layer, table, schema, T.StructType([T.StructField(partition, T.DateType())])
    )
    since, loaded = w.state(layer, table), loaded_months(w)
    built = since.notes
    if months is None:
        months = [m for m, run in loaded.items() if built.get(_BUILT + m) != run + version]
    if months:
        rows = w.table("raw", "transactions").where(F.col(LOAD_MONTH).isin(months))
        folder = f"{w.root}/{layer}/builds/{table}/{w.new_run(run_ts)}"
        write_partitioned(build(rows, months), partition, folder)
        notes = {_BUILT + m: loaded[m] + version for m in months if m in loaded}
        w.commit(layer, table, w.staged(folder), notes=notes, since=since)
    return loaded, months


def build_fact(
    w: Warehouse, run_ts: datetime | None = None, month: str | None = None
) -> list[str]:
    """Bring the sales fact up to date, or rebuild one month of it; returns the months rebuilt.

    Months in the new rows replace those of the table. Months the new rows lack stay, even if
    their transactions are gone. The rebalance sits between the sum and the hash keys: it moves
    the narrow rows, and cuts a month too large for one task.
    """
    if month is not None:
        month_bounds(month)

    def build(landing: DataFrame, _: list[str]) -> DataFrame:
        transactions = staging.stg_transactions(staging.raw_transactions(landing))
        grain = marts.sales_grain(transactions, month)
        return marts.with_sales_keys(grain.hint("rebalance", F.col("sale_month")))

    _, rebuilt = _refresh_months(
        w, "dwh", _FACT_DATA, _FACT_SCHEMA, "sale_month", build, run_ts or utc_now(),
        None if month is None else [month],
    )
    w.create_view("dwh", FACT, _FACT_COLUMNS, w.name("dwh", _FACT_DATA))
    return rebuilt


def _refresh_states(w: Warehouse, run_ts: datetime) -> None:
    """Take the check states of sales for the months that were loaded again, or checked otherwise before."""
    declared = sorted(str(c) for c in quality.SUITE if c.table in _SALES)
    suite = hashlib.md5("\n".join(declared).encode()).hexdigest()[:8]

    def build(landing: DataFrame, months: list[str]) -> DataFrame:
        transactions = staging.stg_transactions(staging.raw_transactions(landing))
        first_days = [month_bounds(m)[0] for m in months]
        fact = w.table("dwh", FACT).where(F.col("sale_month").isin(first_days))
        own = transactions.withColumn("sale_month", month_start("sale_date"))
        held = quality.states(own, _SALES[0], "sale_month")
        return held.unionByName(quality.states(fact, FACT, "sale_month"))

    _refresh_months(w, "dwh", _STATES, _STATES_SCHEMA, "sale_month", build, run_ts, version=suite)


def sales_states(w: Warehouse) -> dict[str, DataFrame]:
    """By table of sales, its check states by month, check and, for foreign keys, value; they add up."""
    rows = w.table("dwh", _STATES)
    landed = [month_bounds(m)[0] for m in loaded_months(w)]
    found = {}
    for table in _SALES:
        names = [c.name for c in quality.SUITE if c.table == table]
        own = rows.where(F.col("check_name").isin(names))
        # the fact keeps months that are gone from the landing table
        found[table] = own if table == FACT else own.where(F.col("sale_month").isin(landed))
    return found


def _refresh_monthly_prices(w: Warehouse, run_ts: datetime) -> DataFrame:
    """Median price per article and month, recomputed only for months that were loaded again."""
    counted = f"{w.root}/stg/builds/{_MONTHLY}_counted/{w.new_run(run_ts)}"

    def build(landing: DataFrame, _: list[str]) -> DataFrame:
        monthly = median.monthly_median_price(
            staging.raw_transactions(landing), counted, written=True
        )
        return monthly.hint("rebalance", F.col("price_month"))

    loaded, _ = _refresh_months(
        w, "stg", _MONTHLY, _MONTHLY_SCHEMA, "price_month", build, run_ts
    )
    files.delete(w.spark, counted)
    kept = {f"price_month={month}-01" for month in loaded}
    gone = [s for s in w.partitions("stg", _MONTHLY) if s not in kept]
    if gone:
        w.commit("stg", _MONTHLY, {}, gone)
    return w.table("stg", _MONTHLY).select("article_id", "price_month", "median_price")


# -- price snapshot ------------------------------------------------------------------------------


def _snapshot_run(w: Warehouse, run_ts: datetime) -> tuple[str, str]:
    """Name of the run about to start and of the run it builds on, '' for none.

    Names sort by run time, then attempt. Repeating the time of the last run replaces that run;
    build_snapshot takes care of an earlier time. Partitions that belong neither to the last run nor to the ones it
    builds on were left by runs that died or were replaced, and are dropped first.
    """
    w.create_partitioned("stg", _SNAPSHOT_DATA, _SNAPSHOT_SCHEMA, _SNAPSHOT_PARTS)
    known = w.properties("stg", SNAPSHOT)
    last, base = known.get(VERSION, ""), known.get(_BASE, "")
    stray = []
    for spec in w.partitions("stg", _SNAPSHOT_DATA):
        run, state = (part.split("=", 1)[1] for part in spec.split("/"))
        if run not in (last, base) and (state == "open" or run > base):
            stray.append(spec)
    if stray:
        w.commit("stg", _SNAPSHOT_DATA, {}, stray)

    time = f"{run_ts:%Y%m%d%H%M%S%f}"
    last_time, _, attempt = last.partition("_")
    if time < last_time:
        raise ValueError(f"snapshot run {time} is before the last one, {last_time}")
    if time == last_time:
        return f"{time}_{int(attempt) + 1:06d}", base
    return f"{time}_{0:06d}", last


def _open_rows(w: Warehouse, run: str) -> DataFrame:
    """Versions open after a run; reads only their partition."""
    rows = w.table("stg", _SNAPSHOT_DATA)
    return rows.where((F.col("run") == run) & (F.col("state") == "open")).select(
        *_SNAPSHOT_SCHEMA.fieldNames()
    )


def _publish_snapshot(w: Warehouse, rows: DataFrame, run: str, base: str) -> None:
    """Add one run: its open rows replace those of `base`, its closed rows join the earlier ones.

    Rows closed by past runs never change, so a run writes only open and newly closed rows. The
    view decides which runs count; until it is replaced, readers see the previous state.
    """
    folder = f"{w.root}/stg/builds/{_SNAPSHOT_DATA}/{w.new_run(utc_now())}"
    state = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
    staged = rows.select(*_SNAPSHOT_SCHEMA.fieldNames()).withColumn("state", state)
    write_partitioned(staged.hint("rebalance", F.col("state")), "state", folder)
    put = w.staged(folder, within=f"run={run}")
    known = w.partitions("stg", _SNAPSHOT_DATA)  # a run of this name may have died before it was shown
    w.commit("stg", _SNAPSHOT_DATA, put, [s for s in known if s.startswith(f"run={run}/") and s not in put])
    w.create_view(
        "stg",
        SNAPSHOT,
        _SNAPSHOT_SCHEMA.fieldNames(),
        w.name("stg", _SNAPSHOT_DATA),
        where=f"run = '{run}' OR (state = 'closed' AND run <= '{base}')",
        properties={VERSION: run, _BASE: base},
    )


def _splice_snapshot(w: Warehouse, run_ts: datetime) -> None:
    """A run for a month before the last one: its versions go between those that are there.

    The month's prices may split a version, join two, or move the day one begins; what is left is what
    the monthly runs would have left in order. They can be put in order if each was stamped with the
    first day of its month, which makes the monthly medians, kept by month, all there is to know. The
    whole history is written again under the last run's time, from those, not from the sales.
    """
    versions = w.table("stg", SNAPSHOT)
    apart = F.col(VALID_FROM) != F.col("price_month").cast("timestamp_ntz")
    if run_ts != datetime(run_ts.year, run_ts.month, 1) or versions.where(apart).limit(1).count():
        raise ValueError(
            f"snapshot run {run_ts} is before the last one; that takes runs stamped with first days of months"
        )
    time, _, attempt = w.properties("stg", SNAPSHOT)[VERSION].partition("_")
    rows = snapshot.replay(_refresh_monthly_prices(w, run_ts))
    _publish_snapshot(w, rows, f"{time}_{int(attempt) + 1:06d}", "")


def build_snapshot(w: Warehouse, run_ts: datetime | None = None) -> None:
    """One change-tracking run over each article's latest monthly median price.

    A run for a month before the last one is put in its place, see _splice_snapshot.
    """
    run_ts = run_ts or utc_now()
    last = w.properties("stg", SNAPSHOT).get(VERSION, "").partition("_")[0]
    if f"{run_ts:%Y%m%d%H%M%S%f}" < last:
        return _splice_snapshot(w, run_ts)
    run, base = _snapshot_run(w, run_ts)
    source = median.latest_price(_refresh_monthly_prices(w, run_ts))
    if base:
        rows = snapshot.changed_versions(
            _open_rows(w, base), source, "article_id", ["median_price"], run_ts
        )
    else:
        rows = snapshot.open_versions(source, "article_id", run_ts)
    _publish_snapshot(w, rows, run, base)


def build_snapshot_history(w: Warehouse) -> None:
    """First build of the snapshot as if it had run after each loaded month, in one pass."""
    last = max(loaded_months(w))
    run_ts = datetime.combine(month_bounds(last)[0], datetime.min.time())
    run, base = _snapshot_run(w, run_ts)
    if base:
        raise ValueError("the snapshot already has runs; a replay would rewrite them")
    _publish_snapshot(w, snapshot.replay(_refresh_monthly_prices(w, run_ts)), run, base)


# -- layers and whole runs -----------------------------------------------------------------------


def build_seeds(
    w: Warehouse, run_ts: datetime | None = None, seeds_dir: str | None = None
) -> None:
    """The two lookups, from `seed_age_bands.csv` and `seed_sales_channels.csv` if a folder is given."""
    run_ts = run_ts or utc_now()
    path = {n: f"{seeds_dir}/{n}.csv" if seeds_dir else None for n in SEEDS}
    bands, channels = SEEDS
    w.replace_table("dwh", bands, seeds.age_bands(w.spark, path[bands]), run_ts)
    w.replace_table("dwh", channels, seeds.sales_channels(w.spark, path[channels]), run_ts)


def build_layer(w: Warehouse, layer: str, run_ts: datetime | None = None) -> list[str]:
    """Build the models of one layer: the raw or staging views, or the star tables.

    Returns the months of the fact that were rebuilt.
    """
    run_ts = run_ts or utc_now()
    rebuilt = []
    if layer == "raw":
        for view, (source, columns) in staging.RAW_VIEWS.items():
            w.create_view("raw", view, columns, w.name("raw", source))
    elif layer == "stg":
        for view, (source, columns) in staging.STG_VIEWS.items():
            w.create_view("stg", view, columns, w.name("raw", source))
    elif layer == "dwh":
        run = w.properties("stg", SNAPSHOT)[VERSION]
        articles, customers = w.table("stg", "stg_articles"), w.table("stg", "stg_customers")
        bands = w.table("dwh", "seed_age_bands")
        channels = w.table("dwh", "seed_sales_channels")
        for table, rows in {
            "dim_date": marts.dim_date(w.spark).coalesce(1),
            "dim_channel": marts.dim_channel(channels),
            "dim_customer": marts.dim_customer(customers, bands),
            "dim_article": marts.dim_article(articles, _open_rows(w, run)),
        }.items():
            w.replace_table("dwh", table, rows, run_ts)
        w.create_view(
            "dwh", "dim_article_price_history", marts.PRICE_HISTORY, w.name("stg", SNAPSHOT)
        )
        rebuilt = build_fact(w, run_ts)
    else:
        raise ValueError(f"not a layer: {layer!r} (expected one of {LAYERS})")
    return rebuilt


def warehouse_tables(w: Warehouse) -> dict[str, DataFrame]:
    """The tables and views the declared checks look at."""
    names = {"raw": staging.RAW_VIEWS, "stg": staging.STG_VIEWS}
    tables = {v: w.table(layer, v) for layer, views in names.items() for v in views}
    dwh = ("dim_date", "dim_channel", "dim_customer", "dim_article",
           "dim_article_price_history", FACT)
    return {**tables, **{t: w.table("dwh", t) for t in dwh}}


class ChecksFailed(Exception):
    """Declared checks that failed, as rows of the report."""

    def __init__(self, failed: list) -> None:
        super().__init__(", ".join(f"{r.check_name}: {r.failures}" for r in failed))
        self.failed = failed


def _checked(report: DataFrame, stop_on_failure: bool) -> DataFrame:
    """The report; with stop_on_failure it is evaluated, and a failed check ends the job."""
    if stop_on_failure:
        failed = report.where("status = 'fail'").collect()
        if failed:
            raise ChecksFailed(failed)
    return report


def build(
    w: Warehouse,
    run_ts: datetime | None = None,
    seeds_dir: str | None = None,
    stop_on_failure: bool = False,
) -> DataFrame:
    """Seeds, views, snapshot and star, in dependency order; returns the check report.

    The report is about all rows of all tables. Of sales, only months loaded since they were last
    checked are read; the others' part comes from the states kept with them.
    """
    run_ts = run_ts or utc_now()
    build_seeds(w, run_ts, seeds_dir)
    build_layer(w, "raw", run_ts)
    build_layer(w, "stg", run_ts)
    build_snapshot(w, run_ts)
    build_layer(w, "dwh", run_ts)
    return _checked(check(w, run_ts), stop_on_failure)


def check(w: Warehouse, run_ts: datetime | None = None) -> DataFrame:
    """The report of all declared checks: equal to quality.report(warehouse_tables(w))."""
    _refresh_states(w, run_ts or utc_now())
    return quality.report(warehouse_tables(w), held=sales_states(w))


def build_all(
    w: Warehouse,
    data_dir: str,
    run_ts: datetime | None = None,
    seeds_dir: str | None = None,
    stop_on_failure: bool = False,
) -> DataFrame:
    """From the CSV files: convert, load everything, build; returns the check report."""
    run_ts = run_ts or utc_now()
    csv_files.convert_all(w.spark, data_dir)
    Landing(w, f"{data_dir}/parquet").load_history(run_ts)
    return build(w, run_ts, seeds_dir, stop_on_failure)


def source_freshness(w: Warehouse, run_ts: datetime | None = None) -> DataFrame:
    sources = {name: w.table("raw", name) for name in DATASETS}
    return quality.freshness(sources, run_ts or utc_now())


def run_month(
    landing: Landing,
    month: str,
    run_ts: datetime | None = None,
    seeds_dir: str | None = None,
    stop_on_failure: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The monthly job: replace both dimensions, load one month, build, then check freshness."""
    run_ts = run_ts or utc_now()
    landing.load_dimension("articles", run_ts)
    landing.load_dimension("customers", run_ts)
    landing.load_month(month, run_ts)
    report = build(landing.warehouse, run_ts, seeds_dir, stop_on_failure)
    return report, source_freshness(landing.warehouse, run_ts)


def replay_months(
    landing: Landing, months: list[str] | None = None, stop_on_failure: bool = False
) -> DataFrame:
    """Run the monthly job for each month in order, stamped with the month's first day.

    replay.replay_reports() gives the same from one pass, if the warehouse is new.

    Returns what the checks said after each month. Each report is evaluated before the next month
    changes the tables; it has one row per declared check.
    """
    spark = landing.warehouse.spark
    said, schema = [], None
    for month in sorted(months if months is not None else landing.months()):
        run_ts = datetime.combine(month_bounds(month)[0], datetime.min.time())
        report, _ = run_month(landing, month, run_ts)
        schema = T.StructType([T.StructField("month", T.StringType()), *report.schema.fields])
        rows = report.collect()
        said += [(month, *r) for r in rows]
        failed = [r for r in rows if r.status == "fail"]
        if stop_on_failure and failed:
            raise ChecksFailed(failed)
    if schema is None:
        raise ValueError("there is no month to replay")
    return spark.createDataFrame(said, schema)


def replay_history(landing: Landing, run_ts: datetime | None = None) -> DataFrame:
    """The result of `replay_months` over a new warehouse, from one pass over the transactions."""
    w, run_ts = landing.warehouse, run_ts or utc_now()
    landing.load_history(run_ts)
    build_seeds(w, run_ts)
    build_layer(w, "raw", run_ts)
    build_layer(w, "stg", run_ts)
    build_snapshot_history(w)
    build_layer(w, "dwh", run_ts)
    return check(w, run_ts)
