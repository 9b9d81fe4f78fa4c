"""One query per operator, each over the whole order tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_checks import adapter
from starloom.functions import date_attributes, in_month, surrogate_key
from starloom.operators import marts, median, quality, snapshot, staging
from starloom.plans import build, replay
from starloom.schemas import CUSTOMERS, DATASETS
from starloom.sinks.landing import LOAD_MONTH, Landing, list_months
from starloom.sinks.warehouse import CODEC, LAYERS, Warehouse
from starloom.sources import csv_files, seeds

MONTH = "2021-05"
NEXT_MONTH = "2021-06"
RUN = datetime(2019, 3, 1, 12, 0, 0)
LATER = datetime(2019, 4, 1, 12, 0, 0)
# The snapshot's first run sees the sales before this day, its second run all of them.
CUT = "2022-01-01"


# -- inputs --------------------------------------------------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A new folder on storage that driver and executors share.

    That is the folder the session names for checkpoints, or else its warehouse folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/retail-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written to a new folder and read back."""
    folder = scratch(rows.sparkSession)
    rows.write.option("compression", CODEC).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def taken_from(warehouse: Warehouse, rows: DataFrame) -> DataFrame:
    """The rows as they are now, after which the databases of the temporary warehouse go."""
    kept = stored(rows)
    for layer in LAYERS:
        warehouse.spark.sql(f"DROP DATABASE IF EXISTS {warehouse.database(layer)} CASCADE")
    return kept


_written: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Result of `make`, kept for the life of the session so that queries share written input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def inputs(spark: SparkSession, sf_dir: str, price: str | None = None) -> dict[str, DataFrame]:
    return {
        "transactions": adapter.transactions(spark, sf_dir, price),
        "articles": adapter.articles(spark, sf_dir),
        "customers": adapter.customers(spark, sf_dir),
    }


def parquet_dir(spark: SparkSession, sf_dir: str, price: str | None = None) -> str:
    """The three landing files, written once per session."""

    def write() -> str:
        folder = scratch(spark)
        for name, rows in inputs(spark, sf_dir, price).items():
            rows.write.option("compression", CODEC).parquet(f"{folder}/{DATASETS[name].file_name}.parquet")
        return folder

    return _once(spark, sf_dir, f"parquet-{price}", write)


def csv_dir(spark: SparkSession, sf_dir: str) -> str:
    """A new data folder with the three files as CSV below `raw/`."""
    folder = scratch(spark)
    for name, rows in inputs(spark, sf_dir).items():
        (
            rows.write.option("header", True)
            .option("escape", '"')
            .csv(f"{folder}/raw/{DATASETS[name].file_name}.csv")
        )
    return folder


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch(spark), prefix=f"q{uuid.uuid4().hex[:12]}_")


def landing(spark: SparkSession, sf_dir: str, price: str | None = None) -> Landing:
    """A loader into a new, empty warehouse."""
    return Landing(new_warehouse(spark), parquet_dir(spark, sf_dir, price))


class Changed(Landing):
    """A loader of the files of another one, a changed form of one of them; the files are not written again."""

    def __init__(self, loader: Landing, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        super().__init__(loader.warehouse, loader.parquet_dir)
        self._name, self._change = name, change

    def source(self, name: str) -> DataFrame:
        rows = super().source(name)
        return self._change(rows) if name == self._name else rows


def built(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with everything converted, loaded and built; queries only read it."""

    def make() -> Warehouse:
        w = new_warehouse(spark)
        build.build_all(w, csv_dir(spark, sf_dir), RUN)
        return w

    return _once(spark, sf_dir, "built", make)


def raw_transactions(spark, sf_dir, **kwargs) -> DataFrame:
    return staging.raw_transactions(
        adapter.landed(adapter.transactions(spark, sf_dir, **kwargs))
    )


def raw_articles(spark, sf_dir) -> DataFrame:
    return staging.raw_articles(adapter.landed(adapter.articles(spark, sf_dir)))


def raw_customers(spark, sf_dir) -> DataFrame:
    return staging.raw_customers(adapter.landed(adapter.customers(spark, sf_dir)))


def stg_transactions(spark, sf_dir, **kwargs) -> DataFrame:
    return staging.stg_transactions(raw_transactions(spark, sf_dir, **kwargs))


def stg_articles(spark, sf_dir) -> DataFrame:
    return staging.stg_articles(raw_articles(spark, sf_dir))


def stg_customers(spark, sf_dir) -> DataFrame:
    return staging.stg_customers(raw_customers(spark, sf_dir))


# -- sources and sinks ---------------------------------------------------------------------------


def csv_typed_scan(spark, sf_dir):
    """Declared columns by their contract, the others by their values."""
    folder = scratch(spark)
    adapter.customers(spark, sf_dir, adapter.UNDECLARED_COLUMNS).write.option("header", True).csv(f"{folder}/customers.csv")
    return csv_files.read_csv(spark, f"{folder}/customers.csv", CUSTOMERS)


def csv_to_parquet(spark, sf_dir):
    """Converts over what a dead run left: part files without a mark of success."""
    folder = csv_dir(spark, sf_dir)
    for d in DATASETS.values():
        target = f"{folder}/parquet/{d.file_name}.parquet"
        spark.range(3).write.option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
        ).parquet(target)
    csv_files.convert_all(spark, folder)
    articles = spark.read.parquet(f"{folder}/parquet/articles.parquet")
    sold = spark.read.parquet(f"{folder}/parquet/transactions_train.parquet")
    lines = sold.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return articles.select("article_id", "prod_name", "detail_desc").join(
        lines, "article_id", "left"
    )


def load_dimension(spark, sf_dir):
    loader = landing(spark, sf_dir)
    loader.load_dimension("customers", RUN)
    return taken_from(loader.warehouse, loader.warehouse.table("raw", "customers"))


def _loaded(loader: Landing) -> DataFrame:
    return taken_from(loader.warehouse, loader.warehouse.table("raw", "transactions"))


def load_month(spark, sf_dir):
    loader = landing(spark, sf_dir)
    loader.load_month(MONTH, RUN)
    return _loaded(loader)


def load_month_rerun(spark, sf_dir):
    """All months with rounded prices, then one of them again with the exact ones."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    loader.load_months(RUN)
    Landing(loader.warehouse, parquet_dir(spark, sf_dir)).load_month(MONTH, LATER)
    return _loaded(loader)


def load_history(spark, sf_dir):
    loader = landing(spark, sf_dir)
    loader.load_history(RUN)
    return _loaded(loader)


def failed_load_keeps_month(spark, sf_dir):
    """A load that fails on its prices leaves every month as it was."""
    loader = landing(spark, sf_dir)
    loader.load_months(RUN)
    folder = scratch(spark)
    sales = adapter.transactions(spark, sf_dir, "concat('price ', l_extendedprice) as price")
    sales.write.parquet(f"{folder}/{DATASETS['transactions'].file_name}.parquet")
    try:
        Landing(loader.warehouse, folder).load_month(MONTH, LATER)
    except PySparkException:
        return _loaded(loader)
    raise AssertionError("prices that are no numbers were loaded")


def dimension_allow_list(spark, sf_dir):
    """Every input file offered as a dimension, with its rows or null where it is refused."""
    loader = landing(spark, sf_dir)
    rows = []
    for name in DATASETS:
        try:
            rows.append((name, loader.load_dimension(name, RUN)))
        except ValueError:
            rows.append((name, None))
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {loader.warehouse.database(layer)} CASCADE")
    return spark.createDataFrame(rows, "name string, n_rows long")


def one_layer(spark, sf_dir):
    """The raw and then the staging layer alone; customers as the staging view shows them."""
    loader = landing(spark, sf_dir)
    loader.load_history(RUN)
    build.build_layer(loader.warehouse, "raw", RUN)
    build.build_layer(loader.warehouse, "stg", RUN)
    return taken_from(loader.warehouse, loader.warehouse.table("stg", "stg_customers"))


def load_log(spark, sf_dir):
    loader = landing(spark, sf_dir)
    loader.load_history(RUN)
    loader.load_month(MONTH, LATER)
    return taken_from(loader.warehouse, loader.warehouse.table("raw", "load_log"))


def month_row_count(spark, sf_dir):
    loaded = built(spark, sf_dir).table("raw", "transactions")
    return loaded.groupBy(F.col(LOAD_MONTH).alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def all_months(spark, sf_dir):
    return list_months(adapter.transactions(spark, sf_dir))


def seed_age_bands(spark, sf_dir):
    """Every band with its number of customers."""
    customers = marts.dim_customer(stg_customers(spark, sf_dir), seeds.age_bands(spark))
    counts = customers.groupBy("age_band").agg(F.count(F.lit(1)).alias("n_customers"))
    bands = seeds.age_bands(spark)
    return bands.join(counts, bands.band_name == counts.age_band, "left").drop("age_band")


def seeds_from_csv(spark, sf_dir):
    """The build with bands and channels from CSV files; customers and sales by them."""
    folder = csv_dir(spark, sf_dir)
    for name, rows in {
        "seed_age_bands": seeds.age_bands(spark),
        "seed_sales_channels": seeds.sales_channels(spark),
    }.items():
        rows.coalesce(1).write.option("header", True).csv(f"{folder}/seeds/{name}.csv")
    w = new_warehouse(spark)
    build.build_seeds(w, RUN, f"{folder}/seeds")
    customers = marts.dim_customer(stg_customers(spark, sf_dir), w.table("dwh", "seed_age_bands"))
    counts = customers.groupBy("age_band").agg(F.count(F.lit(1)).alias("n_customers"))
    return taken_from(w, counts.crossJoin(
        w.table("dwh", "seed_sales_channels").agg(F.count(F.lit(1)).alias("n_channels"))
    ))


def seed_channels(spark, sf_dir):
    """Every channel with its number of sales."""
    counts = (
        stg_transactions(spark, sf_dir)
        .groupBy("sales_channel_id")
        .agg(F.count(F.lit(1)).alias("n_sales"))
    )
    return seeds.sales_channels(spark).join(counts, "sales_channel_id", "left")


def fct_sales_rebuild_month(spark, sf_dir):
    """A fact from rounded prices in which one month was rebuilt from the exact ones."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    w = loader.warehouse
    loader.load_months(RUN)
    build.build_fact(w, RUN)
    Landing(w, parquet_dir(spark, sf_dir)).load_months(LATER)
    build.build_fact(w, LATER, month=MONTH)
    return taken_from(w, w.table("dwh", build.FACT))


# -- keys and calendar ---------------------------------------------------------------------------


def surrogate_key_single(spark, sf_dir):
    customers = stg_customers(spark, sf_dir)
    return customers.select(
        "customer_id",
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("fashion_news_frequency").alias("nullable_sk"),
    )


def surrogate_key_multi(spark, sf_dir):
    customers = raw_customers(spark, sf_dir)
    return customers.select(
        "customer_id",
        surrogate_key("customer_id", "age", "fashion_news_frequency", "ingestion_ts").alias("sk"),
    )


def _sales_per_day(spark, sf_dir) -> DataFrame:
    return (
        stg_transactions(spark, sf_dir)
        .groupBy(F.col("sale_date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("n_sales"))
    )


def date_spine(spark, sf_dir):
    """Days of the calendar without a sale."""
    days = marts.dim_date(spark).select("date_day")
    return days.join(_sales_per_day(spark, sf_dir), "date_day", "left_anti")


def date_attributes_query(spark, sf_dir):
    return stg_transactions(spark, sf_dir).select(
        "customer_id", "article_id", "sale_date", *date_attributes("sale_date")
    )


def dim_date(spark, sf_dir):
    """The calendar with the number of sales per day, days without sales included."""
    return (
        marts.dim_date(spark)
        .join(_sales_per_day(spark, sf_dir), "date_day", "left")
        .withColumn("n_sales", F.coalesce("n_sales", F.lit(0)))
    )


# -- prices and their history --------------------------------------------------------------------


def monthly(spark, sf_dir, price=None):
    return median.monthly_median_price(raw_transactions(spark, sf_dir, price=price), scratch(spark))


def monthly_median_price(spark, sf_dir):
    return monthly(spark, sf_dir)


def median_by_rank(spark, sf_dir):
    """Median price per channel, with each group spread over many tasks."""
    return median.exact_median(
        raw_transactions(spark, sf_dir), ["sales_channel_id"], "price", "median_price",
        scratch(spark), max_group_values=1000,
    )


def latest_median_price(spark, sf_dir):
    return median.latest_price(monthly_median_price(spark, sf_dir))


def snapshot_first_run(spark, sf_dir):
    return snapshot.snapshot_check(
        None, latest_median_price(spark, sf_dir), "article_id", ["median_price"], RUN
    )


def snapshot_one_change(spark, sf_dir):
    """Two runs over rounded prices: the second sees the sales since the first."""
    checked = ("article_id", ["median_price"])
    prices = stored(monthly(spark, sf_dir, adapter.REPEATED_PRICE))
    before = prices.where(F.col("price_month") < F.lit(CUT).cast("date"))
    first = snapshot.snapshot_check(None, median.latest_price(before), *checked, RUN)
    return snapshot.snapshot_check(first, median.latest_price(prices), *checked, LATER)


def snapshot_vanished_key(spark, sf_dir):
    """A second run whose source lacks every seventh article; their rows stay open."""
    checked = ("article_id", ["median_price"])
    prices = stored(monthly(spark, sf_dir, adapter.REPEATED_PRICE))
    first = snapshot.snapshot_check(None, median.latest_price(prices), *checked, RUN)
    left = prices.where("cast(article_id as int) % 7 <> 0").where(
        F.col("price_month") < F.lit(CUT).cast("date")
    )
    return snapshot.snapshot_check(first, median.latest_price(left), *checked, LATER)


def snapshot_replay(spark, sf_dir):
    return snapshot.replay(monthly(spark, sf_dir, adapter.REPEATED_PRICE))


def price_history(spark, sf_dir):
    return marts.dim_article_price_history(snapshot_replay(spark, sf_dir))


def current_price(spark, sf_dir):
    return marts.current_price(snapshot_replay(spark, sf_dir))


# -- star ----------------------------------------------------------------------------------------


def fct_sales(spark, sf_dir):
    return marts.fct_sales(stg_transactions(spark, sf_dir))


def fct_sales_month(spark, sf_dir):
    return marts.fct_sales(stg_transactions(spark, sf_dir), MONTH)


def dim_channel(spark, sf_dir):
    """The channel dimension with the sales of each channel."""
    channels = marts.dim_channel(seeds.sales_channels(spark))
    totals = (
        fct_sales(spark, sf_dir)
        .groupBy("channel_sk")
        .agg(F.sum("quantity").alias("quantity"), F.sum("sales_amount").alias("sales_amount"))
    )
    return channels.join(totals, "channel_sk", "left")


def dim_customer(spark, sf_dir):
    return marts.dim_customer(stg_customers(spark, sf_dir), seeds.age_bands(spark))


def dim_article(spark, sf_dir):
    return marts.dim_article(stg_articles(spark, sf_dir), snapshot_first_run(spark, sf_dir))


def article_price_versions(spark, sf_dir):
    articles = marts.dim_article(stg_articles(spark, sf_dir), snapshot_first_run(spark, sf_dir))
    return marts.article_price_versions(articles, price_history(spark, sf_dir))


def star_sales(spark, sf_dir):
    return marts.star_sales_by_month_band_channel(
        fct_sales(spark, sf_dir),
        marts.dim_date(spark),
        dim_customer(spark, sf_dir),
        marts.dim_channel(seeds.sales_channels(spark)),
    )


def sales_between(spark, sf_dir):
    """Sales of half a year from the built fact, reading only its months."""
    start, end = date(2021, 3, 15), date(2021, 9, 10)
    return marts.sales_between(built(spark, sf_dir).table("dwh", build.FACT), start, end)


# -- quality -------------------------------------------------------------------------------------


def dq_not_null(spark, sf_dir):
    return quality.not_null(stg_customers(spark, sf_dir), "fashion_news_frequency")


def dq_unique(spark, sf_dir):
    return quality.unique(stg_transactions(spark, sf_dir), "customer_id")


def dq_unique_passing(spark, sf_dir):
    return quality.unique(stg_customers(spark, sf_dir), "customer_id")


def dq_unique_where(spark, sf_dir):
    closed = price_history(spark, sf_dir).where("not is_current")
    return quality.unique(closed, "article_id")


def dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(
        stg_transactions(spark, sf_dir),
        ["sale_date", "customer_id", "article_id", "sales_channel_id"],
    )


def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(
        stg_customers(spark, sf_dir), "fashion_news_frequency", ["NONE", "Regularly"]
    )


def dq_between_strict(spark, sf_dir):
    rounded = stg_transactions(spark, sf_dir, price=adapter.REPEATED_PRICE)
    return quality.between(rounded, "price", minimum=0, strictly=True)


def dq_between_inclusive(spark, sf_dir):
    return quality.between(fct_sales(spark, sf_dir), "quantity", minimum=2)


def dq_relationships_article(spark, sf_dir):
    return quality.relationships(
        stg_transactions(spark, sf_dir), "article_id", stg_articles(spark, sf_dir), "article_id"
    )


def dq_relationships_customer(spark, sf_dir):
    return quality.relationships(
        fct_sales(spark, sf_dir), "customer_sk", dim_customer(spark, sf_dir), "customer_sk"
    )


def dq_relationships_unsold(spark, sf_dir):
    return quality.relationships(
        stg_articles(spark, sf_dir), "article_id", fct_sales(spark, sf_dir), "article_id"
    )


def dq_relationships_date(spark, sf_dir):
    """A calendar that ends in 2023 lacks the days of later sales."""
    calendar = marts.dim_date(spark, end=date(2024, 1, 1))
    return quality.relationships(fct_sales(spark, sf_dir), "sale_date", calendar, "date_day")


def dq_report(spark, sf_dir):
    return quality.report(build.warehouse_tables(built(spark, sf_dir)))


def source_freshness(spark, sf_dir):
    sales = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderdate").alias("ingestion_ts")
    )
    sources = {
        "transactions": sales,
        "articles": adapter.landed(adapter.articles(spark, sf_dir)),
        "empty": sales.where("ingestion_ts > timestamp_ntz'2100-01-01 00:00:00'"),
    }
    return quality.freshness(sources, RUN)


# -- jobs ----------------------------------------------------------------------------------------


def build_all(spark, sf_dir):
    """From CSV files to the star by the whole job, then a question to the star."""
    w = built(spark, sf_dir)
    return marts.star_sales_by_month_band_channel(
        w.table("dwh", "fct_sales"),
        w.table("dwh", "dim_date"),
        w.table("dwh", "dim_customer"),
        w.table("dwh", "dim_channel"),
    )


def run_month(spark, sf_dir):
    """The monthly job in a new warehouse; the price history it leaves."""
    loader = landing(spark, sf_dir)
    build.run_month(loader, MONTH, RUN)
    return taken_from(
        loader.warehouse, loader.warehouse.table("dwh", "dim_article_price_history")
    )


def run_month_twice(spark, sf_dir):
    """Two monthly jobs in a row; open and closed price versions after the second."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    build.run_month(loader, MONTH, RUN)
    build.run_month(loader, NEXT_MONTH, LATER)
    return taken_from(
        loader.warehouse, loader.warehouse.table("dwh", "dim_article_price_history")
    )


def run_month_out_of_order(spark, sf_dir):
    """Every month replayed but one; then the job of that month. The price history."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    w = loader.warehouse
    build.replay_history(Changed(loader, "transactions", lambda rows: rows.where(~in_month("t_dat", MONTH))), RUN)
    build.run_month(loader, MONTH, datetime(2021, 5, 1))
    return taken_from(w, w.table("dwh", "dim_article_price_history"))


def lacking_customers(loader: Landing) -> Landing:
    """The same files, but for customers, which lack some that bought."""
    return Changed(loader, "customers", lambda rows: rows.where("cast(customer_id as int) % 50 <> 7"))


def run_month_reports(spark, sf_dir):
    """Two monthly jobs, the second one's customers lacking some that bought: both reports."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    first, _ = build.run_month(loader, MONTH, RUN)
    first = stored(first)
    second, _ = build.run_month(lacking_customers(loader), NEXT_MONTH, LATER)
    both = first.select(F.lit(MONTH).alias("month"), "*").unionByName(
        second.select(F.lit(NEXT_MONTH).alias("month"), "*")
    )
    return taken_from(loader.warehouse, both)


def replay_months(spark, sf_dir):
    """The monthly job for every month, in one pass; what the checks say after each."""
    loader = lacking_customers(landing(spark, sf_dir, adapter.REPEATED_PRICE))
    return taken_from(loader.warehouse, replay.replay_reports(loader, RUN))


def replay_history(spark, sf_dir):
    """All months loaded and replayed; every article with its open price."""
    loader = landing(spark, sf_dir, adapter.REPEATED_PRICE)
    build.replay_history(loader, RUN)
    return taken_from(
        loader.warehouse,
        loader.warehouse.table("dwh", "dim_article").select(
            "article_sk", "article_id", "product_name", "current_price"
        ),
    )


def month_filter(spark, sf_dir):
    return raw_transactions(spark, sf_dir).where(in_month("t_dat", MONTH))


def stg_transactions_long_price(spark, sf_dir):
    """Prices of more decimals than the cleaned layer keeps."""
    return stg_transactions(spark, sf_dir, price=adapter.LONG_PRICE)


QUERIES = {
    "csv_typed_scan": csv_typed_scan,
    "csv_to_parquet": csv_to_parquet,
    "load_dimension": load_dimension,
    "load_month": load_month,
    "load_month_rerun": load_month_rerun,
    "load_history": load_history,
    "failed_load_keeps_month": failed_load_keeps_month,
    "dimension_allow_list": dimension_allow_list,
    "one_layer": one_layer,
    "load_log": load_log,
    "month_row_count": month_row_count,
    "list_months": all_months,
    "seed_age_bands": seed_age_bands,
    "seed_channels": seed_channels,
    "seeds_from_csv": seeds_from_csv,
    "fct_sales_rebuild_month": fct_sales_rebuild_month,
    "raw_articles": raw_articles,
    "raw_transactions": raw_transactions,
    "raw_customers": raw_customers,
    "stg_articles": stg_articles,
    "stg_transactions": stg_transactions,
    "stg_customers": stg_customers,
    "stg_transactions_long_price": stg_transactions_long_price,
    "month_filter": month_filter,
    "surrogate_key_single": surrogate_key_single,
    "surrogate_key_multi": surrogate_key_multi,
    "date_spine": date_spine,
    "date_attributes": date_attributes_query,
    "monthly_median_price": monthly_median_price,
    "median_by_rank": median_by_rank,
    "latest_median_price": latest_median_price,
    "snapshot_first_run": snapshot_first_run,
    "snapshot_one_change": snapshot_one_change,
    "snapshot_vanished_key": snapshot_vanished_key,
    "snapshot_replay": snapshot_replay,
    "current_price": current_price,
    "dim_date": dim_date,
    "dim_channel": dim_channel,
    "dim_customer": dim_customer,
    "dim_article": dim_article,
    "dim_article_price_history": price_history,
    "fct_sales": fct_sales,
    "fct_sales_month": fct_sales_month,
    "sales_between": sales_between,
    "article_price_versions": article_price_versions,
    "star_sales_by_month_band_channel": star_sales,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_passing": dq_unique_passing,
    "dq_unique_where": dq_unique_where,
    "dq_unique_combination": dq_unique_combination,
    "dq_accepted_values": dq_accepted_values,
    "dq_between_strict": dq_between_strict,
    "dq_between_inclusive": dq_between_inclusive,
    "dq_relationships_article": dq_relationships_article,
    "dq_relationships_customer": dq_relationships_customer,
    "dq_relationships_unsold": dq_relationships_unsold,
    "dq_relationships_date": dq_relationships_date,
    "dq_report": dq_report,
    "source_freshness": source_freshness,
    "build_all": build_all,
    "run_month": run_month,
    "run_month_twice": run_month_twice,
    "run_month_out_of_order": run_month_out_of_order,
    "run_month_reports": run_month_reports,
    "replay_months": replay_months,
    "replay_history": replay_history,
}
