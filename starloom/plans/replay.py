"""What the checks said after each monthly job of a replay, from one pass.

Between two jobs of a replay three things change: sales are added month by month, article prices get new
versions, and with them the articles' current prices. The failures a month adds, or takes back, are
counted as events; their running sum over the months is the report after each of them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import month_label, surrogate_key
from starloom.operators import quality
from starloom.plans import build
from starloom.schemas import VALID_FROM, VALID_TO
from starloom.sinks.landing import Landing, loaded_months
from starloom.sinks.warehouse import Warehouse

# The tables that follow the price versions.
_PRICED = ("dim_article", "dim_article_price_history")


def _check(table: str, kind: str, column: str) -> quality.Check:
    return next(c for c in quality.SUITE if (c.table, c.kind, c.column) == (table, kind, column))


def _event(rows: DataFrame, check: quality.Check, month: Column, change: Column) -> DataFrame:
    return rows.select(
        month.alias("month"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        change.cast("long").alias("change"),
    )


def _price_events(versions: DataFrame, articles: DataFrame, first: str) -> DataFrame:
    """Events of the checks on articles and price versions.

    A version exists from its first month on and is current until its last one begins. Articles have
    few versions, and those of one article meet in a window.
    """
    began, ended = month_label(VALID_FROM), month_label(VALID_TO)
    sold = versions.where(F.col("article_id").isNotNull())
    steps = F.explode(F.array(F.struct(began.alias("month"), F.lit(1).alias("step")),
                              F.struct(ended.alias("month"), F.lit(-1).alias("step")))).alias("s")

    # articles of several current versions, from and up to when
    changes = sold.select("article_id", steps).where("s.month is not null")
    changes = changes.groupBy("article_id", F.col("s.month").alias("month")).agg(F.sum("s.step").alias("step"))
    article = Window.partitionBy("article_id").orderBy("month")
    changes = changes.withColumn("now", F.sum("step").over(article))
    several = changes.withColumn("change", (F.col("now") > 1).cast("int") - (F.col("now") - F.col("step") > 1).cast("int"))
    several = several.where("change <> 0")
    found = _event(
        several, _check("dim_article_price_history", "unique", "article_id"), F.col("month"), F.col("change")
    )

    # an article is one row for each of its rows in the file and each current version; of files with many empty columns
    # Spark takes one column for next to nothing and would bring all articles to the driver, so the joins ask for a merge
    counted = articles.groupBy("article_id").agg(F.count(F.lit(1)).alias("n")).hint("merge")
    unique = _check("dim_article", "unique", "article_sk")
    found = found.unionByName(_event(counted.where("n > 1"), unique, F.lit(first), F.lit(1)))
    single = several.join(counted.where("n = 1"), "article_id")
    found = found.unionByName(_event(single, unique, F.col("month"), F.col("change")))
    price = _check("dim_article", "between", "current_price")
    failing = sold.withColumn("current_price", F.col("median_price")).where(quality.fails(price))
    failing = failing.select("article_id", steps).where("s.month is not null").join(counted, "article_id")
    found = found.unionByName(_event(failing, price, F.col("s.month"), F.col("s.step") * F.col("n")))

    # versions whose key another one has had before
    keyed = versions.select(surrogate_key("article_id", VALID_FROM).alias("sk"), began.alias("month"))
    missing = _check("dim_article_price_history", "not_null", "price_version_sk")
    found = found.unionByName(_event(keyed.where("sk is null"), missing, F.col("month"), F.lit(1)))
    same = keyed.where("sk is not null").groupBy("sk", "month").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("sk").orderBy("month"))
    twice = same.withColumn("now", so_far).where("now > 1 and now - n < 2")
    return found.unionByName(
        _event(twice, _check("dim_article_price_history", "unique", "price_version_sk"), F.col("month"), F.lit(1))
    )


def monthly_reports(w: Warehouse) -> DataFrame:
    """month, check_name, table_name, failures and status after each month's job of a finished replay."""
    months = sorted(loaded_months(w))
    tables = build.warehouse_tables(w)
    sales = build.sales_states(w)
    moving = [c for c in quality.SUITE if c.table in sales or c.table in _PRICED]
    steady = quality.report(tables, [c for c in quality.SUITE if c not in moving]).drop("status")
    every = F.explode(F.array(*[F.lit(m) for m in months])).alias("month")

    events = _price_events(w.table("stg", build.SNAPSHOT), tables["stg_articles"], months[0])
    for table, held in sales.items():
        own = quality.state_failures(held, table, tables, "sale_month")
        events = events.unionByName(
            own.select(month_label("sale_month").alias("month"), "check_name", "table_name",
                       F.col("failures").alias("change"))
        )
    changes = events.groupBy("month", "check_name", "table_name").agg(F.sum("change").alias("change"))
    names = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name")) for c in moving])
    asked = w.spark.range(0, 1, 1, 1).select(F.inline(names)).select("*", every)
    until = Window.partitionBy("check_name").orderBy("month")
    summed = asked.join(changes, ["month", "check_name", "table_name"], "left").select(
        "month", "check_name", "table_name",
        F.sum(F.coalesce("change", F.lit(0))).over(until).alias("failures"),
    )
    return quality.with_status(summed.unionByName(steady.select("*", every)))


def replay_reports(landing: Landing, run_ts: datetime | None = None) -> DataFrame:
    """What build.replay_months leaves and returns, over a new warehouse, from one pass over the sales."""
    build.replay_history(landing, run_ts)
    return monthly_reports(landing.warehouse)
