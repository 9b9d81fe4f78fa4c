"""Exact interpolated median per group, and the monthly price medians built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import month_start

# A group of up to this many values is ranked by one task, which sorts and spills them.
# Larger groups are cut into runs of values that many tasks share.
MAX_GROUP_VALUES = 10_000_000
# Hashes of the first key, which tell whether groups can be larger.
BUCKETS = 1 << 16


def exact_median(
    rows: DataFrame,
    keys: list[str],
    value: str,
    alias: str,
    folder: str,
    max_group_values: int = MAX_GROUP_VALUES,
    written: bool = False,
) -> DataFrame:
    """Median of `value` per `keys`; nulls do not count, and a group of nulls has a null median.

    The rows are written to `folder`, a new folder on shared storage that must outlive the result,
    unless they are `written` already, so that reading them twice costs no more than a scan. Counts by a hash
    of the first key, a few numbers from each task, tell which groups can be large. All others are moved
    once and ranked, dealt out by the first key to as many tasks as the session's setting for shuffles
    says; what asks by that key afterwards, such as an article's last month, moves nothing again.
    Rows under a crowded hash are counted by value and written; sizes and ranks come from there, and
    each of their groups is ranked by the method its own size asks for.
    """
    rows = rows.select(*keys, value)
    if not written:
        rows = _written(rows, f"{folder}/values")
    bucket = F.pmod(F.xxhash64(keys[0]), F.lit(BUCKETS))
    crowded = _written(
        rows.groupBy(bucket.alias("__bucket"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > max_group_values)
        .select("__bucket"),
        f"{folder}/crowded",
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if crowded.isEmpty():
        return _median_of_rows(rows.repartition(n, keys[0]), keys, value, alias)

    def matching(how: str) -> DataFrame:
        return rows.withColumn("__bucket", bucket).join(F.broadcast(crowded), "__bucket", how).drop("__bucket")

    usual = _median_of_rows(matching("left_anti").repartition(n, keys[0]), keys, value, alias)
    return usual.unionByName(
        _median_of_crowded(matching("left_semi"), keys, value, alias, folder, max_group_values)
    )


def _median_of_rows(rows: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    return _median_by_group(rows.withColumn("__weight", F.lit(1)), keys, value, alias)


def _median_of_crowded(
    rows: DataFrame, keys: list[str], value: str, alias: str, folder: str, max_group_values: int
) -> DataFrame:
    """The rows are read once, to count each distinct value of a group."""
    weights = _written(_weights(rows, keys, value), f"{folder}/weights")
    large = _written(
        weights.groupBy(*keys)
        .agg(F.count(value).alias("__values"))
        .where(F.col("__values") > max_group_values)
        .select(*keys),
        f"{folder}/large",
    )

    def matching(how: str) -> DataFrame:
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
        return weights.alias("r").join(large.alias("g"), same, how)

    usual = _median_by_group(matching("left_anti"), keys, value, alias)
    return usual.unionByName(_median_by_rank(matching("left_semi"), keys, value, alias))


def _written(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _weights(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each distinct value of a group with its count. Repeats collapse before the shuffle."""
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__weight"))


def _median_by_group(weights: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Rank a group's distinct values by their running counts and keep the middle one or two.

    Sorting a few counted values stays in generated code and is faster than the built-in median,
    which builds a map object per group.
    """
    group = Window.partitionBy(*keys)
    up_to = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.when(F.col(value).isNull(), 0).otherwise(F.col("__weight"))
    middle = (
        weights.withColumn("__weight", weight)
        .withColumn("__to", F.sum("__weight").over(up_to))
        .withColumn("__n", F.sum("__weight").over(group))
        .where(
            "__n = 0 or (__weight > 0 and __to > shiftright(__n - 1, 1)"
            " and __to - __weight <= shiftright(__n, 1))"
        )
    )
    return middle.groupBy(*keys).agg((F.min(value) * 0.5 + F.max(value) * 0.5).alias(alias))


def _median_by_rank(weights: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """The same median with every group spread over many tasks; groups of nulls are left out.

    1. Range-partition the counted values on (group, value) and sum the counts per group and
       partition. This cuts each group into runs of consecutive values with known ends and weights.
    2. Running totals over those few runs tell which one or two hold the middle ranks.
    3. Only the values inside those runs are ranked one by one.

    Each group has over MAX_GROUP_VALUES values and at most two runs to rank, so the list of runs
    that is broadcast has at most two rows for so many counted values.
    """
    counted = weights.where(F.col(value).isNotNull())

    runs = (
        counted.repartitionByRange(*keys, value)
        .withColumn("__part", F.spark_partition_id())
        .groupBy(*keys, "__part")
        .agg(
            F.min(value).alias("__low"),
            F.max(value).alias("__high"),
            F.sum("__weight").alias("__in_run"),
        )
    )
    group = Window.partitionBy(*keys)
    up_to = group.orderBy("__low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.sum("__in_run").over(group)
    targets = (
        runs.withColumn("__end", F.sum("__in_run").over(up_to))
        .withColumn("__start", F.col("__end") - F.col("__in_run"))
        .withColumn("__rank_low", F.shiftright(n - 1, 1))
        .withColumn("__rank_high", F.shiftright(n, 1))
        .where("__start <= __rank_high and __end > __rank_low")
        .select(*keys, "__low", "__high", "__start", "__rank_low", "__rank_high")
    )

    in_run = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    in_run.append(F.col(f"r.{value}").between(F.col("g.__low"), F.col("g.__high")))
    run = Window.partitionBy(*keys, "__low").orderBy(value)
    ranked = (
        counted.alias("r")
        .join(F.broadcast(targets.alias("g")), in_run)
        .select("r.*", "g.__low", "g.__start", "g.__rank_low", "g.__rank_high")
        .withColumn("__to", F.col("__start") + F.sum("__weight").over(
            run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("__from", F.col("__to") - F.col("__weight"))
    )

    def value_at(rank: str) -> Column:
        holds = (F.col("__from") <= F.col(rank)) & (F.col(rank) < F.col("__to"))
        return F.max(F.when(holds, F.col(value)))

    return ranked.groupBy(*keys).agg(
        (value_at("__rank_low") * 0.5 + value_at("__rank_high") * 0.5).alias(alias)
    )


def monthly_median_price(raw_transactions: DataFrame, folder: str, written: bool = False) -> DataFrame:
    """Median landing price per article and calendar month; `folder` and `written` as in exact_median."""
    by_month = raw_transactions.select(
        "article_id", month_start("t_dat").alias("price_month"), "price"
    )
    return exact_median(
        by_month, ["article_id", "price_month"], "price", "median_price", folder, written=written
    )


def latest_price(monthly: DataFrame) -> DataFrame:
    """Each article's last month and its median.

    max and max_by combine before the shuffle, so an article's months never meet as rows. A row
    without a month counts only for an article that has no other.
    """
    undated = F.max(F.when(F.col("price_month").isNull(), F.col("median_price")))
    last_month = F.max("price_month")
    return monthly.groupBy("article_id").agg(
        last_month.alias("price_month"),
        F.when(last_month.isNull(), undated)
        .otherwise(F.max_by("median_price", "price_month"))
        .alias("median_price"),
    )
