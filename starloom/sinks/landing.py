"""Loads of the landing tables: dimensions whole, transactions by month, every attempt logged."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import (
    in_month,
    known_rows,
    month_bounds,
    month_label,
    month_start,
    timestamp,
    utc_now,
)
from starloom.schemas import (
    DATASETS,
    DIMENSIONS,
    INGESTION_TS,
    LOAD_LOG,
    TRANSACTIONS,
    dimension,
)
from starloom.sinks.warehouse import State, Warehouse, write_partitioned

LOAD_MONTH = "load_month"
_LOADED = "starloom.loaded."
_LANDED = T.StructType(
    TRANSACTIONS.fields + [T.StructField(INGESTION_TS, T.TimestampNTZType())]
)


def list_months(transactions: DataFrame) -> DataFrame:
    """Months with at least one dated row, in order."""
    months = transactions.where(F.col("t_dat").isNotNull()).select(
        month_start("t_dat").alias("first_day")
    )
    return (
        months.distinct().select(month_label("first_day").alias("month")).orderBy("month")
    )


def loaded_months(w: Warehouse) -> dict[str, str]:
    """Each month in the landing table, with the load run its rows come from."""
    state = w.state("raw", "transactions")
    months = sorted(spec.split("=", 1)[1] for spec in state.partitions)
    return {month: state.notes[_LOADED + month] for month in months}


class Landing:
    """Loads Parquet files from `parquet_dir` into the raw layer of a warehouse.

    `run_ts` is the UTC time stamped on rows and log entries; it is read once per load.
    """

    def __init__(self, warehouse: Warehouse, parquet_dir: str) -> None:
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.parquet_dir = parquet_dir.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.parquet_dir}/{DATASETS[name].file_name}.parquet")

    def _transactions(self) -> DataFrame:
        return self.source("transactions").select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS]
        )

    def load_dimension(self, name: str, run_ts: datetime | None = None) -> int:
        """Replace a dimension with its file, all columns kept; returns the row count."""
        dimension(name)
        run_ts = run_ts or utc_now()
        try:
            rows = self.source(name).withColumn(INGESTION_TS, timestamp(run_ts))
            self.warehouse.replace_table("raw", name, rows, run_ts)
            n = self.warehouse.table("raw", name).count()
        except Exception:
            self._log([(name, "full", 0, run_ts, "failed")])
            raise
        self._log([(name, "full", n, run_ts, "ok")])
        return n

    def load_month(self, month: str, run_ts: datetime | None = None) -> int:
        """Replace one month of transactions; returns its row count.

        Rerunning gives the same rows, a month missing from the source is emptied, and a failed
        load leaves the old rows in place. If another load has replaced the month since this one
        began, it fails with a Conflict.
        """
        month_bounds(month)
        run_ts = run_ts or utc_now()
        try:
            since = self._begin()
            folder = self._run_folder(run_ts)
            rows = self._transactions().where(in_month("t_dat", month))
            self._stage(rows, run_ts, folder)
            self._publish(folder, since, emptied=month)
            n = self.month_rows(month)
        except Exception:
            self._log([("transactions", month, 0, run_ts, "failed")])
            raise
        self._log([("transactions", month, n, run_ts, "ok")])
        return n

    def load_months(self, run_ts: datetime | None = None) -> dict[str, int]:
        """Replace every month the source holds, from one scan and all at once: readers see none or all."""
        run_ts = run_ts or utc_now()
        try:
            since = self._begin()
            folder = self._run_folder(run_ts)
            self._stage(self._transactions().where(F.col("t_dat").isNotNull()), run_ts, folder)
            months = self._publish(folder, since)
            # Counted from file footers: only the partition column is read.
            counts = (
                self.warehouse.table("raw", "transactions")
                .where(F.col(LOAD_MONTH).isin(months))
                .groupBy(LOAD_MONTH)
                .count()
            )
            loaded = dict(sorted((r[LOAD_MONTH], r["count"]) for r in counts.collect()))
        except Exception:
            self._log([("transactions", "history", 0, run_ts, "failed")])
            raise
        if loaded:
            self._log([("transactions", m, n, run_ts, "ok") for m, n in loaded.items()])
        return loaded

    def load_history(self, run_ts: datetime | None = None) -> dict[str, int]:
        """Both dimensions, then every month of transactions."""
        run_ts = run_ts or utc_now()
        loaded = {name: self.load_dimension(name, run_ts) for name in DIMENSIONS}
        return {**loaded, **self.load_months(run_ts)}

    def months(self) -> list[str]:
        return [r["month"] for r in list_months(self._transactions()).collect()]

    def month_rows(self, month: str) -> int:
        """Rows of one loaded month; touches only that month's partition."""
        return (
            self.warehouse.table("raw", "transactions")
            .where(F.col(LOAD_MONTH) == month)
            .count()
        )

    def _begin(self) -> State:
        """The state of the landing table that a load starts from."""
        self.warehouse.create_partitioned(
            "raw",
            "transactions",
            _LANDED,
            T.StructType([T.StructField(LOAD_MONTH, T.StringType())]),
        )
        return self.warehouse.state("raw", "transactions")

    def _run_folder(self, run_ts: datetime) -> str:
        return f"{self.warehouse.root}/raw/loads/{self.warehouse.new_run(run_ts)}"

    def _stage(self, rows: DataFrame, run_ts: datetime, folder: str) -> None:
        """Write the rows below `folder`, one sub-folder per month.

        The rebalance hint lets Spark cut a month that outgrows one task into several and merge
        months that are tiny, so file sizes do not depend on how sales spread over months.
        """
        staged = (
            rows.withColumn(INGESTION_TS, timestamp(run_ts))
            .withColumn(LOAD_MONTH, month_label("t_dat"))
            .hint("rebalance", F.col(LOAD_MONTH))
        )
        write_partitioned(staged, LOAD_MONTH, folder)

    def _publish(self, folder: str, since: State, emptied: str | None = None) -> list[str]:
        """Publish the staged months in one commit and return them; without rows, a month goes.

        The commit notes which run each month comes from, so that derived tables can tell which
        months were loaded since they were built.
        """
        put = self.warehouse.staged(folder)
        months = [s.split("=", 1)[1] for s in put]
        drop = [f"{LOAD_MONTH}={emptied}"] if emptied and emptied not in months else []
        notes = {_LOADED + month: folder.rsplit("/", 1)[1] for month in months}
        self.warehouse.commit("raw", "transactions", put, drop, notes, since)
        return months

    def _log(self, entries: list[tuple]) -> None:
        """Append audit rows: table, partition, rows, loaded_at, status."""
        name = self.warehouse.name("raw", "load_log")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOAD_LOG)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
        known_rows(self.spark, entries, LOAD_LOG).write.insertInto(name)
