"""Landing files that several tests write."""

from __future__ import annotations

from pathlib import Path


def write_articles(spark, folder, ids):
    from starloom.schemas import ARTICLES

    rows = [tuple([i, n] + [f"{i} name"] + [None] * (len(ARTICLES) - 3)) for n, i in enumerate(ids)]
    spark.createDataFrame(rows, ARTICLES).write.mode("overwrite").parquet(
        str(Path(folder) / "articles.parquet")
    )
