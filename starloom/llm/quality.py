"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import crc_mod, id_text, scratch, slices, stored

#: Random Fourier features, the kernel's width in standard deviations, and the ridge penalty per row.
FEATURES, WIDTH, PENALTY = 384, 3.0, 1e-4
#: Bins of raw scores that the calibration is fitted on.
BINS = 1_000
STATISTICS = 20


def statistics(text: str) -> list[float]:
    """Statistics of a text's shape: sizes, character classes, repetition and entropy. An empty text has zeros."""
    n = len(text)
    if not n:
        return [0.0] * STATISTICS
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    plain = np.minimum(codes, 255).astype(np.uint8)
    counts = np.bincount(plain, minlength=256)
    share = counts[counts > 0] / n
    upper = counts[65:91].sum()
    lower = counts[97:123].sum()
    digits = counts[48:58].sum()
    space = counts[32] + counts[9:14].sum()
    marks = n - upper - lower - digits - space - counts[128:].sum()
    words = text.split()
    w = max(1, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1)
    kinds: dict[str, int] = {}
    for x in words:
        kinds[x] = kinds.get(x, 0) + 1
    most = max(kinds.values(), default=0)
    same_next = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = text.split("\n")
    return [
        math.log1p(n),
        math.log1p(len(words)),
        float(sizes.mean()),
        float(sizes.std()),
        float((sizes <= 2).mean()),
        len(kinds) / w,
        most / w,
        same_next / w,
        upper / n,
        digits / n,
        space / n,
        marks / n,
        float(counts[46] + counts[44]) / w,
        float(counts[33] + counts[63]) / w,
        float(counts[[35, 36, 37, 38, 42, 64, 94, 126]].sum()) / w,
        float(counts[[124, 60, 62, 123, 125, 91, 93, 61, 95, 47, 92]].sum()) / w,
        float(-(share * np.log2(share)).sum()),
        len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        math.log1p(max(map(len, lines))),
    ]


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the statistics x (array<double>) of every row."""

    def run(batches):
        for batch in batches:
            rows = [statistics(t) for _, part in slices(batch.column(1)) for t in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, x array<double>")


def fourier(x: np.ndarray, model: dict) -> np.ndarray:
    """Features whose products approximate a Gaussian kernel of the standardised statistics, and a constant."""
    z = np.clip((x - model["mean"]) / model["std"], -8, 8)
    return np.c_[np.cos(z @ model["w"] + model["b"]) * math.sqrt(2 / model["w"].shape[1]), np.ones(len(z))]


def stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(low: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the lower edges of the steps, and their levels, which never fall."""
    steps: list[list[float]] = []
    for x, a, n in zip(low, ones, all_, strict=True):
        steps.append([x, a, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, a2, n2 = steps.pop()
            steps[-1][1] += a2
            steps[-1][2] += n2
    s = np.array(steps)
    return s[:, 0], s[:, 1] / s[:, 2]


def fit(labelled: DataFrame, seed: int = 7) -> dict | None:
    """Fit on x and y (0 or 1); None without rows.

    Each partition sums its part of the normal equations, and these are summed by row of the matrix;
    the driver sees FEATURES + 1 rows of sums and BINS bins, whatever the corpus.
    """
    spark = labelled.sparkSession
    sums = [F.sum(F.get("x", F.lit(k))).alias(f"s{k}") for k in range(STATISTICS)]
    squares = [F.sum(F.get("x", F.lit(k)) ** 2).alias(f"q{k}") for k in range(STATISTICS)]
    seen = labelled.agg(F.count("*").alias("n"), *sums, *squares).first()
    n = seen["n"]
    if not n:
        return None
    mean = np.array([seen[f"s{k}"] for k in range(STATISTICS)]) / n
    spread = np.sqrt(np.maximum(np.array([seen[f"q{k}"] for k in range(STATISTICS)]) / n - mean**2, 0))
    random = np.random.default_rng(seed)
    model = {
        "mean": mean,
        "std": np.where(spread > 1e-9, spread, 1.0),
        "w": random.standard_normal((STATISTICS, FEATURES)) / WIDTH,
        "b": random.uniform(0, 2 * math.pi, FEATURES),
    }
    shared = spark.sparkContext.broadcast(model)

    def equations(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            f = fourier(stacked(batch.column(0)), shared.value)
            total += f.T @ np.c_[f, batch.column(1).to_numpy()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(list(total))], names=["row", "part"]
        )

    parts = labelled.select("x", F.col("y").cast("double")).mapInArrow(equations, "row int, part array<double>")

    def added(found: pa.Table) -> pa.Table:
        return pa.table({"row": found["row"][:1], "total": pa.array([stacked(found["part"].combine_chunks()).sum(0)])})

    # partitions' sums meet in bounded groups first, so no task reads all of them for a row
    grouped = parts.withColumn("some", F.spark_partition_id() % 64)
    once = grouped.groupBy("row", "some").applyInArrow(added, "row int, total array<double>")
    rows = once.withColumnRenamed("total", "part").groupBy("row").applyInArrow(added, "row int, total array<double>")
    total = np.array([r.total for r in rows.orderBy("row").collect()])
    a = total[:, :-1] + np.diag([*[PENALTY * n] * FEATURES, 1e-9])
    model["weights"] = np.linalg.solve(a, total[:, -1])

    trained = spark.sparkContext.broadcast(model)

    def raw(batches):
        for batch in batches:
            score = fourier(stacked(batch.column(0)), trained.value) @ trained.value["weights"]
            place = np.clip((score + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], names=["place", "y"])

    bins = (
        labelled.select("x", F.col("y").cast("double"))
        .mapInArrow(raw, "place int, y double")
        .groupBy("place")
        .agg(F.sum("y").alias("ones"), F.count("*").alias("n"))
        .orderBy("place")
        .toPandas()
    )
    edges, levels = isotonic(bins.place.to_numpy(), bins.ones.to_numpy() + 0.0, bins.n.to_numpy() + 0.0)
    model["edges"], model["levels"] = edges, levels
    return model


def levels(x: np.ndarray, model: dict | None) -> np.ndarray:
    """Calibrated scores of rows of statistics; without a model every score is 0.5."""
    if model is None:
        return np.full(len(x), 0.5)
    raw = fourier(x, model) @ model["weights"]
    place = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1)
    # between the edges of steps, so that scores of one step still differ by little
    return np.clip(np.interp(place, model["edges"], model["levels"]), 0.0, 1.0)


def score(found: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score and predicted of rows of doc_id and x."""
    trained = found.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            level = levels(stacked(batch.column(1)), trained.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(level), pa.array((level >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return found.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")


def training_rows(found: DataFrame, labels: DataFrame, label_col: str, folds: int, held_fold: int) -> DataFrame:
    """x and y of the rows that have a label and are not of the held-out fold."""
    known = (
        labels.select(labels["doc_id"].cast("long").alias("label_id"), labels[label_col].cast("int").alias("y"))
        .where("y in (0, 1) and label_id is not null")
        .where(crc_mod(F.col("label_id"), folds) != held_fold)
        .groupBy("label_id")
        .agg(F.max("y").alias("y"))
    )
    return found.join(known, F.col("doc_id") == F.col("label_id")).select("x", "y")


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 3, held_fold: int = 1,
) -> DataFrame:
    """Return doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) for every row.

    Learns from the labels 0 and 1 of rows whose crc32(doc_id as text) mod folds is not held_fold, and
    from text statistics alone. A null text counts as empty; null doc_ids are scored, never learned
    from, and held_out is false; labels that are null or of ids without a document are not used; of several labels of one
    id the largest holds; repeated rows count each. Without labels every score is 0.5.
    """
    folder = scratch(docs.sparkSession)
    found = stored(described(docs, id_col, text_col), folder, "statistics")
    training = stored(training_rows(found, labels, label_col, folds, held_fold), folder, "training")
    return score(found, fit(training)).select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), folds) == held_fold, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 3, held_fold: int = 1,
) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores 0.5 or more; learned as in quality().

    Each row is judged by its own text, whatever its doc_id; a null text counts as empty.
    """
    folder = scratch(docs.sparkSession)
    found = described(docs, id_col, text_col)
    training = stored(training_rows(found, labels, label_col, folds, held_fold), folder, "training")
    trained = docs.sparkSession.sparkContext.broadcast(fit(training))

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t) for _, part in slices(texts) for t in part]).reshape(-1, STATISTICS)
        return pa.array(levels(x, trained.value) >= 0.5)

    return docs.where(good(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
