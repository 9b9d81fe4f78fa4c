"""Searches over vectors: exact inner products by pivot elimination, near neighbours by a k-means tree."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import scratch, stored

#: Rows of a block of candidates, and of a block of queries, about.
CANDIDATES, QUERIES = 16_384, 2_048
#: Queries whose bounds are held at a time.
SLICE = 64
#: Integer components at or above this size are multiplied as Python integers, which don't overflow.
WIDE = 1 << 26
#: Squared norms from here on are too large for bounds in floating point; all candidates are evaluated.
LARGEST = 2.0**104
#: The largest score; the smallest is one further from 0.
SCORE_LIMIT = (1 << 63) - 1


def finite(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and v (array<double>) of the rows whose vector has components, all of them finite."""
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("vec_id is not null and size(v) > 0").where(~bad)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column as one matrix; shorter vectors are filled with zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks)
    sizes = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def spread(rows: np.ndarray, n: int) -> np.ndarray:
    """Places of n rows, each the farthest from those before it."""
    chosen = [0]
    near = np.linalg.norm(rows - rows[0], axis=1)
    while len(chosen) < min(n, len(rows)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(rows - rows[chosen[-1]], axis=1))
    return np.array(chosen)


def lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """Rows with one component more that gives them all the norm sqrt(top).

    Among them and a query lifted by 0, a smaller distance is the same as a larger inner product.
    """
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", rows, rows), 0))
    return np.c_[rows, rest]


def best_of_block(
    ids: np.ndarray,
    rows: np.ndarray,
    table: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    query_table: np.ndarray,
    top: float,
    k: int,
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best in the block: pivot elimination.

    The largest difference of distances to a pivot bounds a candidate's distance from below, and so
    its inner product from above. Candidates are evaluated in the order of their bounds, until the
    k-th best score exceeds every bound that is left; a tie in score goes to the smaller id, so a
    candidate is left out only if its bound is below the k-th score.
    """
    wide = max(np.abs(rows).max(initial=0), np.abs(queries).max(initial=0)) >= WIDE
    whole = whole_numbers(rows, wide)
    asked = whole_numbers(queries, wide)
    norms = np.einsum("ij,ij->i", queries, queries)
    for a in range(0, len(queries), SLICE):
        b = min(a + SLICE, len(queries))
        low = np.zeros((b - a, len(rows)))
        for p in range(table.shape[1]):
            np.maximum(low, np.abs(query_table[a:b, p, None] - table[None, :, p]), out=low)
        # |q|^2 + top - 2 q.x >= low^2, with room for rounding
        room = 1e-9 * (norms[a:b] + top) + 1
        highest = (norms[a:b, None] + top - low * low) / 2 + room[:, None]
        if not table.shape[1]:
            highest[:] = np.inf
        for i in range(a, b):
            bound = highest[i - a]
            order = np.argsort(-bound)
            best: list[tuple[int, int]] = []
            done, step = 0, 16 * k
            while done < len(rows) and not (len(best) == k and bound[order[done]] < -best[-1][0]):
                at = order[done : done + step]
                at = at[ids[at] != query_ids[i]]
                scores = -(whole[at] @ asked[i])
                if wide:
                    scores = np.array([min(max(int(x), -SCORE_LIMIT), SCORE_LIMIT + 1) for x in scores], dtype=object)
                if len(best) == k:
                    near = scores <= best[-1][0]
                    at, scores = at[near], scores[near]
                best = heapq.nsmallest(k, [*best, *zip(scores.tolist(), ids[at].tolist(), strict=True)])
                done, step = done + step, step * 4
            for score, candidate in best:
                yield int(query_ids[i]), candidate, -score


def whole_numbers(rows: np.ndarray, wide: bool) -> np.ndarray:
    if wide:
        return np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape)
    return rows.astype(np.int64)


def exact_top(
    vectors: DataFrame, is_query: str, k: int = 5, scale: int = 256, pivots: int = 32, sample: int = 2_000,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """Return query_id, rank, vec_id, score: each query's k largest inner products of floor(scale * x).

    `is_query` is a condition on vec_id. A query is compared with every row of another vec_id; ties go
    to the smaller vec_id. Null or empty vectors, null or non-finite components and null vec_ids take no
    part; a shorter vector counts as filled with zeros; a score beyond 64 bits counts as the nearest of 64; rows that repeat a vec_id are candidates one by
    one, and of several vectors under a query's id the smallest asks. Scores are exact; no rows give no rows. Pivots come from a bounded sample; they decide how much is left out, not the result.
    """
    spark = vectors.sparkSession
    rows = finite(vectors, id_col, vec_col)
    seen = rows.agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) ** 2)).alias("top"),
        F.max(F.size("v")).alias("size"),
    ).first()
    schema = "query_id long, vec_id long, score long"
    if not seen["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top, size = float(seen["top"]), seen["size"]
    if not top < LARGEST:
        top, pivots = 0.0, 0
    some = rows.orderBy(F.xxhash64("vec_id", "v")).limit(sample).toPandas()
    held = np.zeros((len(some), size))
    for i, v in enumerate(some.v):
        held[i, : len(v)] = np.floor(np.asarray(v) * scale)
    held = lifted(held, top)
    chosen = held[spread(held, pivots)] if pivots else held[:0]
    shared = spark.sparkContext.broadcast(chosen)

    def measured(lift: bool) -> Callable:
        def run(batches):
            pivot = shared.value
            for batch in batches:
                v = matrix(batch.column(1))
                full = np.zeros((len(v), size))
                full[:, : v.shape[1]] = np.floor(np.asarray(v) * scale)
                at = lifted(full, top) if lift else np.c_[full, np.zeros(len(full))]
                away = np.sqrt(
                    np.maximum((at * at).sum(1)[:, None] + (pivot * pivot).sum(1) - 2 * at @ pivot.T, 0)
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(list(full)), pa.array(list(away))], names=["vec_id", "v", "away"]
                )

        return run

    kept = "vec_id long, v array<double>, away array<double>"
    n = seen["n"]
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    strips = -(-n // CANDIDATES)
    columns = max(1, -(-asked.count() // QUERIES))
    candidates = rows.mapInArrow(measured(True), kept).select(
        "*", F.pmod(F.xxhash64("vec_id", "v"), F.lit(strips)).cast("int").alias("strip"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"),
    )
    asking = asked.mapInArrow(measured(False), kept).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"),
        F.pmod(F.xxhash64("vec_id"), F.lit(columns)).cast("int").alias("column"),
    )

    def cell(found: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(found) and len(asked):
            out = list(
                best_of_block(
                    found["vec_id"].to_numpy(), matrix(found["v"]), matrix(found["away"]),
                    asked["vec_id"].to_numpy(), matrix(asked["v"]), matrix(asked["away"]), top, k,
                )
            )
        q, c, s = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.int64())})

    best = candidates.groupBy("strip", "column").cogroup(asking.groupBy("strip", "column")).applyInArrow(cell, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


#: Children of a tree node, rows a leaf holds about, and rows the tree is fitted on at most.
BRANCHES, LEAF, FITTED = 8, 128, 20_000
#: Rows that meet queries in one task, about: neighbouring leaves together, or a part of a large leaf.
BLOCK = 16_384


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres, and for each row the place of the nearest; empty centres are dropped."""
    centres = rows[np.random.default_rng(seed).permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        near = (((centres * centres).sum(1) - 2 * rows @ centres.T)).argmin(1)
        used = np.unique(near)
        centres = np.stack([rows[near == c].mean(0) for c in used])
    near = (((centres * centres).sum(1) - 2 * rows @ centres.T)).argmin(1)
    used, near = np.unique(near, return_inverse=True)
    return centres[used], near


class Tree:
    """A hierarchical k-means tree: per node its children's centres; leaves are numbered."""

    def __init__(self, rows: np.ndarray, leaves: int) -> None:
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.leaf_of: dict[int, int] = {}
        self._grow(rows, max(1, leaves))

    def _grow(self, rows: np.ndarray, leaves: int) -> int:
        node = len(self.centres)
        self.centres.append(np.zeros((0, rows.shape[1])))
        self.children.append([])
        k = min(BRANCHES, leaves, len(rows))
        centres, near = k_means(rows, k, node) if k > 1 else (rows[:0], np.zeros(0, dtype=int))
        if len(centres) < 2:
            self.leaf_of[node] = self.leaves
            self.leaves += 1
            return node
        self.centres[node] = centres
        for c in range(len(centres)):
            own = rows[near == c]
            self.children[node].append(self._grow(own, round(leaves * len(own) / len(rows))))
        return node

    def parts(self) -> tuple:
        return self.centres, self.children, self.leaf_of


def leaf_ids(parts: tuple, rows: np.ndarray) -> np.ndarray:
    """The leaf of every row: at each node on, to the nearest centre."""
    centres, children, leaf_of = parts
    out = np.zeros(len(rows), dtype=np.int64)
    stack = [(0, np.arange(len(rows)))]
    while stack:
        node, at = stack.pop()
        if node in leaf_of:
            out[at] = leaf_of[node]
            continue
        c = centres[node]
        near = ((c * c).sum(1) - 2 * rows[at] @ c.T).argmin(1)
        stack += [(child, at[near == k]) for k, child in enumerate(children[node]) if (near == k).any()]
    return out


def best_bins(parts: tuple, row: np.ndarray) -> Iterator[int]:
    """Leaves in best-bin-first order: down to the nearest, then on from the nearest branch not taken."""
    centres, children, leaf_of = parts
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        while node not in leaf_of:
            away = ((centres[node] - row) ** 2).sum(1)
            first = int(away.argmin())
            for k, child in enumerate(children[node]):
                if k != first:
                    heapq.heappush(queue, (float(away[k]), child))
            node = children[node][first]
        yield leaf_of[node]


def calibrated(parts: tuple, leaves: int, rows: np.ndarray, k: int, recall: float, asked: int = 200) -> int:
    """How many leaves to visit: widened until the recall among the fitted rows, by brute force, is reached."""
    own = leaf_ids(parts, rows)
    picked = np.linspace(0, len(rows) - 1, min(asked, len(rows))).astype(int)
    ranks = []
    for i in picked:
        away = ((rows - rows[i]) ** 2).sum(1)
        away[i] = np.inf
        nearest = np.argsort(away, kind="stable")[: min(k, len(rows) - 1)]
        place = np.empty(leaves, dtype=int)
        place[list(best_bins(parts, rows[i]))] = np.arange(leaves)
        ranks.append(place[own[nearest]])
    needed = np.sort(np.concatenate(ranks))
    if not len(needed):
        return leaves
    return min(leaves, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1)


def blocks(held_by: dict[int, int], leaves: int) -> tuple[dict[int, int], list[int]]:
    """The block of each leaf that holds rows, and the rows of each block; leaves next to each other share one."""
    block_of: dict[int, int] = {}
    rows_in: list[int] = []
    for leaf in range(leaves):
        n = held_by.get(leaf, 0)
        if not n:
            continue
        if not rows_in or rows_in[-1] + n > BLOCK:
            rows_in.append(0)
        rows_in[-1] += n
        block_of[leaf] = len(rows_in) - 1
    return block_of, rows_in


def nearest(
    vectors: DataFrame, is_query: str, k: int = 10, recall: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Return query_id, rank, vec_id, score: near the k smallest Euclidean distances of each query.

    A tree with leaves of about LEAF rows is fitted on at most FITTED rows, then every row is put in
    its leaf. Each query visits leaves best bin first, as many as the calibration on the fitted rows
    needs for `recall`, and more until they hold k other rows; if that calibration fails, all leaves are visited.
    Scores are exact on the original vectors; ties go to the smaller vec_id. Null, empty or zero vectors,
    null or non-finite components and null vec_ids take no part; vectors of another size than most (the
    smallest such size) take no part. Repeated rows are candidates one by one; of several vectors under a query's id the smallest asks.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = finite(vectors, id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return empty
    folder = scratch(spark)
    rows = rows.where(F.size("v") == common["size"])
    share = min(1.0, 1.2 * FITTED / common["n"])
    fitted = (
        rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) <= int(share * (1 << 20)))
        .orderBy(F.xxhash64("vec_id", "v"))
        .limit(FITTED)
        .toPandas()
    )
    if fitted.empty:
        return empty
    held = np.stack(fitted.v.to_list())
    tree = Tree(held, max(1, min(len(held) // 8, common["n"] // LEAF)))
    parts, leaves = tree.parts(), tree.leaves
    visits = calibrated(parts, leaves, held, k, recall)
    shared = spark.sparkContext.broadcast(parts)

    def put(batches):
        for batch in batches:
            leaf = leaf_ids(shared.value, matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "v", "leaf"])

    index = stored(rows.mapInArrow(put, "vec_id long, v array<double>, leaf long"), folder, "index")
    # One number a leaf; the number of leaves is bounded by the fitted rows.
    held_by = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    block_of, rows_in = blocks(held_by, leaves)
    placing = spark.sparkContext.broadcast((held_by, block_of, [-(-n // BLOCK) for n in rows_in]))

    def visit(batches):
        for batch in batches:
            at, block, chunks, wanted = [], [], [], []
            counts, where, parts_of = placing.value
            for i, (row, own) in enumerate(zip(matrix(batch.column(1)), batch.column(2).to_pylist())):
                reached, chosen = 0, {}
                for done, leaf in enumerate(best_bins(shared.value, row)):
                    if done >= visits and reached >= k + own:  # rows of its own id may be among them
                        break
                    if leaf in counts:
                        reached += counts[leaf]
                        chosen.setdefault(where[leaf], []).append(leaf)
                for b, own in chosen.items():
                    at.append(i)
                    block.append(b)
                    chunks.append(parts_of[b])
                    wanted.append(own)
            taken = batch.select(["vec_id", "v"]).take(pa.array(at, pa.int64()))
            more = [pa.array(block, pa.int64()), pa.array(chunks, pa.int64()), pa.array(wanted, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *more], names=["query_id", "q", "block", "chunks", "leaves"]
            )

    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count("*").alias("own"))
    asking = asked.mapInArrow(
        visit, "query_id long, q array<double>, block long, chunks long, leaves array<long>"
    ).select(
        "query_id", "q", "block", "leaves",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
    )

    def place(batches):
        _, where, parts_of = placing.value
        for batch in batches:
            block = np.array([where[x] for x in batch.column(2).to_pylist()], dtype=np.int64)
            chunks = np.array(parts_of, dtype=np.int64)[block]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block), pa.array(chunks)], names=["vec_id", "v", "leaf", "block", "chunks"]
            )

    placed = index.mapInArrow(place, "vec_id long, v array<double>, leaf long, block long, chunks long").withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id", "v"), F.col("chunks"))
    )

    def meet(asked: pa.Table, found: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(asked) and len(found):
            ids, rows, leaf = found["vec_id"].to_numpy(), matrix(found["v"]), found["leaf"].to_numpy()
            wanted = asked["leaves"].to_pylist()
            for q, row, own in zip(asked["query_id"].to_numpy(), matrix(asked["q"]), wanted, strict=True):
                at = np.flatnonzero(np.isin(leaf, own) & (ids != q))
                away = np.sqrt(((rows[at] - row) ** 2).sum(1))
                best = np.lexsort((ids[at], away))[:k]
                out.append((np.full(len(best), q), ids[at[best]], away[best]))
        q, c, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else ([], [], [])
        return pa.table(
            {"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())}
        )

    best = asking.groupBy("block", "chunk").cogroup(placed.groupBy("block", "chunk")).applyInArrow(
        meet, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
