"""Exact and near searches against brute force."""

import math

import numpy as np
import pytest

from starloom.llm import vectors

TOP = (1 << 63) - 1
SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, score DOUBLE, strip INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, 3) for i, v in rows], SCHEMA)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, is_query, k, scale=256):
    ints = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = set()
    for q, v in ints:
        if is_query(q):
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q]
            scored = sorted((min(max(s, -TOP), TOP + 1), i) for s, i in scored)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def random_rows(seed, n, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, size))
    v = (centres[rng.integers(0, 8, n)] + 0.4 * rng.standard_normal((n, size))) / 4
    return [(i, [float(x) for x in row]) for i, row in enumerate(v.astype(np.float32))]


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CANDIDATES", 150)
    monkeypatch.setattr(vectors, "QUERIES", 7)
    rows = random_rows(1, 700)
    rows += [(700 + k, rows[5][1]) for k in range(60)]  # ties
    found = vectors.exact_top(frame(spark, rows), "vec_id % 25 = 0", k=5)
    assert {tuple(r) for r in found.collect()} == brute_top(rows, lambda i: i % 25 == 0, 5)


ODD = [
    (0, [1.0, 2.0]), (50, [1.0, -2.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0, None]),
    (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [3.0]), (None, [9.0, 9.0]), (8, [1.0, 2.0]),
    (100, None),
]


def test_odd_vectors(spark):
    found = {tuple(r) for r in vectors.exact_top(frame(spark, ODD), "vec_id % 50 = 0", k=5).collect()}
    assert found == brute_top(ODD, lambda i: i % 50 == 0, 5)
    assert vectors.exact_top(frame(spark, ODD).where("false"), "true").count() == 0
    assert vectors.exact_top(frame(spark, ODD[:1]), "true").count() == 0


def test_large_components_do_not_overflow(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [-(2.0**40), 3.0]), (2, [2.0**9, 2.0**10]), (3, [1e30, 0.0])]
    found = {tuple(r) for r in vectors.exact_top(frame(spark, rows), "vec_id < 2", k=2).collect()}
    assert found == brute_top(rows, lambda i: i < 2, 2)


def test_repeated_rows_are_candidates_one_by_one(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])]
    found = sorted(tuple(r) for r in vectors.exact_top(frame(spark, rows), "vec_id = 0", k=3).collect())
    assert found == [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 2, 32768)]


def test_bounds_hold_and_leave_candidates_out():
    rows = np.floor(256 * np.array([v for _, v in random_rows(2, 400, 8)]))
    top = float((rows * rows).sum(1).max()) * 1.01
    lifted = vectors.lifted(rows, top)
    pivots = lifted[vectors.spread(lifted, 16)]
    away = np.linalg.norm(lifted[:, None] - pivots[None], axis=2)
    q = np.r_[rows[3], 0.0]
    low = np.abs(away - np.linalg.norm(q - pivots, axis=1)).max(1)
    assert (low <= np.linalg.norm(lifted - q, axis=1) + 1e-6).all()
    bound = (q @ q + top - low**2) / 2
    assert (bound < np.sort(rows @ rows[3])[-6]).any()


# -- near neighbours -------------------------------------------------------------------------------


def brute_nearest(rows, q, k):
    v = dict(rows)
    d = sorted((math.dist(v[q], w), i) for i, w in rows if i != q)
    return [i for _, i in d[:k]]


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 200)
    rows = random_rows(3, 1500)
    found = vectors.nearest(frame(spark, rows), "vec_id % 50 = 0", k=10).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 1500, 50))
    v, hits = dict(rows), 0
    for q, own in by_query.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(r.score == pytest.approx(math.dist(v[q], v[r.vec_id]), abs=1e-12) for r in own)
        hits += len({r.vec_id for r in own} & set(brute_nearest(rows, q, 10)))
    assert hits >= 0.9 * 10 * len(by_query)


def test_few_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 50)
    rows = [(i, [1.0, 2.0]) for i in range(400)]  # one hot leaf
    found = vectors.nearest(frame(spark, rows), "vec_id = 7", k=3).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)]
    few = vectors.nearest(frame(spark, rows[:3]), "vec_id = 0", k=10).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_odd_vectors_take_no_part_in_the_search(spark):
    found = vectors.nearest(frame(spark, ODD), "true", k=10).collect()
    assert {r.query_id for r in found} == {0, 50, 8} == {r.vec_id for r in found}
    assert vectors.nearest(frame(spark, ODD).where("false"), "true").count() == 0
    assert vectors.nearest(frame(spark, [(1, [0.0])]), "true").count() == 0


def test_all_leaves_come_best_bin_first():
    held = np.array([v for _, v in random_rows(4, 300, 4)])
    tree = vectors.Tree(held, 40)
    for row in held[:20]:
        order = list(vectors.best_bins(tree.parts(), row))
        assert sorted(order) == list(range(tree.leaves))
        assert order[0] == vectors.leaf_ids(tree.parts(), row[None])[0]


def test_rows_of_the_querys_id_do_not_stand_for_others(spark):
    rows = random_rows(5, 1_400)
    rows += [(0, [float(x) + 1e-4 * n for x in rows[0][1]]) for n in range(600)]
    found = vectors.nearest(frame(spark, rows), "vec_id = 0", k=10).collect()
    assert len(found) == 10 and {r["query_id"] for r in found} == {0}
    assert 0 not in {r.vec_id for r in found}
    assert sorted(r["rank"] for r in found) == list(range(1, 11))


def test_of_several_vectors_of_a_query_the_smallest_asks(spark):
    rows = [(0, [1.0, 0.0]), (0, [-1.0, 5.0]), (0, [-1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0])]
    for order in (rows, rows[::-1]):
        some = frame(spark, order).repartition(3)
        assert [r.vec_id for r in vectors.nearest(some, "vec_id = 0", k=1).collect()] == [2]
        top = vectors.exact_top(some, "vec_id = 0", k=1).collect()
        assert [(r.vec_id, r.score) for r in top] == [(2, 65_536)]
