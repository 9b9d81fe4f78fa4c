"""SimHash fingerprints and their near duplicates."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from texts import sentence

from starloom.llm import simhash
from starloom.llm.common import stored


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    width = min(3, len(words))
    shingles = [b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Rows of doc_id, fingerprint and component by comparing all pairs; rows of one doc_id are one vertex."""
    known = [(i, brute_fingerprint(t)) for i, t in rows]
    label = {i: i for i, _ in known if i is not None}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, (i, x) in enumerate(known):
        for j, y in known[:k]:
            if i is not None and j is not None and (x ^ y).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return sorted(((i, f"{f:016x}", None if i is None else find(i)) for i, f in known), key=str)


def found(docs):
    return sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)


def close_texts(rng, start, size, n, changes):
    words = [f"w{k}" for k in range(n)]
    rows = []
    for k in range(size):
        own = list(words)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(n)] = f"x{rng.randrange(50)}"
        rows.append((start + k, " ".join(own)))
    return rows


@pytest.mark.parametrize("entry", [1, 4, 1_024])
def test_components_equal_brute_force(spark, monkeypatch, entry):
    monkeypatch.setattr(simhash, "ENTRY", entry)
    rng = random.Random(entry)
    rows = close_texts(rng, 0, 60, 150, 3) + close_texts(rng, 100, 60, 300, 2) + close_texts(rng, 200, 30, 20, 1)
    rows += [(300 + k, sentence(rng, rng.randint(1, 40))) for k in range(40)] + [(400, "W1 w2\tW3"), (401, "w1 w2 w3")]
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id LONG, text STRING")) == brute(rows)


@pytest.mark.parametrize("entry", [1, 8, 1_024])
def test_pairs_of_fingerprints_equal_brute_force(spark, monkeypatch, tmp_path, entry):
    """Fingerprints that share halves, at distances of 1 to 5, over sign bit and segment border."""
    monkeypatch.setattr(simhash, "ENTRY", entry)
    rng = random.Random(entry)
    fps = {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32, (1 << 32) | (1 << 31)}
    for _ in range(6):
        one = rng.getrandbits(64)
        for _ in range(40):
            fps.add(one ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
            fps.add(one ^ sum(1 << b for b in rng.sample(range(32), rng.randint(0, 3))))
            fps.add(one ^ sum(1 << b for b in rng.sample(range(28, 36), rng.randint(0, 3))))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    pairs = simhash.near(spark.createDataFrame([(f,) for f in signed], "fp LONG"), str(tmp_path / "scratch"))
    expected = {(x, y) for x in signed for y in signed if x < y and ((x ^ y) % (1 << 64)).bit_count() <= 2}
    got = [tuple(r) for r in pairs.collect()]
    assert set(got) == expected and len(got) == len(expected)


def test_exploded_rows_are_not_broadcast(spark, monkeypatch, tmp_path):
    """Read from a file, so that Spark knows a size, which does not count what explode() adds."""
    fps = spark.range(2_000).select(F.xxhash64("id").alias("fp"))
    fps.write.parquet(str(tmp_path / "fps"))
    monkeypatch.setattr(simhash, "ENTRY", 1)
    frames = []
    monkeypatch.setattr(simhash, "stored", lambda frame, *at: frames.append(frame) or stored(frame, *at))
    frames.append(simhash.near(spark.read.parquet(str(tmp_path / "fps")), str(tmp_path / "scratch")))
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    assert len(plans) == 2 and all("Generate explode" in p and "SortMergeJoin" in p for p in plans)
    assert not any("BroadcastExchange" in p for p in plans)


def test_rows_of_every_shape(spark, odd, nothing):
    assert found(odd) == brute([tuple(r)[:2] for r in odd.select("doc_id", "text").collect()])
    assert found(nothing) == []


def test_rows_of_one_id_are_one_vertex(spark):
    rng = random.Random(5)
    a, b, c = (sentence(rng, 30) for _ in range(3))
    rows = [(9, a), (4, b), (4, a), (4, c), (7, c), (3, sentence(rng, 30)), (None, a), (None, None)]
    assert found(spark.createDataFrame(rows, "doc_id LONG, text STRING")) == brute(rows)


def test_long_texts_are_counted_in_blocks(spark, monkeypatch):
    text = sentence(random.Random(1), 5_000, words=50)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text)
    assert simhash.fingerprint("Ab  c\n") % (1 << 64) == brute_fingerprint("ab c")
