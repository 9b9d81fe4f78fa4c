"""Quality, language and language-model scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import prose, sentence

from starloom.llm import language, maxent, quality


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# -- language model --------------------------------------------------------------------------------


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_base(rows):
    trained = Counter()
    for i, t in rows:
        if i is not None and crc(i, 10) != 0:
            trained.update(tokens(t))
    n, v = sum(trained.values()), len(trained)
    out = []
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((trained[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own)
        held = i is not None and crc(i, 10) == 0
        out.append((i, held, len(own), sum(trained[x] > 0 for x in own), n, round(base, 6)))
    return Counter(out)


def check_base(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = maxent.scored(docs).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in found) == brute_base(rows)
    return found


def chained(rng, n):
    """Words of which each tells much about the next."""
    at, out = rng.randrange(30), []
    for _ in range(n):
        out.append(f"w{at}e{'abc'[at % 3]}")
        at = (at * 7 + rng.choice([1, 2])) % 30
    return " ".join(out)


def test_base_is_exact_and_the_model_learns(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 10)  # most words go through the join
    rng = random.Random(1)
    rows = [(i, chained(rng, rng.randint(0, 120)) + f" once{i}") for i in range(400)]
    found = check_base(spark.createDataFrame(rows, "doc_id LONG, text STRING"))
    held = [r for r in found if r.held_out]
    assert held
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_scores_of_odd_rows(odd, nothing):
    assert len(check_base(odd)) == odd.count()
    assert maxent.scored(nothing).count() == 0
    alone = maxent.scored(odd.where("doc_id is null")).collect()
    assert [(r.train_tokens, r.n_known, r.held_out) for r in alone] == [(0, 0, False)] * 2
    assert all(math.isfinite(r.score) for r in alone)


def test_words_of_one_class_are_told_apart(spark):
    """61 words of one ending, each of which tells the next; most of them have no class of their own."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"q{(k * 7 + at) % 61}xx" for k in range(60))) for i in range(300) for at in [rng.randrange(61)]]
    found = maxent.scored(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    held = [r for r in found if r.held_out]
    assert held
    assert sum(r.score for r in held) > 0.45 * sum(r.base_score for r in held)


def test_leaves_of_a_tree_sum_to_one():
    rng = np.random.default_rng(4)
    inside = rng.random((maxent.CLASSES, 8)) + 0.1
    trees = maxent.Trees(inside, 12)
    weights = rng.standard_normal(1 << 12).astype(np.float32)
    k = np.full(8, maxent.OWN + 3)
    ids = (np.arange(8, dtype=np.uint64) << np.uint64(5)) | np.uint64(maxent.OWN + 3)
    hashes = np.repeat(rng.integers(0, 1 << 63, (3, 1), dtype=np.uint64), 8, axis=1)
    for learned in (weights, np.zeros_like(weights)):
        (at, place, second, weight), = trees.ways(ids, k, hashes)
        chance = trees.chances(place, weight, learned)
        p = np.exp(-np.logaddexp(0, np.where(second, -chance, chance)).sum(axis=0))
        assert p.sum() == pytest.approx(1, rel=1e-5)
    assert p == pytest.approx(inside[maxent.OWN + 3] / inside[maxent.OWN + 3].sum(), rel=1e-4)


def test_steps_along_the_gradient_reach_what_was_seen():
    """One weight, asked 100 times and held 80 times: the penalised optimum has no gradient left."""
    w = np.zeros(1)
    for _ in range(60):
        w = maxent.climbed(w, np.array([80.0]), 100 / (1 + np.exp(-w)), np.array([100.0]))
    assert 80 - 100 / (1 + np.exp(-w[0])) == pytest.approx(maxent.RIDGE * w[0], abs=1e-3)


def test_probabilities_sum_to_one(spark):
    """Over all words that can follow one context: known ones and, per class of endings, an unknown one."""
    words = [f"a{c}{d}" for c in "bcdfghjkl" for d in "xyz"]
    rng = random.Random(2)
    # the model is read off texts of one word each: p(word) * p(end | word)
    train = [(i, " ".join(rng.choice(words[: 1 + i % 27]) for _ in range(20))) for i in range(60)]
    train = [(i, t) for i, t in train if crc(i, 10) != 0]
    probe = [i for i in range(1000, 9000) if crc(i, 10) == 0]
    one = {w: probe[k] for k, w in enumerate(words)}
    found = maxent.scored(
        spark.createDataFrame(train + [(i, w) for w, i in one.items()], "doc_id LONG, text STRING")
    )
    score = {r.doc_id: r.score for r in found.collect()}
    ends_less = {w: 10 ** score[i] for w, i in one.items()}
    assert 0 < sum(ends_less.values()) <= 1
    # exactly: the softmax over classes sums to one for any feature rows
    rng = np.random.default_rng(1)
    weights = rng.standard_normal((maxent.CLASSES, 3 * maxent.BUCKETS)).astype(np.float32)
    f = rng.integers(0, 3 * maxent.BUCKETS, (3, 50))
    prior = np.log(np.full(maxent.CLASSES, 1 / maxent.CLASSES, dtype=np.float32))
    p = maxent.probabilities(f, weights, prior)
    assert p.sum(0) == pytest.approx(1, abs=1e-5)
    k = rng.integers(0, maxent.CLASSES, 50)
    assert np.exp(maxent.log_probabilities(f, k, weights, prior)) == pytest.approx(p[k, np.arange(50)], rel=1e-4)


def test_tokens_without_a_step_per_word():
    texts = ["A b  a", "", " \n", "b\tÀ a", "x" * 70, "é"]
    made = maxent.Tokens()
    ids, begins = made.of(texts)
    assert begins.tolist() == [0, 4, 5, 6, 10, 12, 14]
    assert (ids[begins[1:] - 1] == 0).all()
    assert ids[0] == ids[2] == ids[8] and ids[1] == ids[6] and ids[0] != ids[1]
    again, _ = maxent.Tokens().of(["a"])
    assert again[0] == ids[0]
    many = [sentence(random.Random(k), 30) for k in range(50)]
    ids, begins = made.of(many)
    names = [w for t in many for w in tokens(t)]
    assert len(set(zip(names, ids.tolist()))) == len(set(names)) == len(set(ids.tolist()))


# -- quality ---------------------------------------------------------------------------------------


def labelled(spark, n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(20, 200))
        if not good:
            text = rng.choice([text.upper() + "!!!", " | ".join(text.split()), f"{text[:9]} " * 40])
        rows.append((i, text))
        if rng.random() < 0.8:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    return docs, spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT"), labels


def test_held_out_accuracy(spark):
    docs, labels, known = labelled(spark)
    found = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(found) == 600
    assert all(r.held_out == (crc(i, 3) == 1) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    held = [(i, y) for i, y, _ in known if crc(i, 3) == 1]
    assert sum(found[i].predicted == y for i, y in held) >= 0.95 * len(held)
    kept = {r.doc_id for r in quality.accepted(docs, labels).collect()}
    assert kept == {i for i, r in found.items() if r.predicted}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) AS quality")
    one = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.quality(docs, flipped).collect()}
    assert one == pytest.approx(two)


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (None, 1), (77, 1), (8, None), (9, 5)], "doc_id LONG, quality INT"
    )
    found = quality.quality(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    unlabelled = quality.quality(odd, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in unlabelled} == {(0.5, 1)}
    assert quality.quality(nothing, labels).count() == 0
    assert quality.accepted(odd, labels.where("false")).count() == odd.count()
    assert quality.accepted(odd, labels).columns == odd.columns


def test_isotonic_against_brute_force():
    rng = random.Random(5)
    for _ in range(50):
        n = np.array([rng.randint(1, 5) for _ in range(9)], dtype=float)
        ones = np.array([rng.randint(0, int(k)) for k in n], dtype=float)
        edges, levels = quality.isotonic(np.arange(9), ones, n)
        fitted = levels[np.searchsorted(edges, np.arange(9), side="right") - 1]
        # the max-min formula of isotonic regression
        expected = [
            max(min(ones[a : b + 1].sum() / n[a : b + 1].sum() for b in range(k, 9)) for a in range(k + 1))
            for k in range(9)
        ]
        assert fitted == pytest.approx(expected)


# -- language --------------------------------------------------------------------------------------

SYLLABLES = {"xx": ["ka", "to", "mi", "ra"], "yy": ["ä", "sch", "ung", "er"], "zz": ["ción", "ñ", "el", "os"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_documents(spark):
    rng = random.Random(6)
    rows = [(i, lang := rng.choice(list(SYLLABLES)), speak(rng, lang, rng.randint(3, 300))) for i in range(200)]
    shown = [(i, t, None if i % 9 == 0 else lang) for i, lang, t in rows]
    docs = spark.createDataFrame(shown, "doc_id LONG, text STRING, lang STRING")
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(found[i].held_out == (crc(i, 4) == 2) for i, _, _ in rows)
    held = [(i, lang) for i, lang, _ in rows if crc(i, 4) == 2]
    assert sum(found[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_languages_of_odd_rows(odd, nothing):
    from pyspark.sql import functions as F

    docs = odd.withColumn("lang", F.when(F.col("doc_id") == 1, "en").when(F.col("doc_id") == 7, "de"))
    found = language.identify(docs).collect()
    assert len(found) == odd.count()
    for r in found:
        if r.doc_id in (3, 4, 5, 9, 10):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    unlearned = language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}
    assert language.identify(nothing.withColumn("lang", F.lit("en"))).count() == 0


def brute_phrases(text, sample):
    at = n = 0
    inside = "".join(map(chr, sample))
    while at < len(text):
        size = 1
        while at + size < len(text) and "".join(map(chr, text[at : at + size + 1])) in inside:
            size += 1
        at += size
        n += 1
    return n


def test_phrases_equal_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(30):
        sample = rng.integers(0, 4, 60).astype(np.uint8)
        step = language.suffix_automaton(sample, 6)
        texts = sorted((rng.integers(0, 5, rng.integers(1, 40)).astype(np.uint8) for _ in range(20)), key=len, reverse=True)
        sizes = np.array([len(t) for t in texts])
        lanes = np.zeros((sizes[0], len(texts)), dtype=np.uint8)
        for k, t in enumerate(texts):
            lanes[: len(t), k] = t
        found = language.phrases(step, lanes, sizes)
        assert found.tolist() == [brute_phrases(t.tolist(), sample.tolist()) for t in texts]
