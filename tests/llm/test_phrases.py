"""Collocations."""

import random
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm import phrases

SCHEMA = "doc_id LONG, text STRING, lang STRING, phrase STRING, f INT, `words` STRING"


def brute(rows, longest, least, first):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang, text = lang or "und", (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        known = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in known.items():
            inside = any(
                100 * b >= 50 * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
                for v, b in known.items() if len(v) > len(w)
            )
            if not inside:
                score, _, l, r = min((10**6 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
                scored.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(docs, **how).collect())


def text_of(rng, n, words):
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", " \x1c", "\r\n"]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))


@pytest.mark.parametrize("longest, least, first", [(3, 10, 2_000), (2, 3, 20), (4, 2, 50), (3, 1, 2_000)])
def test_collocations_equal_brute_force(spark, longest, least, first):
    rng = random.Random(longest * least)
    words = ["a", "B", "É", "ü", "zz", "漢字", "Z", "|", "e\x00f", "...", "ab"]
    rows = [(k, text_of(rng, rng.randint(0, 60), words), rng.choice(["en", "de", None])) for k in range(60)]
    rows += [(k, "New York City is not New York State", "en") for k in range(25)]
    rows += [(k, "of the, of the", "und") for k in range(12)] + [(None, None, "en"), (1, "", None), (2, " \n\t", "xx")]
    got = found(spark, rows, longest=longest, least=least, first=first)
    assert got == brute(rows, longest, least, first)


def test_blocks_and_languages_split_without_changing_counts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)
    rng = random.Random(3)
    rows = [(k, text_of(rng, 50, ["a", "b", "c", "d"]), rng.choice(["en", "de"])) for k in range(40)]
    assert found(spark, rows) == brute(rows, 3, 10, 2_000)


def test_texts_are_cut_after_a_piece(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 10)
    text = "aaaa bbbb cccc. dd, eeeeeeeeeeeeeeeeeeeeeee\nf g"
    parts = list(phrases.cut_texts(text))
    assert "".join(parts) == text and len(parts) > 1
    assert all(p[-1] in ".,\n" for p in parts[:-1])


def test_a_filter_that_lets_everything_through_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 7)
    rng = random.Random(4)
    rows = [(k, text_of(rng, 50, ["a", "b", "c", "d", "e", f"u{k}"]), "en") for k in range(40)]
    assert found(spark, rows) == brute(rows, 3, 10, 2_000)


def test_scores_beyond_64_bits(spark):
    frequent = 3_000_000_000
    score = spark.sql(
        f"SELECT (1000000 * CAST({frequent} AS DECIMAL(38,0)) * CAST({frequent} AS DECIMAL(38,0)))"
        f" div (CAST({frequent + 1} AS DECIMAL(38,0)) * CAST({frequent} AS DECIMAL(38,0))) AS s"
    ).first().s
    assert score == 10**6 * frequent**2 // ((frequent + 1) * frequent)


def test_empty_table_and_hot_words(spark, nothing):
    assert found(spark, []) == []
    rows = [(1, "the " * 5_000, "en"), (2, "the cat " * 400, "en"), (3, "x" * 100_000, "en")]
    assert found(spark, rows) == brute(rows, 3, 10, 2_000)


def test_counting_reads_written_occurrences(spark, monkeypatch):
    """Each relation that is counted lies in a file, and rows go to Python in small batches while it is made."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    real = phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda rows, at, name: seen.append((name, spark.conf.get(key, None))) or real(rows, at, name))
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(1, "a b c " * 20, "en", "", 0, "")], SCHEMA)
    assert phrases.collocations(docs, longest=3).count() > 0
    names = [name for name, _ in seen]
    assert {"occurrences-1", "occurrences-2", "occurrences-3"} <= set(names)
    assert {size for _, size in seen} == {str(4 << 20)}
    assert spark.conf.get(key, None) == before
