"""Near duplicates, repeated lines and repeated passages."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from texts import prose, sentence

from starloom.llm import jaccard, lines, substrings



def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words_of(text)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def brute_components(rows, n, percent):
    """Component of each doc_id by comparing all pairs; rows of one doc_id are one vertex."""
    ids = sorted({i for i, _ in rows if i is not None})
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t, n))
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(
                x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]
            ):
                ra, rb = find(a), find(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def family(rng, start, size, n, changes):
    """A text and copies of it with some words changed, each starting from a copy made before."""
    made = [sentence(rng, n)]
    for _ in range(size - 1):
        w = rng.choice(made).split()
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(400)}"
        made.append(" ".join(w))
    return [(start + k, t) for k, t in enumerate(made)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_components_equal_brute_force(spark, n, percent):
    rng = random.Random(n)
    rows = family(rng, 0, 40, 120, 3) + family(rng, 100, 25, 12, 1) + family(rng, 200, 30, 300, 25)
    common = sentence(rng, 60)  # a passage that many documents share
    rows += [(300 + k, f"{sentence(rng, 40)} {common}") for k in range(20)]
    rows += [(400 + k, f"{common} u{k}") for k in range(10)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {r.doc_id: r for r in jaccard.components(docs, n, percent).collect()}
    assert {i: r.component_id for i, r in found.items()} == brute_components(rows, n, percent)
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(shingles(t, n)) for i, t in rows}


def test_groups_split_into_chunks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 5)
    rows = family(random.Random(9), 0, 60, 100, 4)
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {r.doc_id: r.component_id for r in jaccard.components(docs, 3, 90).collect()}
    assert found == brute_components(rows, 3, 90)


def test_long_texts_that_ask_a_group_are_split_by_bytes(spark, monkeypatch, tmp_path):
    linked = jaccard.linked

    def recorded(sets, percent):
        with open(tmp_path / "sets", "a") as f:
            f.write(f"{len(sets)}\n")
        return linked(sets, percent)

    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 16_000)
    monkeypatch.setattr(jaccard, "linked", recorded)
    rows = family(random.Random(4), 0, 80, 900, 4)  # some 4,000 characters each
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {r.doc_id: r.component_id for r in jaccard.components(docs, 3, 90).collect()}
    assert found == brute_components(rows, 3, 90)
    assert max(map(int, (tmp_path / "sets").read_text().split())) <= 32


def test_sizes_around_the_bands(spark):
    """Texts that are beginnings of one another, so that only sizes decide."""
    rng = random.Random(5)
    long = [f"x{k}" for k in range(130)]
    rows = [(k, " ".join(long[:k])) for k in range(1, 130) if rng.random() < 0.4]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    for percent in (90, 80, 95):
        found = {r.doc_id: r.component_id for r in jaccard.components(docs, 3, percent).collect()}
        assert found == brute_components(rows, 3, percent)


def test_components_of_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = jaccard.components(odd, 3, 90).collect()
    assert len(found) == len(rows)
    expected = brute_components(rows, 3, 90)
    assert all(r.component_id == (None if r.doc_id is None else expected[r.doc_id]) for r in found)
    assert {r.doc_id: r.component_id for r in found if r.doc_id in (1, 2, 6)} == {1: 1, 2: 1, 6: 1}
    assert jaccard.components(nothing).count() == 0


@pytest.mark.parametrize("shift", [0, (1 << 63) - 40, -(1 << 63), None])
def test_near_copies_of_rows_that_share_an_id_or_have_none(spark, shift):
    """A third of the rows under no id, a third under one; shift None: ids at both ends of the range."""
    rng = random.Random(5)
    first = [sentence(rng, 40) for _ in range(6)]
    rows = []
    for k in range(36):
        text = first[k % 6] if k < 30 else sentence(rng, 40)
        if 10 <= k < 20:
            text += " end"
        base = shift if shift is not None else (-(1 << 63) if k % 2 else (1 << 63) - 40)
        rows.append((None if k % 3 == 0 else base + 3 if k % 3 == 1 else base + k, text, k))
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int")
    words = [frozenset(zip(*(t.split()[j:] for j in range(5)), strict=False)) for _, t, _ in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(words[a] & words[b]) >= 80 * len(words[a] | words[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    expected = []
    for r in set(root):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == r]
        expected.append(min((i for i in ids if i is not None), default=None))
    found = jaccard.without_near_copies(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id for r in found.collect()), key=str) == sorted(expected, key=str)


def test_near_copies_of_odd_rows(odd, nothing):
    left = sorted(((r.doc_id, r.text) for r in jaccard.without_near_copies(odd).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    others = [(i, t) for i, t in rows if not t or t.lower() != "a b c d e f g h"]
    assert left == sorted([*others, (1, "a b c d e f g h")], key=str)
    assert jaccard.without_near_copies(nothing).collect() == []


def test_one_doc_id_with_two_texts_joins_their_groups(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "p q r s t"), (3, "p q r s t"), (4, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {(r.doc_id, r.component_id) for r in jaccard.components(docs, 3, 90).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}


# -- lines -----------------------------------------------------------------------------------------


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute_chunks(text):
    chunks, held, before = [], [], ""
    every = text.split("\n")
    for k, line in enumerate(every):
        held.append(line)
        h = md5(line)
        if h[0] in lines.LINE_ENDS or md5(before + h)[0] in lines.ROLLING_ENDS or k + 1 == len(every):
            chunks.append(held)
            held = []
        before = h
    return chunks


def row_key(i, text):
    """Where a row stands among all: rows without an id first, rows of one id by a signed hash of the text."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return (i is not None, i or 0, h - (1 << 64) if h >> 63 else h)


def brute_lines(rows):
    first = {}

    def units(key, chunks):
        """Chunks that are not blank and pairs of adjacent ones, with their place."""
        bodies = ["\n".join(c) for c in chunks]
        for k, body in enumerate(bodies):
            if body.strip(" \t\r\n"):
                yield (body,), (*key, k), len(chunks[k]) > 1
                if k + 1 < len(bodies) and bodies[k + 1].strip(" \t\r\n"):
                    yield (body, bodies[k + 1]), (*key, k), True

    for i, t in rows:
        for unit, at, _ in units(row_key(i, t or ""), brute_chunks(t or "")):
            first[unit] = min(first.get(unit, at), at)
    out = Counter()
    for i, t in rows:
        if t is None:
            out[(i, None, 0)] += 1
            continue
        chunks, gone = brute_chunks(t), set()
        for unit, at, counts in units(row_key(i, t), chunks):
            if counts and first[unit] != at:
                gone.update(range(at[-1], at[-1] + len(unit)))
        kept = ["\n".join(c) for k, c in enumerate(chunks) if k not in gone]
        out[(i, "\n".join(kept), sum(len(chunks[k]) for k in gone))] += 1
    return out


def test_line_chunks_equal_brute_force(spark):
    rng = random.Random(2)
    shared = [[sentence(rng, 5) for _ in range(rng.randint(3, 30))] for _ in range(6)]
    rows = []
    for i in range(80):
        own = [sentence(rng, 5) for _ in range(rng.randint(0, 10))]
        at = rng.randint(0, len(own))
        rows.append((rng.choice([i, i, i, None]), "\n".join(own[:at] + rng.choice(shared) * rng.randint(0, 2) + own[at:])))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = lines.without_repeats(docs).collect()
    assert Counter(tuple(r) for r in found) == brute_lines(rows)
    assert sum(r.n_lines_removed for r in found) > 100


def test_short_blocks_go_and_single_lines_stay(spark):
    """Of blocks of three lines few pairs of lines are left; a line that repeats alone stays."""
    rng = random.Random(5)
    blocks = [[prose(rng, 6) for _ in range(3)] for _ in range(40)]
    often = prose(rng, 5)
    rows = []
    for i in range(400):
        text = [prose(rng, 5), *rng.choice(blocks), prose(rng, 5), often, prose(rng, 6)]
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = lines.without_repeats(docs).collect()

    def repeats(texts):
        seen = Counter(p for t in texts for p in zip(t.split("\n"), t.split("\n")[1:]))
        return sum(n - 1 for n in seen.values())

    before = repeats(t for _, t in rows)
    assert before == 2 * 360
    assert repeats(r.text for r in found) < before / 5
    assert all(often in r.text for r in found)
    assert all({t.split("\n")[0], t.split("\n")[-1]} <= set(r.text.split("\n")) for (_, t), r in zip(rows, sorted(found, key=lambda r: r.doc_id)))


def test_every_line_stays_somewhere(spark):
    rng = random.Random(9)
    pool = [prose(rng, 4) for _ in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(300)]
    found = lines.without_repeats(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert Counter(tuple(r) for r in found) == brute_lines(rows)
    assert {x for r in found for x in r.text.split("\n")} - {""} == {x for _, t in rows for x in t.split("\n")}


@pytest.mark.parametrize("shared", [None, 7])
def test_lines_of_many_rows_under_one_id(spark, shared):
    """Rows of one id, or without one, are documents of their own: copied blocks go from all but one."""
    rng = random.Random(12)
    block = [prose(rng, 5) for _ in range(20)]
    rows = [(shared, "\n".join([prose(rng, 5), *block, prose(rng, 5)])) for _ in range(60)]
    found = lines.without_repeats(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert Counter(tuple(r) for r in found) == brute_lines(rows)
    assert sum("\n".join(block[5:15]) in r.text for r in found) == 1


def test_an_inserted_line_moves_only_chunks_next_to_it():
    rng = random.Random(6)
    every = [sentence(rng, 4) for _ in range(200)]
    before = {"\n".join(c) for c in brute_chunks("\n".join(every))}
    after = {"\n".join(c) for c in brute_chunks("\n".join([*every[:90], "new", *every[90:]]))}
    assert len(before - after) <= 2


def test_lines_of_odd_rows(odd, nothing):
    found = lines.without_repeats(odd)
    assert found.columns == [*odd.columns, "n_lines_removed"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter((r.doc_id, r.text, r.n_lines_removed) for r in found.collect()) == brute_lines(rows)
    assert lines.without_repeats(nothing).count() == 0


# -- passages --------------------------------------------------------------------------------------


def test_passages_go_from_all_but_one_document(spark):
    rng = random.Random(8)
    passages = [prose(rng, 55) for _ in range(12)]
    rows = [(k, f"{prose(rng, rng.randint(5, 80))} {passages[k % 12]} {prose(rng, 30)}") for k in range(60)]
    clean = [(100 + k, prose(rng, 150)) for k in range(40)]
    docs = spark.createDataFrame(rows + clean, "doc_id LONG, text STRING")
    found = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    for k, text in rows:
        if k < 12:
            assert found[k].text == text
        else:
            middle = passages[k % 12]
            assert middle[80:-80] not in found[k].text
            assert found[k].n_bytes_removed >= substrings.PASSAGE
            assert found[k].text.startswith(text[: text.index(middle)][:20])
    assert all(found[k].text == t for k, t in clean)


def brute_passages(rows):
    """The whole result by one walk through the documents in order, comparing chunks byte by byte."""
    table = substrings.gear_table()

    def key(i, t):
        return i if i is not None else (xxhash.xxh64_intdigest(t.encode(), seed=42) | 3 << 61) & ((1 << 63) - 1)

    def chunks(t):
        raw = t.encode()
        ends = substrings.chunk_ends(raw, table)
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    holders = defaultdict(set)
    for i, t in rows:
        for c in chunks(t or ""):
            holders[c].add(key(i, t or ""))
    out = Counter()
    for i, t in rows:
        if t is None:
            out[(i, None, 0)] += 1
            continue
        cut = chunks(t)
        again = [min(holders[c]) < key(i, t) or c in cut[:k] for k, c in enumerate(cut)]
        kept, k = [], 0
        while k < len(cut):
            e = k
            while e < len(cut) and again[e]:
                e += 1
            if sum(map(len, cut[k:e])) < substrings.PASSAGE:
                kept += cut[k:e]
            kept += cut[e : e + 1]
            k = e + 1
        text = b"".join(kept)
        out[(i, text.decode(), len(t.encode()) - len(text))] += 1
    return out


@pytest.mark.parametrize("without_id", [0, 3])
def test_passages_equal_brute_force(spark, without_id):
    """Shared passages, copies, repeats within a text; in the second case a third of the rows has no id."""
    rng = random.Random(11)
    passages = [prose(rng, rng.choice([10, 30, 55, 120])) for _ in range(15)]
    rows = []
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 40)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(0, 6))]
        rows.append((None if without_id and i % without_id == 0 else rng.choice([i, i, i, i // 10]), " ".join(parts)))
    rows += [rows[3], rows[4], (None, rows[5][1]), (None, None), (7, ""), (900, rows[9][1])]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert Counter(tuple(r) for r in found) == brute_passages(rows)
    assert sum(r.n_bytes_removed > 0 for r in found) > 40


def test_chunks_resist_an_insertion():
    rng = random.Random(3)
    text = prose(rng, 600).encode()
    table = substrings.gear_table()

    def chunks(raw):
        ends = substrings.chunk_ends(raw, table)
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    before, after = chunks(text), chunks(text[:1000] + b"inserted words " + text[1000:])
    assert b"".join(before) == text
    assert len(set(before) - set(after)) <= 4
    assert all(len(c) <= substrings.LONGEST for c in before)


def test_gear_is_the_rolling_hash():
    table, h = substrings.gear_table(), 0
    data = bytes(random.Random(1).randrange(256) for _ in range(500))
    rolled = []
    for b in data:
        h = (2 * h + int(table[b])) % (1 << 32)
        rolled.append(h)
    assert substrings.gear(np.frombuffer(data, dtype=np.uint8), table).tolist() == rolled


def test_repeats_within_one_text_and_characters_of_many_bytes(spark):
    rng = random.Random(4)
    passage = prose(rng, 60)
    thick = "漢字" * 400
    rows = [(1, f"{passage} {prose(rng, 20)} {passage}"), (2, thick), (3, "é" + thick), (4, "x" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert found[1].text.count(passage[100:200]) == 1
    assert found[1].text.startswith(passage)
    assert set(found[2].text) <= set(thick) and set(found[4].text) <= {"x"}


def test_passages_of_odd_rows(odd, nothing):
    found = substrings.without_repeats(odd)
    assert found.columns == [*odd.columns, "n_bytes_removed"]
    before = Counter((r.doc_id, r.text) for r in odd.collect() if r.doc_id != 9)
    assert Counter((r.doc_id, r.text) for r in found.collect() if r.doc_id != 9) == before
    assert substrings.without_repeats(nothing).count() == 0
