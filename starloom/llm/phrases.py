"""Collocations by set-oriented relational mining.

1. The words of all pieces are written once as a relation of occurrences, sorted by piece and position:
   a row is a block of whole pieces of one language, its words in order as places in a list of the
   block's words.
2. Phrases of k words are the occurrences of k - 1 words merge-joined with those at the next position of
   the same piece. They are counted in each block and then by group, the groups being 64-bit hashes.
3. Semi-join: occurrences whose group is frequent are written as the next relation, without the words that
   no frequent phrase holds, and extended by the next word. The frequent groups are told by a filter of
   fixed size, which lets through all of them and by chance some others. What was let through is counted
   once more, by its words, so counts are exact.
4. Scores are decimals of 38 digits, and the frequent groups give the counts of both parts of every cut.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import U64, mixed, scratch, small_batches, stored

#: What ends a piece, and the language of rows without one.
ENDS, UNKNOWN = re.compile("[.,;:!?\n-\r]"), "und"
#: Bytes of text of a block, about, and blocks that a task fills at a time.
BLOCK_BYTES, BLOCKS = 4_000_000, 2
#: Counts of groups that a task holds before it hands them on.
HELD = 1_000_000
#: Bits of a group's hash, and of its part that the filter of frequent groups has a bit for: 8 MB whatever it holds.
HASH_BITS, FILTER_BITS = 40, 26
#: Occurrences for which groups are dealt to one more range of hashes.
RANGE = 1_000_000
#: Parts that a language's candidates are ranked in before they are ranked together.
SALTS = 16

_RELATION = "lang string, vocabulary binary, codes binary, starts binary, n long"
_ROW = pa.schema(
    [
        ("lang", pa.string()),
        ("vocabulary", pa.binary()),
        ("codes", pa.binary()),
        ("starts", pa.binary()),
        ("n", pa.int64()),
    ]
)


def cut_texts(text: str):
    """A text as runs of whole pieces of about a block's size."""
    first = 0
    while len(text) - first > BLOCK_BYTES:
        end = ENDS.search(text, first + BLOCK_BYTES)
        if end is None:
            break
        yield text[first : end.end()]
        first = end.end()
    yield text[first:]


def row(lang: str, words: pa.Array, codes: np.ndarray, starts: np.ndarray | None) -> pa.RecordBatch:
    """A row of a relation: words in order, as places in a list, -1 between pieces or for words left out.

    starts tells by a bit for each place where an occurrence starts; null stands for every word.
    """
    small = zstandard.ZstdCompressor(level=1).compress
    n = int((codes >= 0).sum())
    vocabulary = "\n".join(words.to_pylist()).encode()
    bits = None if starts is None else small(np.packbits(starts).tobytes())
    columns = [lang, small(vocabulary), small(codes.tobytes()), bits, n]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(columns, _ROW)], schema=_ROW)


def block(lang: str, texts: list[str]) -> pa.RecordBatch:
    """The row of the words of some texts. Every word is an occurrence."""
    joined = pc.ascii_lower(pa.array(["\n", *texts], pa.large_string()))
    spaced = pc.replace_substring_regex(joined, "[.,;:!?\n-\r]", " . ")
    spaced = pc.binary_join_element_wise(spaced, *[pa.scalar(x, pa.large_string()) for x in (".", " ")])
    words = pc.split_pattern(pc.replace_substring(spaced, "\t", " "), " ").flatten().dictionary_encode()
    held = words.dictionary
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    codes = codes[codes != pc.index(held, "").as_py()]
    return row(lang, *kept_words(held, np.where(codes == pc.index(held, ".").as_py(), np.int32(-1), codes)), None)


def kept_words(words: pa.Array, codes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words that occur in codes, and codes as places among them."""
    there = np.zeros(len(words), dtype=bool)
    there[codes[codes >= 0]] = True
    place = np.cumsum(there, dtype=np.int32) - 1
    return words.filter(pa.array(there)), np.where(codes >= 0, place[codes], np.int32(-1))


def without_rest(words: pa.Array, codes: np.ndarray, starts: np.ndarray, size: int):
    """Words, codes and starts (as bits) without the words that no phrase of so many words at the starts holds."""
    held = np.zeros(len(codes), dtype=bool)
    for k in range(size):
        held[starts + k] = True
    codes = np.where(held, codes, np.int32(-1))
    bits = np.zeros(len(codes), dtype=bool)
    bits[starts] = True
    stay = held | np.concatenate([[False], held[:-1]])  # one -1 after every run
    return *kept_words(words, codes[stay]), bits[stay]


def occurrences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The relation of single words."""

    def run(batches):
        held, size, total = {}, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in cut_texts(text.as_py()):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part)
                    total += len(part)
                    if size[lang] >= BLOCK_BYTES:
                        yield block(lang, held.pop(lang))
                        total -= size.pop(lang)
                    elif total >= BLOCKS * BLOCK_BYTES:
                        yield from (block(x, texts) for x, texts in held.items())
                        held, size, total = {}, {}, 0
        yield from (block(x, texts) for x, texts in held.items())

    chosen = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    return chosen.mapInArrow(run, _RELATION)


def blocks_of(batch: pa.RecordBatch):
    """The rows of a relation: language, words, codes and the sorted places where occurrences start."""
    large = zstandard.ZstdDecompressor().decompress
    for lang, vocabulary, codes, starts, _ in zip(*batch.columns):
        words = pa.array(large(vocabulary.as_buffer()).decode().split("\n"), pa.string())
        codes = np.frombuffer(large(codes.as_buffer()), np.int32)
        if starts.is_valid:
            bits = np.frombuffer(large(starts.as_buffer()), np.uint8)
            starts = np.flatnonzero(np.unpackbits(bits, count=len(codes)))
        else:
            starts = np.flatnonzero(codes >= 0)
        yield lang.as_py(), words, codes, starts


def extended(starts: np.ndarray, length: int) -> np.ndarray:
    """Merge-join of sorted starts with those one position on: where phrases of one more word start.

    A phrase and the one that starts a word later lie in one piece, as each holds whole words of it.
    """
    there = np.zeros(length + 1, dtype=bool)
    there[starts] = True
    return starts[there[starts + 1]]


def grouped(n_words: int, codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct phrases at the starts, as a list of first, second, ... words, and how often each occurs."""
    group, spelled = codes[starts].astype(np.int64), [np.arange(n_words)]
    for k in range(1, size):
        group = group * n_words + codes[starts + k]
        if k < size - 1:
            values, group = np.unique(group, return_inverse=True)
            spelled = [x[values // n_words] for x in spelled] + [values % n_words]
    values, n = np.unique(group, return_counts=True)
    if size == 1:
        return [values], n
    return [x[values // n_words] for x in spelled] + [values % n_words], n


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """64-bit hashes of words in a language."""
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()), U64, len(words))


def groups(spelled: list[np.ndarray]) -> np.ndarray:
    """The groups of phrases: hashes of the hashes of their first, second, ... words."""
    code = mixed(spelled[0])
    for more in spelled[1:]:
        code = mixed(code * U64(0x9E3779B97F4A7C15) + more)
    return (code >> U64(64 - HASH_BITS)).astype(np.int64)


def summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by group, in order."""
    code, n = (np.concatenate(x) for x in zip(*counts))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[len(code) > 0], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(n, first) if len(first) else n


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers, compressed byte by byte of their eight."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def frequent_groups(relation: DataFrame, size: int, least: int, log: int):
    """The filter of groups of so many words that occur often enough, to be read by tasks.

    The relation has the occurrences of phrases of one word less. Counts are summed within each task and dealt
    out by 2**log ranges of groups; each range makes its part of the filter.
    """
    filter_bits, hash_bits = FILTER_BITS, HASH_BITS

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for lang, words, codes, starts in blocks_of(batch):
                starts = extended(starts, len(codes)) if size > 1 else starts
                spelled, n = grouped(len(words), codes, starts, size)
                hashes = word_hashes(lang, words)
                held.append((groups([hashes[x] for x in spelled]), n))
                rows += len(n)
                if rows >= HELD:
                    yield dealt(*summed(held))
                    held, rows = [], 0
        if held:
            yield dealt(*summed(held))

    def dealt(code, n):
        cuts = np.searchsorted(code, np.arange(1 << log) << (hash_bits - log)).tolist()
        found = [(k, a, b) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(code)])) if a < b]
        columns = [
            pa.array([k for k, _, _ in found], pa.int64()),
            pa.array([packed(np.diff(code[a:b], prepend=0)) for _, a, b in found], pa.binary()),
            pa.array([packed(n[a:b]) for _, a, b in found], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["range", "codes", "counts"])

    def gathered(found: pa.Table) -> pa.Table:
        pairs = zip(found["codes"].to_pylist(), found["counts"].to_pylist())
        code, n = summed([(np.cumsum(unpacked(c)), unpacked(f)) for c, f in pairs])
        place = found["range"][0].as_py()
        bits = np.zeros(1 << (filter_bits - log), dtype=bool)
        bits[(code[n >= least] >> (hash_bits - filter_bits)) - (place << (filter_bits - log))] = True
        held = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())
        return pa.table({"range": found["range"][:1], "bits": pa.array([held], pa.binary())})

    counts = relation.mapInArrow(run, "range long, codes binary, counts binary")
    parts = counts.groupBy("range").applyInArrow(gathered, "range long, bits binary").collect()
    shared, width = np.zeros(1 << (filter_bits - 3), dtype=np.uint8), 1 << (filter_bits - 3 - log)
    for r in parts:
        bits = zstandard.ZstdDecompressor().decompress(bytes(r["bits"]))
        shared[r["range"] * width : (r["range"] + 1) * width] = np.frombuffer(bits, np.uint8)
    return relation.sparkSession.sparkContext.broadcast(shared)


def frequent_occurrences(relation: DataFrame, size: int, shared) -> DataFrame:
    """The relation of phrases of so many words whose group the filter holds, from that of one word less."""
    shift = HASH_BITS - FILTER_BITS

    def run(batches):
        for batch in batches:
            for lang, words, codes, starts in blocks_of(batch):
                starts = extended(starts, len(codes)) if size > 1 else starts
                hashes = word_hashes(lang, words)
                bit = groups([hashes[codes[starts + k]] for k in range(size)]) >> shift
                starts = starts[(shared.value[bit >> 3] >> (7 - (bit & 7))) & 1 == 1]
                if len(starts):
                    yield row(lang, *without_rest(words, codes, starts, size))

    return relation.mapInArrow(run, _RELATION)


def phrase_counts(relation: DataFrame, size: int, least: int, log: int) -> DataFrame:
    """lang, phrase and f of the phrases of so many words that start where a relation says, if frequent.

    Like groups, they are summed within each task and dealt out, language by language, in 2**log ranges.
    """
    shift = HASH_BITS - log

    def run(batches):
        held, rows = {}, 0
        for batch in batches:
            for lang, words, codes, starts in blocks_of(batch):
                spelled, n = grouped(len(words), codes, starts, size)
                hashes = word_hashes(lang, words)
                parts = [words.take(pa.array(x)) for x in spelled]
                phrases = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
                place = groups([hashes[x] for x in spelled]) >> shift
                held.setdefault(lang, []).append(pa.table({"range": place, "phrase": phrases, "f": n}))
                rows += len(n)
                if rows >= HELD:
                    for x, tables in held.items():
                        yield dealt(x, tables)
                    held, rows = {}, 0
        for x, tables in held.items():
            yield dealt(x, tables)

    def dealt(lang, tables):
        found = pa.concat_tables(tables)
        if len(tables) > 1:
            found = found.group_by(["range", "phrase"]).aggregate([("f", "sum")]).rename_columns(["range", "phrase", "f"])
        place = found["range"].to_numpy()
        order = np.argsort(place, kind="stable")
        place, n, phrases = place[order], found["f"].to_numpy()[order], found["phrase"].take(pa.array(order))
        cuts = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(place)]
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            spelled = "\n".join(phrases[a:b].to_pylist()).encode()
            rows.append((lang, int(place[a]), zstandard.ZstdCompressor(level=1).compress(spelled), packed(n[a:b])))
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "range", "phrases", "counts"])

    def gathered(found: pa.Table) -> pa.Table:
        held = []
        for phrases, counts in zip(found["phrases"].to_pylist(), found["counts"].to_pylist()):
            spelled = zstandard.ZstdDecompressor().decompress(phrases).decode().split("\n")
            held.append(pa.table({"phrase": pa.array(spelled, pa.string()), "f": unpacked(counts)}))
        total = pa.concat_tables(held).group_by("phrase").aggregate([("f", "sum")])
        total = total.filter(pc.greater_equal(total["f_sum"], least))
        lang = pa.array([found["lang"][0].as_py()] * len(total), pa.string())
        return pa.table({"lang": lang, "phrase": total["phrase"], "f": total["f_sum"]})

    parts = relation.mapInArrow(run, "lang string, range long, phrases binary, counts binary")
    return parts.groupBy("lang", "range").applyInArrow(gathered, "lang string, phrase string, f long")


def frequent_phrases(docs: DataFrame, longest: int, least: int, folder: str, text_col: str, lang_col: str) -> DataFrame:
    """lang, size, phrase and f of all phrases of up to so many words that occur often enough; n of the language."""
    relation = stored(occurrences(docs, text_col, lang_col), folder, "words")
    totals, found = relation.groupBy("lang").agg(F.sum("n").alias("n")), None
    n = relation.agg(F.sum("n")).first()[0] or 0
    log = min(max(4, (n // RANGE).bit_length()), FILTER_BITS - 3)
    for size in range(1, longest + 1):
        relation = frequent_occurrences(relation, size, frequent_groups(relation, size, least, log))
        # written for the last size too, or counting would keep a second Python worker beside each task's
        relation = stored(relation, folder, f"occurrences-{size}")
        frequent = phrase_counts(relation, size, least, log).withColumn("size", F.lit(size))
        frequent = stored(frequent, folder, f"frequent-{size}")
        found = frequent if found is None else found.unionByName(frequent)
    return found.join(totals, "lang")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, first: int = 2_000,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Return the best phrases of two to so many words in every language: lang, rank, phrase, a, l, r, n, score.

    A phrase scores a * a / (l * r) millionths at its worst cut, a, l and r being the occurrences of the
    phrase and its two parts. Phrases are left out if a longer one holds at least half of their occurrences.
    Texts are lower-cased from A to Z; a null or empty text has no words, a null language is `und`, copies of
    a row count like other rows, and ties are in the order of the phrase's bytes. Other columns are not read.
    """
    spark = docs.sparkSession
    if longest < 2 or least < 1:
        raise ValueError("phrases have at least two words and occur at least once")
    folder = scratch(spark)
    with small_batches(spark):
        known = frequent_phrases(docs, longest, least, folder, text_col, lang_col)
    longer = known.where("size > 1").withColumn("words", F.split("phrase", " "))
    inside = F.expr(
        "explode(flatten(transform(sequence(2, size - 1), k ->"
        " transform(sequence(1, size - k + 1), i -> array_join(slice(words, i, k), ' ')))))"
    )
    around = longer.where("size > 2").select("lang", inside.alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "n", F.expr(
        "explode(transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS head,"
        " array_join(slice(words, k + 1, size), ' ') AS tail)))"
    ).alias("cut")).select("lang", "phrase", "a", "n", "cut.*")
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = "decimal(38,0)"
    a, l, r = (F.col(c).cast(exact) for c in "alr")
    score = F.expr("x div y")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("x", (F.lit(1_000_000).cast(exact) * a * a).cast(exact))
        .withColumn("y", (l * r).cast(exact))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst"))
        .join(around, ["lang", "phrase"], "left")
        .where("most is null or 100 * most < 50 * a")
        .select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    best = scored.withColumn("salt", salt).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
