"""Substring dedup by content-defined chunks.

A gear hash rolls over a text's bytes and ends a chunk where its bits say so, at a word's end; text put
in or taken out moves the chunk ends next to it only. A chunk whose digest occurs in a document of a
smaller doc_id, or before in the same text, is a repeat. Repeats are removed where, one after the
other, they make up a passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_text, quoted, slices

#: Bytes of a chunk, at least and at most.
SHORTEST, LONGEST = 16, 128
#: A chunk ends at a word's end where these bits of the hash are 0: at one in four.
WORD_MASK = np.uint32(0xC0000000)
#: Within a word of over LONG_WORD bytes it ends at one character in sixteen.
INNER_MASK, LONG_WORD = np.uint32(0xF0000000), 32
#: Repeats in a row are removed from so many bytes on; about half of a passage of fifty words.
PASSAGE = 128


def gear_table(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + table[byte], so 32 bytes back count."""
    h = table[data]
    for k in (1, 2, 4, 8, 16):  # a sum of 2 k terms from two sums of k
        h[k:] = h[k:] + (h[:-k] << np.uint32(k)) if len(h) > k else h[k:]
    return h


def chunk_ends(raw: bytes, table: np.ndarray) -> list[int]:
    """Where the chunks of a text in UTF-8 end; no chunk ends within a character."""
    n = len(raw)
    if not n:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    h = gear(data, table)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.maximum.accumulate(np.where(space, np.arange(n), -1))
    ends = space & ((h & WORD_MASK) == 0)
    inner = (np.arange(n) - last > LONG_WORD) & ((h & INNER_MASK) == 0)
    inner[:-1] &= (data[1:] & 0xC0) != 0x80
    places = (np.flatnonzero(ends | inner) + 1).tolist()
    out, start = [], 0
    for p in [*places, n]:
        while p - start > LONGEST:
            cut = start + LONGEST
            while raw[cut] & 0xC0 == 0x80:
                cut -= 1
            out.append(cut)
            start = cut
        if p - start >= SHORTEST or p == n:
            if p > start:
                out.append(p)
            start = p
    return out


def chunk_digests(raw: bytes, ends: list[int]) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    return [digest(raw[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def without(text: str, gone: list[bytes], table: np.ndarray, passage: int) -> tuple[str, int]:
    """The text without passages of repeats, and the bytes removed. gone: digests that repeat an earlier document's."""
    raw = text.encode()
    ends = chunk_ends(raw, table)
    seen = set(gone)
    kept: list[bytes] = []
    run: list[bytes] = []
    size = removed = 0
    start = 0
    for end, digest in zip([*ends, -1], [*chunk_digests(raw, ends), None], strict=True):
        if digest in seen:
            run.append(raw[start:end])
            size += end - start
        else:
            if size >= passage:
                removed += size
            else:
                kept += run
            run, size = [], 0
            if digest is not None:
                seen.add(digest)
                kept.append(raw[start:end])
        start = end
    return (b"".join(kept).decode(), removed) if removed else (text, 0)


def document_key(doc_id: Column, text: Column) -> Column:
    """The doc_id; where it is null, a hash of the text among the largest values of a long, so that such rows are spread."""
    return F.coalesce(doc_id, F.xxhash64(text).bitwiseOR(F.lit(3 << 61)).bitwiseAND(F.lit((1 << 63) - 1)))


def repeated_digests(rows: DataFrame) -> DataFrame:
    """Of doc_id and text: document_key, and gone, its digests that occur under a smaller key."""

    def run(batches):
        table = gear_table()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, texts in slices(batch.column(1)):
                found = []
                for text in texts:
                    raw = text.encode()
                    found.append(set(chunk_digests(raw, chunk_ends(raw, table))))
                keys = np.repeat(ids[a : a + len(texts)], [len(x) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([d for x in found for d in x], pa.binary())], names=["key", "digest"]
                )

    keyed = rows.select(document_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    chunks = keyed.mapInArrow(run, "key long, digest binary")
    first = (
        chunks.groupBy("digest")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .where("first < last")
        .select("digest", "first")
    )
    return (
        chunks.join(first, "digest")
        .where("key > first")
        .groupBy("key")
        .agg(F.collect_set("digest").alias("gone"))
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """Return docs with all columns, the text without repeated passages, and n_bytes_removed (long).

    Of a chunk that several documents hold, the one of the smallest doc_id keeps it, and there its
    first place. A null or empty text stays as it is. Rows that repeat a doc_id count as one document:
    they do not remove each other's chunks. Rows without a doc_id come after all others (ids below
    3 * 2^61), in the order of a hash of their texts; only equal ones count as one document.
    Digests have 128 bits. A column n_bytes_removed of docs is replaced.
    """
    names = [c for c in docs.columns if c != "n_bytes_removed"]
    gone = repeated_digests(id_text(docs, id_col, text_col)).select(
        F.col("key").alias("_key"), F.col("gone").alias("_gone")
    )
    packed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in names]).alias("_row"),
        document_key(
            docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit(""))
        ).alias("_id"),
    )
    joined = packed.join(gone, F.col("_id") == F.col("_key"), "left")

    @F.arrow_udf("struct<text string, removed long>")
    def cut(texts: pa.Array, digests: pa.Array) -> pa.Array:
        table = gear_table()
        done = []
        for a, part in slices(texts):
            for t, g in zip(part, digests[a : a + len(part)].to_pylist(), strict=True):
                done.append((None, 0) if t is None else without(t, g or [], table, passage))
        return pa.StructArray.from_arrays(
            [pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            names=["text", "removed"],
        )

    done = joined.select("_row", cut(F.col(f"_row.{quoted(text_col)}").cast("string"), "_gone").alias("_cut"))
    columns = [F.col("_cut.text").alias(c) if c == text_col else F.col(f"_row.{quoted(c)}").alias(c) for c in names]
    return done.select(*columns, F.col("_cut.removed").alias("n_bytes_removed"))
