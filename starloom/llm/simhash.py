"""SimHash fingerprints, and near duplicates by multi-index hashing.

1. Every shingle of a text votes with the bits of its XXH64 hash; a fingerprint has the bits of the majority.
2. Equal fingerprints form one class, which takes part once.
3. Two fingerprints of 64 bits that differ in at most two differ in at most one bit of their upper half,
   or in none of their lower half. So the tables hold both halves of every fingerprint, and each
   fingerprint asks them for the Hamming ball of radius one around its upper half, and for its lower half.
4. What the tables return is held against the whole fingerprints. A table entry under which very many
   fingerprints stand is not gone through: there the ball is spelled out over the other half as well,
   and what is asked for are whole fingerprints, so the work stays in proportion to those that ask.
5. Components are the classes reached by links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, id_text, scratch, stored
from starloom.llm.jaccard import smallest_reachable

#: Words of a shingle, and the seed of its hash.
WORDS, SEED = 3, 42
#: Bits in which linked fingerprints may differ.
DISTANCE = 2
#: Bits of a segment.
HALF = 32
#: Fingerprints under one table entry that are still compared one by one.
ENTRY = 1_024
#: Shingles that are hashed and counted at a time.
BLOCK = 65_536


def fingerprint(text: str, words: int = WORDS) -> int:
    """The SimHash of the shingles of a text, repeats included, as a signed 64-bit number."""
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    width = min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(found) - width] + 1).tolist()]
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), BLOCK):
        hashes = [
            xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], stops[k : k + BLOCK])
        ]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts)).view(">u8")[0].astype(U64).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every row."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def ball(bits: range, radius: int) -> list[int]:
    """Masks of at most so many of the given bits, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in some) for n in range(radius + 1) for some in combinations(bits, n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near(fps: DataFrame, folder: str) -> DataFrame:
    """Pairs (x, y), x < y, of the distinct fingerprints fp that differ in at most two bits.

    Spark sizes a table that explode() has made as if it still had a row for each of those before, up to
    2,081 times too low, and would bring it to the driver to broadcast it. So these joins ask for a merge.
    """
    upper, lower = range(HALF, 2 * HALF), range(HALF)

    def entry(segment: int, fp: Column) -> Column:
        """The table key of a fingerprint's segment: 0 is the upper half, 1 the lower one."""
        half = F.shiftrightunsigned(fp, HALF) if segment == 0 else fp.bitwiseAND(F.lit((1 << HALF) - 1))
        return F.shiftleft(half, 1).bitwiseOR(F.lit(segment).cast("long"))

    fp = F.col("fp")
    held = fps.select("fp", F.explode(F.array(entry(0, fp), entry(1, fp))).alias("entry"))
    asked = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in ball(upper, 1)])).alias("mask")).select(
        "fp", "mask", entry(0, fp.bitwiseXOR(F.col("mask"))).alias("entry")
    )
    asked = asked.unionByName(fps.select("fp", F.lit(0).cast("long").alias("mask"), entry(1, fp).alias("entry")))
    sizes = held.groupBy("entry").agg(F.count("*").alias("size"))
    # its own entry is no match, if nothing else stands there
    asked = stored(asked.hint("merge").join(sizes, "entry").where("mask <> 0 or size > 1"), folder, "asked")

    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    pairs = (
        asked.where(f"size <= {ENTRY}")
        .select("entry", F.col("fp").alias("x"))
        .join(held.select("entry", F.col("fp").alias("y")).hint("merge"), "entry")
        .where((F.col("x") < F.col("y")) & (distance <= DISTANCE))
        .select("x", "y")
    )

    def spelled(rows: DataFrame, other: range, left: int) -> DataFrame:
        """Whole fingerprints in the ball: the mask of the segment, and what is left of the distance beyond it."""
        masks = F.explode(F.array(*[F.lit(m) for m in ball(other, left)])).alias("more")
        whole = F.col("fp").bitwiseXOR(F.col("mask")).bitwiseXOR(F.col("more"))
        return rows.select("fp", "mask", masks).select(F.col("fp").alias("x"), whole.alias("y")).where("x < y")

    large = asked.where(f"size > {ENTRY}")
    segment = F.col("entry").bitwiseAND(F.lit(1).cast("long"))
    balls = spelled(large.where((segment == 0) & (F.col("mask") != 0)), lower, DISTANCE - 1)
    balls = balls.union(spelled(large.where((segment == 0) & (F.col("mask") == 0)), lower, DISTANCE))
    balls = balls.union(spelled(large.where(segment == 1), upper, DISTANCE))
    there = balls.hint("merge").join(fps.select(F.col("fp").alias("y")), "y").select("x", "y")
    return pairs.union(there).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, fingerprint (16 hexadecimal digits) and component_id for every row.

    Rows link when their fingerprints differ in at most two bits; component_id is the smallest doc_id
    reachable by links. A text of fewer words than a shingle is one shingle; a null, empty or blank one has
    the fingerprint zero and links like any other. Rows with a null doc_id keep their fingerprint, have a
    null component_id and link nothing. Rows that repeat a doc_id are one vertex: links of each hold for it.
    Other columns are not read.
    """
    folder = scratch(docs.sparkSession)
    known = stored(fingerprints(docs, id_col, text_col), folder, "fingerprints")
    classes = known.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("class"))
    classes = stored(classes, folder, "classes")
    pairs = near(classes.select("fp"), folder)
    a = classes.select(F.col("fp").alias("x"), F.col("class").alias("a"))
    b = classes.select(F.col("fp").alias("y"), F.col("class").alias("b"))
    links = pairs.join(a, "x").join(b, "y").select("a", "b")
    # rows that share a doc_id are one vertex: their classes link with the class of its smallest fingerprint
    several = known.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    same = known.distinct().join(several, "doc_id").join(classes, "fp")
    least = classes.select(F.col("fp").alias("least"), F.col("class").alias("b"))
    same = same.join(least, "least").select(F.col("class").alias("a"), "b")
    label = smallest_reachable(links.union(same), folder)
    named = classes.join(label, F.col("class") == F.col("vertex"), "left").select(
        "fp", F.coalesce("label", "class").alias("reached")
    )
    return known.join(named, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("reached")).alias("component_id"),
    )
