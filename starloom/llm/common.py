"""Reading tables, scratch tables in the shared folder, and word hashing."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as it stands in an expression, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, as doc_id and text; a null text is the empty one."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/starloom-{uuid.uuid4().hex}"


def stored(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """Write the frame once below the folder and read it back: what follows depends on files only."""
    path = f"{folder}/{name}"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Bytes of rows that go to Python at once, where rows are large.
BATCH_BYTES = 4 << 20


BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches_from_now(spark: SparkSession) -> None:
    """As small_batches(), for results that others run later; a size that the session has set already stays."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


@contextmanager
def small_batches(spark: SparkSession):
    """Within it, what is run hands rows to Python in batches of about 4 MB or one row, not 10,000 rows of any length.

    Both sides hold a batch whole, and the JVM's buffers for it stay with the executor.
    """
    before = spark.conf.get(BATCH_KEY, None)
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_KEY) if before is None else spark.conf.set(BATCH_KEY, before)


def slices(texts: pa.Array, limit: int = 1 << 20):
    """Parts of a column of texts, of so many bytes or one row beyond; so its rows are never all objects at once."""
    part = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(edges, edges[1:], strict=False):
        if a < b:
            yield a, texts[a:b].to_pylist()


def crc_mod(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased."""
    return np.fromiter(map(xxhash.xxh64_intdigest, text.encode().lower().split()), dtype=U64)


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of so many words; a shorter text is one shingle."""
    h = word_hashes(text)
    if not len(h):
        return h
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, dtype=U64)
    for k in range(width):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


#: Bits of an id filter; it is 4 MB large whatever it holds.
FILTER_BITS = 1 << 25


def id_filter(ids: DataFrame, column: str):
    """A test for the ids in a column: true for each of them and, by chance, for some others.

    It has a fixed size, so it can be broadcast to thin out rows before a join on the id; the join
    stays exact, and as the filter fills up, fewer rows are spared the shuffle.
    """
    spark = ids.sparkSession
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    words = (
        ids.select(bit.alias("bit"))
        .groupBy(F.expr("shiftright(bit, 6)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
        .toPandas()
    )
    held = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    held[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    shared = spark.sparkContext.broadcast(held.view(U64))

    @F.arrow_udf("boolean")
    def test(bits: pa.Array) -> pa.Array:
        at = bits.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((shared.value[at >> 6] >> (at & 63).astype(U64)) & U64(1) == 1)

    def holds(column: Column) -> Column:
        return test(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)))

    return holds
