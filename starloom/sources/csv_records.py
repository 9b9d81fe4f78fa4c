"""A split read of CSV files whose quoted fields hold line breaks.

Spark reads such a file in one task. Here its lines are read in blocks like those of any text file,
and records are put together where they lie. A line begins a record if the number of quotes before
it in its file is even, so a first pass, which moves numbers only, sums the quotes of each block; a
running sum over blocks tells which of them start inside a record. Only the fragments at the ends of
blocks are moved, to be joined with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLOCK = ["__file", "__block"]

#: Bytes of a record, at most; what is longer most likely lacks a quote.
LONGEST_RECORD = 64 << 20

#: Blocks whose ends are broadcast, at some 200 bytes each; 128 TB in blocks of 128 MB.
BROADCAST_BLOCKS = 1_000_000

#: A file is never cut into smaller blocks than this (Spark's cost of opening a file).
_SMALLEST_BLOCK = 4 << 20

_MEASURES = """__file string, __block long, __quotes long, __bytes long,
    __head long, __tail_even long, __tail_odd long, __line_even long, __line_odd long"""

_PIECES = "__file string, __block long, __of long, __first boolean, __text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, its block and its quotes, in the order of the file within a block."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.input_file_name().alias("__file"),
            F.input_file_block_start().alias("__block"),
            F.col("value").alias("__line"),
            F.length(F.regexp_replace("value", '[^"]', "")).cast("long").alias("__quotes"),
        )
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """The stretches of lines of one block, which the first two columns name."""
    if not batch.num_rows:
        return
    files = batch.column(0).dictionary_encode()
    codes = files.indices.to_numpy()
    blocks = batch.column(1).to_numpy()
    changes = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    ends = [*changes.tolist(), batch.num_rows]
    for a, b in zip([0, *ends], ends):
        yield (files.dictionary[codes[a]].as_py(), int(blocks[a])), a, b


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: what its ends are like if it starts outside a record, and if inside.

    __head: bytes before its first record, if it starts inside (null: none begins); __tail_*: bytes
    from the last line on that has an even or odd number of the block's quotes before it; __line_*:
    that line's number.
    """
    names = ["quotes", "bytes", "lines", "head", "even", "odd", "line_even", "line_odd"]

    def row(key, s):
        tail = {k: None if s[k] is None else s["bytes"] - s[k] for k in ("even", "odd")}
        values = [*key, s["quotes"], s["bytes"], s["head"], tail["even"], tail["odd"], s["line_even"], s["line_odd"]]
        kinds = [pa.string()] + [pa.int64()] * 8
        columns = [n.split()[0] for n in _MEASURES.split(",")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=columns)

    last, s = None, {}
    for batch in batches:
        quotes, sizes = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        for key, a, b in _runs(batch):
            if key != last:
                if last is not None:
                    yield row(last, s)
                last, s = key, dict.fromkeys(names)
                s["quotes"] = s["bytes"] = s["lines"] = 0
            odd = (s["quotes"] + np.cumsum(quotes[a:b]) - quotes[a:b]) & 1
            at = s["bytes"] + np.cumsum(sizes[a:b]) - sizes[a:b]
            for name, places in (("even", np.flatnonzero(odd == 0)), ("odd", np.flatnonzero(odd))):
                if len(places):
                    s[name] = int(at[places[-1]])
                    s[f"line_{name}"] = s["lines"] + int(places[-1]) + 1
                    if name == "odd" and s["head"] is None:
                        s["head"] = int(at[places[0]])
            s["quotes"] += int(quotes[a:b].sum())
            s["bytes"] += int(sizes[a:b].sum())
            s["lines"] += b - a
    if last is not None:
        yield row(last, s)


def _block_ends(lines: DataFrame, longest: int) -> DataFrame:
    """Blocks that start or end inside a record: __inside, __open, and __from, where the first one began.

    Fails on a record that is too long or never ends, with the place at which it begins.
    """
    size = (F.octet_length("__line") + 1).cast("long").alias("__size")
    measures = lines.select(*_BLOCK, "__quotes", size).mapInArrow(_measured, _MEASURES)
    in_file = Window.partitionBy("__file").orderBy("__block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__quotes").over(earlier), F.lit(0)) % 2 == 1
    tail = F.when(F.col("__inside"), F.struct("__tail_odd", "__line_odd")).otherwise(
        F.struct(F.col("__tail_even").alias("__tail_odd"), F.col("__line_even").alias("__line_odd"))
    )
    begins = ~F.col("__inside") | F.col("__head").isNotNull()
    placed = (
        measures.withColumn("__inside", inside)
        .withColumn("__open", ((F.col("__quotes") + F.col("__inside").cast("long")) % 2) == 1)
        .withColumn("__up_to", F.sum("__bytes").over(in_file))
        .withColumn("__tail", tail)
        .withColumn("__begun", F.when(begins, F.struct("__block", "__tail", "__up_to")))
        .withColumn("__before", F.last("__begun", ignorenulls=True).over(earlier))
        .withColumn("__ends", F.lead("__block").over(in_file).isNull())
    )
    of = F.when(F.col("__inside"), F.col("__before"))
    length = (
        of["__tail"]["__tail_odd"]
        + (F.col("__up_to") - F.col("__bytes") - of["__up_to"])
        + F.coalesce("__head", "__bytes")
    )
    never = F.coalesce("__begun", "__before")
    place = lambda begun: F.format_string(
        "the record that begins in line %d from byte %d of %s", begun["__tail"]["__line_odd"], begun["__block"], "__file"
    )
    checked = (
        F.when(F.col("__ends") & F.col("__open"), F.raise_error(F.concat(F.lit("CSV quote is never closed: "), place(never))))
        .when(length > longest, F.raise_error(F.concat(F.lit(f"CSV record of over {longest} bytes: "), place(of))))
        .otherwise(F.col("__inside"))
    )
    return (
        placed.select(*_BLOCK, checked.alias("__inside"), "__open", of["__block"].alias("__from"))
        .where("__inside or __open")
    )


def _pieces(fragments: bool, longest: int):
    """Of lines in order: the records that lie in one block, or the fragments at the ends of blocks.

    __first marks what begins a file, __of is the block in which the record begins. No text has a
    line feed at its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, inside, begun, fresh, quotes, held, size = None, False, None, False, 0, [], 0

        def out(key, texts, first):
            n, of = len(texts), begun if inside else key[1]
            flags = np.zeros(n, dtype=bool)
            flags[:1] = first
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * n, pa.string()),
                    pa.array([key[1]] * n, pa.int64()),
                    pa.array([of] * n, pa.int64()),
                    pa.array(flags),
                    texts,
                ],
                names=["__file", "__block", "__of", "__first", "__text"],
            )

        def fragment(key, first):
            return out(key, pa.array(["\n".join(held)], pa.string()), first)

        for batch in batches:
            counts, lines = batch.column(2).to_numpy(), batch.column(3)
            starts, origins = batch.column(4), batch.column(5)
            for key, a, b in _runs(batch):
                if key != last:
                    if held and fragments:
                        yield fragment(last, fresh)
                    last, inside, held, size = key, starts[a].as_py(), [], 0
                    quotes, fresh, begun = int(inside), key[1] == 0, origins[a].as_py()
                closed = np.flatnonzero((quotes + np.cumsum(counts[a:b])) % 2 == 0) + a
                quotes += int(counts[a:b].sum())
                ends = closed.tolist()
                if ends and (held or inside):  # what was open closes here
                    held += lines.slice(a, ends[0] + 1 - a).to_pylist()
                    if inside == fragments:
                        yield fragment(key, fresh and not inside)
                    fresh = fresh and inside
                    inside, held, size, a = False, [], 0, ends.pop(0) + 1
                if ends:
                    if not fragments:
                        begins = [a, *[e + 1 for e in ends[:-1]]]
                        if ends[-1] + 1 - a == len(ends):
                            texts = lines.slice(a, len(ends))
                        else:
                            whole = lines.slice(a, ends[-1] + 1 - a).to_pylist()
                            texts = pa.array(["\n".join(whole[x - a : y + 1 - a]) for x, y in zip(begins, ends)], pa.string())
                        yield out(key, texts, fresh)
                    fresh = False
                    a = ends[-1] + 1
                if a < b:
                    rest = lines.slice(a, b - a)
                    held += rest.to_pylist()
                    size += rest.nbytes
                    if size > longest:
                        raise ValueError(f"CSV record of over {longest} bytes in the block from byte {key[1]} of {key[0]}")
        if held and fragments:
            yield fragment(last, fresh)

    return run


def _few_blocks(spark: SparkSession, path: str) -> bool:
    """Whether the files have at most BROADCAST_BLOCKS blocks, by their number and total size."""
    files = spark.read.text(path)
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return len(files.inputFiles()) + size // _SMALLEST_BLOCK <= BROADCAST_BLOCKS


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, longest: int = LONGEST_RECORD
) -> DataFrame:
    """The records below a header line as columns of the schema; doubled quotes stand for one.

    A record ends at a line feed, or a carriage return and a line feed, outside quotes. One of more
    than `longest` bytes fails the read, and so does a quote that is never closed: both name the
    place. A value that does not fit the schema fails it too, and a file whose header is another.

    Lines are read three times: for their numbers of quotes, for the records that lie in one block,
    and, only in blocks with a fragment, for fragments. No whole block is shuffled. Beyond
    BROADCAST_BLOCKS blocks Spark may choose to join lines with blocks by a shuffle.
    """
    lines = _lines(spark, path)
    ends = _block_ends(lines, longest)
    held = F.broadcast(ends) if _few_blocks(spark, path) else ends
    columns = [*_BLOCK, "__quotes", "__line", F.coalesce("__inside", F.lit(False)).alias("__inside"), "__from"]

    whole = lines.join(held, _BLOCK, "left").select(*columns).mapInArrow(_pieces(False, longest), _PIECES)
    fragments = lines.join(held, _BLOCK).select(*columns).mapInArrow(_pieces(True, longest), _PIECES)
    stitched = fragments.groupBy("__file", "__of").agg(
        F.max("__first").alias("__first"),
        F.array_join(F.sort_array(F.collect_list(F.struct("__block", "__text")))["__text"], "\n").alias("__text"),
    )
    too_long = F.concat(F.lit(f"CSV record of over {longest} bytes in the block from byte "), "__of", F.lit(" of "), "__file")
    records = (
        whole.select("__file", "__of", "__first", "__text")
        .unionByName(stitched)
        .withColumn("__text", F.when(F.octet_length("__text") > longest, F.raise_error(too_long)).otherwise(F.col("__text")))
        .withColumn("__text", F.regexp_replace("__text", "\r$", ""))
        .where("__text <> ''")
    )
    options = {"escape": '"', "mode": "FAILFAST"}
    names = F.from_csv("__text", ", ".join(f"c{k} string" for k in range(len(schema))), options)
    expected = F.struct(*[F.lit(n).alias(f"c{k}") for k, n in enumerate(schema.names)])
    below_header = (
        F.when(~F.col("__first"), True)
        .when(names == expected, False)
        .otherwise(F.raise_error(F.lit(f"CSV header does not conform to the schema in {path}")))
    )
    records = records.where(below_header)
    columns = ", ".join(
        f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema
    )
    parsed = F.from_csv("__text", columns, options)
    return records.select(parsed.alias("__row")).select("__row.*")
