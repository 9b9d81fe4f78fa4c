"""Best-fit packing of tokenised documents by minimum bin slack.

Documents become pieces of at most one sequence. How many pieces there are of each length is a
table of at most `capacity` rows whatever the corpus, so the packing is planned on it: per bin, a
subset-sum dynamic program over the lengths still available, kept as bits of one integer, finds the
fullest combination; it is used as often as the counts allow and then removed. The plan names, per
length, which ranks go where, so every piece finds its place by its rank among equal lengths.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.bpe import SPLIT, Automaton, chunks, load
from starloom.llm.common import id_text, scratch, stored

#: Pieces of one length are ranked in groups of about so many.
RANKED_TOGETHER = 2_000
#: Fixed value: tiktoken fails on runs of white space of about ten times as many characters.
LONG_RUN = 100_000
SPACES = re.compile(r"\s+")


def has_long_run(text: str) -> bool:
    """Whether the text has a run of white space that tiktoken's splitting may have no stack for."""
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in SPACES.finditer(text))


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return doc_id, piece, start, length, ids_crc32: every row's tokens, and end_id, in pieces of at most capacity.

    A text of more tokens is cut so that only its first piece is shorter than capacity. A null or
    empty text has the end token only; without end_id it has no piece. Texts with very long runs of
    white space are encoded by the automaton, all others by tiktoken; the tokens are the same.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spec = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        labels, special = spec.value["labels"], spec.value["special"]
        encoding = tiktoken.Encoding(
            "vocabulary",
            pat_str=SPLIT,
            mergeable_ranks={x: i for i, x in enumerate(labels) if x and i not in special.values()},
            special_tokens=special,
        )
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

        def encode(text):
            if not has_long_run(text):
                return encoding.encode_to_numpy(text, allowed_special="all")
            if "automaton" not in spec.value:
                spec.value["automaton"] = Automaton(spec.value)
            return spec.value["automaton"].encode(text)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                rows = []
                for doc_id, text in zip(ids[a:b], texts[a:b], strict=True):
                    tokens = np.concatenate([encode(text), end])
                    tokens = tokens.astype("<u4")
                    first = len(tokens) % capacity or min(capacity, len(tokens))
                    edges = [0, *range(first, len(tokens) + 1, capacity)]
                    for k in range(len(edges) - 1 if len(tokens) else 0):
                        x, y = edges[k], edges[k + 1]
                        rows.append((doc_id, k, x, y - x, zlib.crc32(tokens[x:y].tobytes())))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), *[pa.int64()] * 3], strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Of (length, count), longest first: the uses of each length that fill the room best.

    Among equally full choices, the one whose lengths come earliest in the list.
    """
    reached = 1
    layers = []
    for length, count in available:
        count = min(count, room // length)
        part = 1
        while count:
            part = min(part, count)
            count -= part
            layers.append((length, part, reached))
            reached |= (reached << length * part) & ((1 << room + 1) - 1)
            part *= 2
            if reached >> room & 1:
                break
        if reached >> room & 1:
            break
    left = reached.bit_length() - 1
    uses: dict[int, int] = {}
    for length, part, before in reversed(layers):
        if not before >> left & 1:
            uses[length] = uses.get(length, 0) + part
            left -= length * part
    return uses


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first bin, uses in a bin, place in the bin) that pack all counted pieces.

    Every bin takes the longest piece left and the combination of others that leaves the least slack.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left, reverse=True)
    given = dict.fromkeys(order, 0)
    bins, out = 0, []
    while order:
        lead = order[0]
        available = [(n, left[n] - (n == lead)) for n in order if n <= capacity - lead]
        uses = fullest([x for x in available if x[1]], capacity - lead)
        uses[lead] = uses.get(lead, 0) + 1
        times = min(left[n] // u for n, u in uses.items())
        at = 0
        for n in sorted(uses, reverse=True):
            out.append((n, given[n], bins, uses[n], at))
            at += n * uses[n]
            given[n] += times * uses[n]
            left[n] -= times * uses[n]
        bins += times
        order = [n for n in order if left[n]]
    out.sort()
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def pack(found: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to the rows of pieces(); sequences are gapless and hold at most capacity tokens.

    Repeated rows are packed one by one; no rows give no rows.
    """
    spark = found.sparkSession
    found = stored(found, scratch(spark), "pieces")
    counts = found.groupBy("length").agg(F.count("*").alias("pieces"))
    # At most `capacity` rows.
    counted = {r.length: r.pieces for r in counts.collect()}
    if not counted:
        return found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    known = spark.createDataFrame(
        [(n, -(-c // RANKED_TOGETHER)) for n, c in counted.items()], "length long, groups long"
    )
    salted = found.join(F.broadcast(known), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("groups"))
    )
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(before, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    )
    planned = spark.sparkContext.broadcast(plan(counted, capacity))

    def run(batches):
        rows = planned.value
        keys = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            at = rows[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            k = rank - at[:, 1]
            place = [pa.array(at[:, 2] + k // at[:, 3]), pa.array(at[:, 4] + k % at[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *place], names=[*batch.schema.names[:5], "sequence_id", "offset"]
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, capacity: int = 2048, end_id: int | None = 0) -> DataFrame:
    return pack(pieces(docs, path, capacity, end_id), capacity)
