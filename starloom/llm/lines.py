"""Line dedup over content-defined chunks of lines, in DataFrame functions only.

A chunk ends after a line if that line's hash or the rolling hash over it and the previous line's hash
says so, so an inserted line moves no boundary but its neighbours'. What occurs again, anywhere, and
has several lines is removed: a chunk of several lines, or two adjacent chunks of any number. Its
first occurrence (smallest doc_id, then text hash, then place) stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_text, quoted

#: A chunk ends where a line's hash or the rolling hash begins with one of these hexadecimal digits.
LINE_ENDS = ("0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "a", "b")
ROLLING_ENDS = ("0", "1", "2", "3")

#: What tells documents apart: the id and a hash of the text, so that rows that share an id, or have none, are spread.
_ROW = ["doc_id", "row"]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once a row however often it is used, inside lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def line_chunks(text: Column) -> Column:
    """A text's chunks of lines in order, as structs of n_lines and body.

    The bodies joined by line feeds are the text.
    """

    def ends(hashes: Column) -> Column:
        def here(i: Column) -> Column:
            own = F.get(hashes, i)
            before = F.when(i > 0, F.get(hashes, i - 1)).otherwise("")
            return (
                (i == F.size(hashes) - 1)
                | F.substring(own, 1, 1).isin(*LINE_ENDS)
                | F.substring(F.md5(F.concat(before, own)), 1, 1).isin(*ROLLING_ENDS)
            )

        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), here)

    def cut(lines: Column, ends: Column) -> Column:
        def chunk(end: Column, k: Column) -> Column:
            start = F.when(k > 0, F.get(ends, k - 1) + 1).otherwise(0)
            n = end - start + 1
            return F.struct(n.alias("n_lines"), F.array_join(F.slice(lines, start + 1, n), "\n").alias("body"))

        return F.transform(ends, chunk)

    return bound(
        F.split(text, "\n", -1),
        lambda lines: bound(bound(F.transform(lines, F.md5), ends), lambda places: cut(lines, places)),
    )


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """Of doc_id and text: doc_id, row (hash of the text) and `gone`, the places of the chunks to remove in order.

    Blank chunks do not count. Chunks with one digest are compared byte by byte: should the least and
    the greatest body differ, all of them stay. Pairs of adjacent chunks are told by their digests,
    which then stand for their bytes.
    """
    chunks = (
        rows.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(line_chunks(F.col("text"))).alias("place", "chunk"))
        .where("trim(BOTH ' \t\r\n' FROM chunk.body) <> ''")
        .select(
            *_ROW,
            "place",
            F.unhex(F.md5("chunk.body")).alias("digest"),
            (F.col("chunk.n_lines") > 1).alias("several"),
            F.col("chunk.body").alias("body"),
        )
    )
    here = F.struct(*_ROW, "place")
    repeated = (
        chunks.groupBy("digest")
        .agg(
            F.count("*").alias("n"),
            F.min(here).alias("first"),
            F.min("body").alias("least"),
            F.max("body").alias("greatest"),
        )
        .where("n > 1 and least = greatest")
        .select("digest", "first")
    )
    held = (
        chunks.select(*_ROW, "place", "digest", "several")
        .join(repeated, "digest")
        .groupBy(*_ROW)
        .agg(
            F.sort_array(
                F.collect_set(F.struct("place", "digest", "several", (~here.eqNullSafe(F.col("first"))).alias("later")))
            ).alias("held")
        )
    )
    unit = lambda place, left, right: F.struct(place.alias("place"), left.alias("left"), right.alias("right"))
    # of two adjacent chunks of several lines, each goes by itself
    pairs = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("held") - 1),
            lambda k: (F.get("held", k + 1)["place"] == F.get("held", k)["place"] + 1)
            & ~(F.get("held", k)["several"] & F.get("held", k + 1)["several"]),
        ),
        lambda k: unit(F.get("held", k)["place"], F.get("held", k)["digest"], F.get("held", k + 1)["digest"]),
    )
    # what goes by itself has no right side, and is dealt out by its row
    alone = F.transform(
        F.filter("held", lambda c: c["several"] & c["later"]),
        lambda c: unit(c["place"], F.unhex(F.hex("row")), F.lit(None).cast("binary")),
    )
    units = held.select(*_ROW, F.inline(F.concat(pairs, alone)))
    first = (
        units.where("right is not null")
        .groupBy("left", "right")
        .agg(F.count("*").alias("n"), F.min(here).alias("first"))
        .where("n > 1")
        .select("left", "right", "first")
    )
    both = F.when(F.col("right").isNull(), F.array("place")).otherwise(F.array(F.col("place"), F.col("place") + 1))
    return (
        units.join(first, ["left", "right"], "left")
        .where(F.col("right").isNull() | (F.col("first").isNotNull() & ~here.eqNullSafe(F.col("first"))))
        .select(*_ROW, F.explode(both).alias("place"))
        .groupBy(*_ROW)
        .agg(F.sort_array(F.collect_set("place")).alias("gone"))
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return docs with all columns, the text without repeated chunks, and n_lines_removed (long).

    Lines end at line feeds. A null or empty text stays as it is. Rows that repeat a doc_id and text
    hold the same occurrences: what is first in one is first in all. Rows of one doc_id and different texts
    are different documents, and so are rows without one, which come before all others. What is
    kept of a text stays in order, joined by line feeds; a text of which every chunk is removed becomes
    empty. A column n_lines_removed of docs is replaced.
    """
    gone = repeated_chunks(id_text(docs, id_col, text_col)).select(
        F.col("doc_id").alias("_gone_id"), F.col("row").alias("_gone_row"), F.col("gone").alias("_gone")
    )
    kept_names = [c for c in docs.columns if c != "n_lines_removed"]
    packed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in kept_names]).alias("_row"),
        docs[id_col].cast("long").alias("_id"),
        F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("_hash"),
    )
    joined = packed.join(
        gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_row")), "left"
    )
    text = F.col(f"_row.{quoted(text_col)}").cast("string")
    # whether each chunk goes, up to the last that does
    flags = lambda places: F.flatten(
        F.transform(
            places,
            lambda p, k: F.concat(
                F.array_repeat(F.lit(False), p - F.coalesce(F.get(places, k - 1), F.lit(-1)) - 1), F.array(F.lit(True))
            ),
        )
    )
    goes = lambda gone, k: F.coalesce(F.get(gone, k), F.lit(False))
    count = lambda chunks: F.aggregate(chunks, F.lit(0).cast("long"), lambda n, c: n + c["n_lines"])
    rest = lambda chunks, gone: F.struct(
        F.array_join(F.filter(chunks, lambda c, k: ~goes(gone, k))["body"], "\n").alias("text"),
        count(F.filter(chunks, lambda c, k: goes(gone, k))).alias("n"),
    )
    # where nothing goes, there is nothing to split
    touched = F.when(
        F.col("_gone").isNotNull(),
        bound(line_chunks(text), lambda chunks: bound(flags(F.col("_gone")), lambda gone: rest(chunks, gone))),
    )
    done = joined.select("_row", "_gone", touched.alias("_rest")).select(
        "_row",
        F.when(F.col("_gone").isNull(), text).otherwise(F.col("_rest.text")).alias("_text"),
        F.coalesce("_rest.n", F.lit(0)).alias("n_lines_removed"),
    )
    columns = [F.col("_text").alias(c) if c == text_col else F.col(f"_row.{quoted(c)}").alias(c) for c in kept_names]
    return done.select(*columns, "n_lines_removed")
