"""N-gram Jaccard join by a token-group matrix, and the components its links form.

1. Texts with the same shingle set form one class; the class takes part once.
2. Shingles are ordered by how common they are, told by counters of a fixed number, and then by hash.
   The tokens of a set are its first ones in this order: so many that two sets similar enough must
   share several. A passage that many documents share comes late in the order and makes no tokens.
3. Similar sets are put in one group: those whose tokens mostly lead to the same smallest class, or to
   one that leads there. The matrix holds the union of each group's tokens. What a set shares with a group's union bounds what
   it can share with any member; only the groups where that is enough are opened for it.
4. In an opened group, the union of shingles that occur twice bounds each set's overlap with all the
   others; sets whose bound is too low are put aside, the rest are compared exactly, as products of
   0/1 matrices. Out come links that connect what is similar, not all pairs.
5. Components are the classes reached by links.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, id_filter, id_text, quoted, scratch, shingle_set, stored

#: Bytes of text that one chunk of a group holds, about; a larger group is split. So are the sets that ask it.
CHUNK_BYTES = 4_000_000
#: Sets that one chunk of a group, or of those that ask it, holds, about.
CHUNK_SETS = 1_000
#: Counters that tell common shingles from rare ones, and the blocks they are added up in.
COUNTERS, COUNTER_BLOCKS = 1 << 21, 64
#: Tokens beyond those of which one must be shared, per hundred shingles.
EXTRA = 5
#: Columns of the 0/1 matrices that are held at a time.
COLUMNS = 4096
#: Keys of rows without an id of their own lie beyond the ids, if those stay within this much of 0.
KEY_RANGE = 1 << 62


def commonness(docs: DataFrame, words: int, id_col: str, text_col: str) -> np.ndarray:
    """Per counter, how many sets hold a shingle that falls on it, in steps of two per cent.

    All shingles of all texts are counted. Shingles share counters, so a rare one may seem common;
    that changes the order of shingles, for all sets alike, and no result. Each task sends its
    counters once, and these are added up in two steps, in groups of bounded size.
    """
    width = COUNTERS // COUNTER_BLOCKS

    def run(batches):
        total = np.zeros(COUNTERS, dtype=np.int32)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                total[(shingle_set(text, words) & U64(COUNTERS - 1)).astype(np.int64)] += 1
        blocks = [zlib.compress(x.tobytes(), 1) for x in total.reshape(COUNTER_BLOCKS, width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(COUNTER_BLOCKS), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "counts"]
        )

    def add(found: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for x in found["counts"].to_pylist():
            total += np.frombuffer(zlib.decompress(x), dtype=np.int32)
        counts = zlib.compress(np.minimum(total, (1 << 31) - 1).astype(np.int32).tobytes(), 1)
        return pa.table({"block": found["block"][:1], "counts": pa.array([counts], pa.binary())})

    schema = "block int, counts binary"
    parts = id_text(docs, id_col, text_col).mapInArrow(run, schema)
    once = parts.groupBy("block", (F.spark_partition_id() % 64).alias("some")).applyInArrow(add, schema)
    rows = once.groupBy("block").applyInArrow(add, schema).orderBy("block").collect()
    if not rows:
        return np.zeros(COUNTERS, dtype=np.uint16)
    counts = np.concatenate([np.frombuffer(zlib.decompress(r.counts), dtype=np.int32) for r in rows])
    return (np.log2(counts + 1.0) * 32).astype(np.uint16)


def shared_at_least(n: int) -> int:
    """How many tokens two sets share at least if they link and neither has fewer than n shingles."""
    return 1 + n * EXTRA // 100


def first_tokens(shingles: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The shingles, rarest first, of which a set that links with this one has several among its own.

    Linked sets have at least m = ceil(percent * n / 100) shingles in common. Of any n - m + k first ones of
    either, in one order, at least k are in both.
    """
    n = len(shingles)
    if not n:
        return shingles
    level = common[(shingles & U64(COUNTERS - 1)).astype(np.int64)]
    return shingles[np.argsort(level, kind="stable")[: n - -(-n * percent // 100) + shared_at_least(n)]]


def profiles(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, n_bytes, the digest of the set (null: empty) and its tokens."""
    common = docs.sparkSession.sparkContext.broadcast(commonness(docs, words, id_col, text_col))

    def make(batch):
        texts = batch.column(1).to_pylist()
        sets = [shingle_set(x, words) for x in texts]
        tokens = [first_tokens(s, common.value, percent) for s in sets]
        ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
        values = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array(list(map(len, texts)), pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(ends, values),
            ],
            names=["doc_id", "n_shingles", "n_bytes", "digest", "tokens"],
        )

    schema = "doc_id long, n_shingles long, n_bytes long, digest binary, tokens array<long>"
    return id_text(docs, id_col, text_col).mapInArrow(lambda batches: map(make, batches), schema)


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the first set of the component it is in when sets of enough similarity are linked.

    A set whose overlap with the union of all others is below what any link needs stays alone.
    """
    root = np.arange(len(sets))
    kept = np.flatnonzero([len(s) > 0 for s in sets])
    while len(kept) > 1:
        owner = np.repeat(np.arange(len(kept)), [len(sets[k]) for k in kept])
        values, column = np.unique(np.concatenate([sets[k] for k in kept]), return_inverse=True)
        shared = np.bincount(column, minlength=len(values))[column] > 1
        overlap = np.bincount(owner[shared], minlength=len(kept))
        # a link needs 100 |X and Y| >= percent |X or Y| >= percent |X|
        opened = 100 * overlap >= percent * np.bincount(owner, minlength=len(kept))
        if opened.all():
            break
        kept = kept[opened]
    if len(kept) < 2:
        return root
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    n = np.array([len(sets[k]) for k in kept], dtype=np.int64)
    common = np.zeros((len(kept), len(kept)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for first in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        block = np.zeros((len(kept), COLUMNS), dtype=np.float32)
        block[owner[a:b], column[a:b] - first] = 1
        common += block @ block.T
    i = common.astype(np.int64)
    link = 100 * i >= percent * (n[:, None] + n[None, :] - i)
    place = np.arange(len(kept))
    for _ in range(len(kept)):  # each takes the smallest place among its neighbours until nothing moves
        lower = np.where(link, place[None, :], len(kept)).min(axis=1)
        lower = np.minimum(lower, place)
        lower = lower[lower]
        if (lower == place).all():
            break
        place = lower
    root[kept] = kept[place]
    return root


def chunks_for(sets: Column, n_bytes: Column) -> Column:
    """How many chunks so many sets of so many bytes in all are split into."""
    return F.greatest(F.ceil(sets / CHUNK_SETS), F.ceil(n_bytes / CHUNK_BYTES))


def smallest_reachable(links: DataFrame, folder: str) -> DataFrame:
    """Of links (a, b): every vertex as `vertex` with the smallest vertex it is connected to as `label`.

    Each round turns every vertex's neighbours into links to the smallest of them, as large-star and
    small-star steps; a hot vertex's links are combined before the shuffle. Rounds are written to the
    shared folder, and their number grows with the logarithm of the longest chain.
    """
    spark = links.sparkSession
    both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(both, folder, "links-0")
    step, before = 0, None
    while True:
        step += 1
        # large star: the larger neighbours of a vertex meet the smallest of all, itself included
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: the smaller neighbours of a vertex, and itself, meet the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        after = stored(after, folder, f"links-{step}")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        edges, before = after, mark
    heads = after.select(F.col("b").alias("vertex"), F.col("b").alias("label")).distinct()
    return after.select(F.col("a").alias("vertex"), F.col("b").alias("label")).union(heads)


def components(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return doc_id, n_shingles and component_id for every row.

    Two rows link when 100 * |common shingles| >= percent * |shingles of either|; component_id is the
    smallest doc_id reachable by links. A null, empty or blank text has no shingles and links with
    nothing; a text of fewer words than a shingle is one shingle. Rows with a null doc_id have a null
    component_id and link nothing. Rows that repeat a doc_id are one vertex: links of each hold for
    it. Other columns are not read. Shingles are compared by 64-bit hashes, sets by 128-bit digests.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    spark = docs.sparkSession
    folder = scratch(spark)
    known = stored(profiles(docs, words, percent, id_col, text_col), folder, "profiles")

    classes = known.where("doc_id is not null and digest is not null").groupBy("digest")
    classes = stored(classes.agg(F.min("doc_id").alias("class")), folder, "classes")
    members = stored(
        known.where("doc_id is not null").select("doc_id", "digest").join(classes, "digest").select("doc_id", "class"),
        folder,
        "members",
    )
    # one row of each class carries the tokens: that of the smallest doc_id, told by the digest
    tokens = known.join(classes, (known.digest == classes.digest) & (known.doc_id == classes["class"])).select(
        "class", F.explode("tokens").alias("token")
    )
    several = (
        tokens.groupBy("token")
        .agg(F.min("class").alias("lowest"), F.max("class").alias("highest"))
        .where("lowest < highest")
    )
    shared = stored(tokens.join(several.select("token", "lowest"), "token"), folder, "shared")

    votes = shared.groupBy("class", "lowest").agg(F.count("*").alias("votes"))
    lead = votes.groupBy("class").agg(F.max(F.struct("votes", -F.col("lowest"), "lowest")).alias("most"))
    sized = known.where("digest is not null").groupBy(F.col("doc_id").alias("class"))
    sized = sized.agg(F.max("n_bytes").alias("n_bytes"), F.min("n_shingles").alias("n"))
    # a linked set may have as few as percent of this one's shingles
    fewest = F.expr(f"(n * {percent} + 99) div 100")
    lead = lead.select("class", F.col("most.lowest").alias("lead"), F.col("most.votes").alias("votes"))
    lead = lead.join(sized, "class").withColumn("needed", 1 + F.floor(fewest * EXTRA / 100))
    lead = stored(lead, folder, "leads")
    # sets that share enough with their lead make families, and families are followed to their smallest class
    strong = lead.where("votes >= needed").select(F.col("class").alias("a"), F.col("lead").alias("b"))
    family = smallest_reachable(strong, f"{folder}/families")
    lead = lead.join(family, F.col("lead") == F.col("vertex"), "left").select(
        "class", "needed", "n_bytes", F.coalesce("label", "lead").alias("lead")
    )
    sizes = lead.groupBy("lead").agg(F.count("*").alias("sets"), F.sum("n_bytes").alias("bytes"))
    chunks = chunks_for(F.col("sets"), F.col("bytes"))
    groups = stored(
        lead.join(sizes, "lead").select(
            "class",
            F.xxhash64("lead", F.pmod(F.xxhash64("class"), chunks)).alias("group"),
            F.col("sets").alias("size"),
            "needed",
            "n_bytes",
        ),
        folder,
        "groups",
    )
    held = stored(shared.select("token", "class").join(groups, "class"), folder, "held")
    matrix = held.select("token", F.col("group").alias("other"), F.col("size").alias("other_size")).distinct()
    # of two groups, the smaller one's sets ask the larger one
    asks = (F.col("size") < F.col("other_size")) | (
        (F.col("size") == F.col("other_size")) & (F.col("group") < F.col("other"))
    )
    opens = (
        held.join(matrix, "token")
        .where(asks)
        .groupBy("class", "other")
        .agg(F.count("*").alias("common"), F.max("needed").alias("needed"), F.max("n_bytes").alias("n_bytes"))
        .where("common >= needed")
        .select("class", F.col("other").alias("group"), "n_bytes")
    )
    opens = stored(opens, folder, "opens")
    # its own group is opened for a set like any other: by the tokens that others of the group hold
    several = held.groupBy("token", "group").agg(F.count("*").alias("sets")).where("sets > 1")
    inside = (
        held.join(several, ["token", "group"])
        .groupBy("class")
        .agg(F.count("*").alias("common"), F.max("needed").alias("needed"))
        .where("common >= needed")
        .select("class", F.lit(True).alias("inside"))
    )
    # a group's sets meet each chunk of the sets that ask it
    asked = opens.groupBy("group").agg(chunks_for(F.count("*"), F.sum("n_bytes")).alias("chunks"))
    members_of = (
        groups.join(inside, "class", "left")
        .join(asked, "group", "left")
        .where("inside or chunks > 0")
        .select("class", "group", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks") - 1, F.lit(0)))).alias("part"))
    )
    asking = opens.join(asked, "group").select(
        "class", "group", F.pmod(F.xxhash64("class"), F.col("chunks")).alias("part")
    )
    placed = members_of.union(asking).select("class", "group", F.col("part").cast("long").alias("part"))
    placed = stored(placed, folder, "placed")
    in_units = id_filter(placed, "class")
    chosen = id_text(docs, id_col, text_col).where("doc_id is not null").where(in_units(F.col("doc_id")))
    chosen = chosen.join(placed.select("class").distinct(), F.col("doc_id") == F.col("class"), "left_semi")
    units = chosen.dropDuplicates().join(placed, F.col("doc_id") == F.col("class"))
    units = units.select("group", "part", "class", "text")

    def open_unit(found: pa.Table) -> pa.Table:
        ids = found.column("class").to_numpy()
        sets = [shingle_set(x, words) for x in found.column("text").to_pylist()]
        root = linked(sets, percent)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": ids[moved], "b": ids[root[moved]]})

    links = units.groupBy("group", "part").applyInArrow(open_unit, "a long, b long")
    # rows that share a doc_id are one vertex
    same = members.select(F.col("doc_id").alias("a"), F.col("class").alias("b"))
    label = smallest_reachable(links.union(same), folder)
    return (
        known.select("doc_id", "n_shingles")
        .join(label, F.col("doc_id") == F.col("vertex"), "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
    )


def row_keys(docs: DataFrame, folder: str, id_col: str = "doc_id") -> tuple[DataFrame, str, bool]:
    """The rows with a further column that tells them apart, its name, and whether it is more than the id.

    Rows whose id no other row has keep it as their key. Rows that share an id, or have none, are
    written once with keys that no id equals; a filter of fixed size picks them out, so a hot id
    is never gathered. If ids fill the range of 64 bits, all rows get new keys.
    """
    key = "row_key"
    while key in [c.lower() for c in docs.columns]:
        key += "_"
    own = docs[id_col].cast("long")
    ids = docs.select(own.alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))
    ids = stored(ids.where("n > 1 or doc_id is null").select("doc_id"), folder, "repeated")
    if ids.limit(1).count() == 0:
        return docs.withColumn(key, own), key, False
    ends = docs.agg(F.max(own).alias("top"), F.min(own).alias("low")).first()
    number = F.monotonically_increasing_id()
    if ends.top is None or (ends.top > KEY_RANGE and ends.low < -KEY_RANGE):
        return stored(docs.withColumn(key, number), folder, "rows"), key, True
    number = ends.top + 1 + number if ends.top <= KEY_RANGE else ends.low - 1 - number
    shared = id_filter(ids, "doc_id")
    others = stored(docs.where(shared(own)).withColumn(key, number), folder, "rows")
    return docs.where(~shared(own)).withColumn(key, own).union(others), key, True


def without_near_copies(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs, one of each group that links connect: that of the smallest doc_id, null last.

    Links are those of components(), but every row is a document of its own, whether its doc_id is null
    or repeated; of rows alike in that, any one stays. Rows without words link with nothing and stay. All
    columns are kept as they are, whatever their names.
    """
    folder = scratch(docs.sparkSession)
    rows, key, more = row_keys(docs, folder, id_col)
    found = components(rows, words, percent, key, text_col)
    columns = [quoted(c) for c in docs.columns]
    if not more:
        gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone"))
        return rows.join(gone, rows[key] == gone["gone"], "left_anti").select(*columns)
    named = rows.select(rows[key].alias("vertex"), rows[id_col].cast("long").alias("named"))
    first = F.min(F.struct(F.col("named").isNull(), "named", "vertex"))
    stays = (
        found.join(named, F.col("doc_id") == F.col("vertex"))
        .groupBy("component_id")
        .agg(first.getField("vertex").alias("stays"))
    )
    return rows.join(stays, rows[key] == stays["stays"], "left_semi").select(*columns)
