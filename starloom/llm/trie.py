"""Conversation prefix trie: conversations rebuilt on shared openings, and every prefix they share.

1. Turns become 128-bit digests; a conversation is the sequence of its digests, 16 bytes a turn.
   Equal sequences form one vertex, so copies of a conversation take part once.
2. Vertices are sorted by range, so that those that share a prefix stand together. Neighbours are
   edges, as deep as the prefix they share. Union-find takes the edges in descending depth: each merge
   makes, or widens, the branching node at its depth, and what is merged hangs below it by a chain of
   nodes with one child each.
3. What a partition cannot decide alone are the components that reach its first or last vertex. It is
   contracted to these, at most two a depth; the lists of neighbouring partitions are put end to end
   and merged by the same rule, a fixed number at a time, until one list is left.
4. Chains learn their parent's smallest member by a join, and are spelled out node by node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import scratch, stored

#: Bytes of a turn's digest.
WIDTH = 16
#: Lists of neighbouring partitions that are merged in one task.
FAN = 32
#: Ids of members that one row holds on their way to the digest.
IDS = 1_000

OPENING, FAMILY = 4, 20

_FOUND = pa.schema(
    [
        ("open", pa.bool_()),
        ("part", pa.int64()),
        ("place", pa.int64()),
        ("shared", pa.int64()),
        ("low", pa.int64()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved", pa.int64()),
        ("ends", pa.string()),
        ("key", pa.binary()),
        ("parent", pa.binary()),
        ("own", pa.binary()),
        ("words", pa.list_(pa.int64())),
    ]
)
_FOUND_SQL = (
    "open boolean, part long, place long, shared long, low long, depth long, conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved long, ends string, key binary, parent binary, own binary,"
    " words array<long>"
)


def rebuilt(conversations: DataFrame, folder: str) -> DataFrame:
    """conv_id, key (its turns' digests, end to end) and words (of each turn) of every rebuilt conversation.

    Turns of one conversation with equal turn numbers stand in the order of their digests.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        F.struct(
            conversations["turn"].cast("long").alias("turn"),
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
        ).alias("one"),
    )
    own = stored(
        turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns")), folder, "turns"
    )
    heads = own.where(f"conv_id % {FAMILY} = 0").select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, OPENING - 1).alias("opening")
    )
    length = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING
    joined = own.withColumn("family", F.expr(f"conv_id - conv_id % {FAMILY}")).join(heads, "family", "left")
    opening = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), F.lit(1), length.cast("int"))
    rest = F.slice("turns", (length + 1).cast("int"), F.greatest(F.size("turns"), F.lit(1)))
    whole = joined.select("conv_id", F.concat(opening, rest).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"),
        F.col("turns.words").alias("words"),
    )


def ids_digests(members: DataFrame) -> DataFrame:
    """Of (digest, conv_id): per digest n_convs, the smallest conv_id, and ends: SHA-256 of all, in order.

    Ids are sorted by range, so a digest that a third of the rows have is spread over tasks; each
    writes its ids into rows of at most a thousand. These pass through one task in order, which keeps
    the state of the hash alone.
    """

    def join(batches):
        for batch in batches:
            digests, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, first = [], 0
            for k in range(1, len(ids) + 1):
                if k == len(ids) or digests[k] != digests[first] or k - first == IDS:
                    rows.append((digests[first], ids[first], k - first, ",".join(map(str, ids[first:k]))))
                    first = k
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
                    names=["digest", "conv_id", "n_convs", "ids"],
                )

    def digest(batches):
        current, state, count, least = None, None, 0, None
        for batch in batches:
            rows = []
            for own, conv, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own != current:
                    if current is not None:
                        rows.append((current, least, count, state.hexdigest()))
                    current, state, count, least = own, hashlib.sha256(), 0, conv
                else:
                    state.update(b",")
                state.update(ids.encode())
                count += n
            yield from out(rows)
        if current is not None:
            yield from out([(current, least, count, state.hexdigest())])

    def out(rows):
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
                names=["digest", "conv_id", "n_convs", "ends"],
            )

    spread = members.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    pieces = spread.mapInArrow(join, "digest binary, conv_id long, n_convs long, ids string")
    gathered = pieces.repartition("digest").sortWithinPartitions("digest", "conv_id")
    return gathered.mapInArrow(digest, "digest binary, conv_id long, n_convs long, ends string")


class Component:
    """What is known of one node so far: its depth, members and what lies below it.

    key and words (in all, up to each depth) are those of a sequence through the node; an inner one of
    a contracted list has none, as it is merged with a neighbour of its own depth before it is needed.
    """

    __slots__ = ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "key", "words", "open")

    def __init__(self, depth, conv_id, n_convs, n_children, n_leaves, saved, ends, key, words):
        self.depth, self.conv_id, self.n_convs, self.n_children = depth, conv_id, n_convs, n_children
        self.n_leaves, self.saved, self.ends, self.key, self.words = n_leaves, saved, ends, key, words
        self.open = False

    def chain(self, depth: int) -> dict:
        """The nodes from here up to the child of the node at the given depth above."""
        return {
            "open": False,
            "low": depth + 1,
            "depth": self.depth,
            "conv_id": self.conv_id,
            "n_convs": self.n_convs,
            "n_children": self.n_children,
            "n_leaves": self.n_leaves if self.n_children else 1,
            "saved": self.saved,
            "ends": self.ends,
            "parent": hashlib.md5(self.key[: WIDTH * depth]).digest() if depth >= 0 else None,
            "own": hashlib.md5(self.key[: WIDTH * self.depth]).digest() if self.n_children else None,
            "words": self.words[max(depth, 0) : self.depth + 1].tolist() if depth >= 0 else [0, 0],
        }

    def hang(self, depth: int, chains: list[dict]) -> None:
        """Turn this into the node at a depth above, with the node it was as the only child."""
        if self.depth == depth:
            return
        chains.append(self.chain(depth))
        below = int(self.words[self.depth] - self.words[depth])
        self.saved += (self.n_convs - 1) * below
        self.n_leaves = self.n_leaves if self.n_children else 1
        self.n_children, self.depth, self.ends = 1, depth, None

    def widen(self, other: Component) -> None:
        """Take in another part of the same node."""
        self.conv_id = min(self.conv_id, other.conv_id)
        self.n_convs += other.n_convs
        self.n_children += other.n_children
        self.n_leaves += other.n_leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        self.open |= other.open
        if self.key is None:
            self.key, self.words = other.key, other.words


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two sequences have in common from their start."""
    n = min(len(a), len(b))
    if not n:
        return 0
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(differ.argmax()) if differ.any() else n) // WIDTH


def contract(
    parts: list[Component], edges: list[int], chains: list[dict], whole: bool
) -> tuple[list[Component], list[int]]:
    """Merge a list of components by its edges, edges[k] between parts k and k + 1, deepest first.

    A component that reaches an end of the list may still be merged deeper by a neighbour outside,
    unless the list is whole: it is left as it is. What borders on it hangs below the node at their
    edge, which is as open. Returns the components left and the edges between them.
    """
    for part in parts:
        part.open = False
    if not whole:
        parts[0].open = parts[-1].open = True
    root = list(range(len(parts)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    kept = []
    for k in sorted(range(len(edges)), key=lambda k: -edges[k]):
        depth, i, j = edges[k], find(k), find(k + 1)
        left, right = parts[i], parts[j]
        for one, other in ((left, right), (right, left)):
            if not one.open:
                one.hang(depth, chains)
        if left.depth == depth == right.depth:
            left.widen(right)
            root[j] = i
        else:
            left.open = right.open = left.open or right.open
            kept.append(k)
    heads, seen = [], set()
    for k in range(len(parts)):
        if (r := find(k)) not in seen:
            seen.add(r)
            heads.append(parts[r])
    return heads, [edges[k] for k in sorted(kept)]


def put_together(
    lists: list[tuple[list[Component], list[int]]], chains: list[dict], whole: bool
) -> tuple[list[Component], list[int]]:
    """Lists end to end, with an edge between each two, contracted."""
    parts, edges = [], []
    for own, between in lists:
        if parts and own:
            edges.append(shared_turns(parts[-1].key, own[0].key))
        parts += own
        edges += between
    return contract(parts, edges, chains, whole) if parts else (parts, edges)


def listed(parts: list[Component], edges: list[int], part: int) -> list[dict]:
    """A contracted list as rows; only its ends carry their sequences."""
    rows = []
    for k, x in enumerate(parts):
        end = k in (0, len(parts) - 1)
        row = {n: getattr(x, n) for n in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")}
        row |= {"open": True, "part": part, "place": k, "shared": edges[k] if k < len(edges) else None}
        rows.append(row | {"key": x.key if end else None, "words": x.words.tolist() if end else None})
    return rows


def rows_of(chains: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r.get(f.name) for r in chains], f.type) for f in _FOUND]
    return pa.RecordBatch.from_arrays(columns, schema=_FOUND)


def grow(batches):
    """Contract the sorted vertices of one partition, a batch at a time; out come chains, and the list left."""
    parts, edges, part = [], [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        fresh = []
        for key, words, conv, n, ends, part in zip(*columns):  # noqa: B007
            total = np.cumsum([0, *words])
            fresh.append(Component(len(words), conv, n, 0, 0, 0, ends, key, total))
        between = [shared_turns(a.key, b.key) for a, b in zip(fresh, fresh[1:])]
        chains = []
        parts, edges = put_together([(parts, edges), (fresh, between)], chains, whole=False)
        yield rows_of(chains)
    if parts:
        yield rows_of(listed(parts, edges, part))


def merged(whole: bool) -> Callable[[pa.Table], pa.Table]:
    """Merge the lists of neighbouring partitions; a whole one ends in the root."""

    def run(found: pa.Table) -> pa.Table:
        rows = sorted(found.to_pylist(), key=lambda r: (r["part"], r["place"]))
        lists = {}
        for r in rows:
            parts, edges = lists.setdefault(r["part"], ([], []))
            words = None if r["words"] is None else np.array(r["words"])
            parts.append(
                Component(r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"],
                          r["ends"], r["key"], words)
            )
            if r["shared"] is not None:
                edges.append(r["shared"])
        chains = []
        parts, edges = put_together(list(lists.values()), chains, whole)
        if whole:
            (top,) = parts
            top.hang(0, chains)
            chains.append(top.chain(-1))
        else:
            chains += listed(parts, edges, rows[0]["part"] // FAN)
        return pa.Table.from_batches([rows_of(chains)])

    return run


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Return one row per node of the trie of all rebuilt conversations, the textless root included.

    conv_id is the smallest member, parent_conv_id the parent's (null for the root), ends_sha256 the
    digest of the ascending ids that end at the node. Rows with a null conv_id take no part; a null role
    or text is empty, null turns come first, equal rows are turns of their own, and equal turn numbers
    are ordered by the digest of role and text. Columns beyond conv_id, turn, role and text are not read.
    An empty table has no nodes. A conversation's digests and word counts, 24 bytes a turn, are held as
    one row, its texts never are. Turns are compared by 128-bit digests.
    """
    folder = scratch(conversations.sparkSession)
    sequences = stored(rebuilt(conversations, folder), folder, "sequences")
    classes = ids_digests(sequences.select(F.unhex(F.md5("key")).alias("digest"), "conv_id"))
    vertices = classes.join(sequences, "conv_id").select("key", "words", "conv_id", "n_convs", "ends")
    vertices = stored(vertices, folder, "vertices")
    ordered = vertices.repartitionByRange("key").sortWithinPartitions("key")
    ordered = ordered.withColumn("part", F.spark_partition_id().cast("long"))
    found = [stored(ordered.mapInArrow(grow, _FOUND_SQL), folder, "forest-0")]
    while True:
        left = found[-1].where("open")
        most = left.agg(F.max("part")).first()[0]
        if most is None:
            break
        whole = most < FAN
        lists = left.groupBy(F.expr(f"part div {FAN}").alias("group"))
        found.append(stored(lists.applyInArrow(merged(whole), _FOUND_SQL), folder, f"forest-{len(found)}"))
    chains = found[0].where("not open")
    for more in found[1:]:
        chains = chains.union(more.where("not open"))
    branching = chains.where("own is not null").select(F.col("own").alias("parent"), F.col("conv_id").alias("above"))
    steps = F.posexplode(F.slice("words", F.lit(2), F.size("words") - 1)).alias("step", "_")
    nodes = chains.join(branching, "parent", "left").select("*", steps)
    last = F.col("low") + F.col("step") == F.col("depth")
    below = F.element_at("words", -1) - F.get("words", F.col("step"))
    return nodes.select(
        "conv_id",
        (F.col("low") + F.col("step")).alias("depth"),
        F.when(F.col("step") == 0, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * below).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends")), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
