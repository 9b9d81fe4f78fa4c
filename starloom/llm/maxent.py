"""A hashed maximum-entropy language model with a class-factored softmax.

log p(word | words before) = log p(class | features) + log p(word | class, features). The first factor is a
softmax over classes with a weight for each pair of class and hashed feature: the previous word, the
one before it (skipping one), and both together. The most frequent words are classes by themselves, other words share a
class by their ending. The second factor halves the words of a class by their hashes, again and again: each
half is a softmax over two, with a weight for each hashed pair of feature and place in the tree, so the same n-grams and
skips tell the words of a class apart. The few words of one leaf share it by their counts. Training starts from
counts; then each pass sums, over all training text, the gradient (what each feature observes less what the
model expects) and moves all weights along it, scaled by the curvature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, crc_mod, id_text, mixed, scratch, stored

#: Classes; the first OWN are words of their own (the first of them the end), the rest endings.
CLASSES, OWN = 32, 17
#: Hashed values of each of the three features.
BUCKETS = 4_096
#: Training passes after the first, their step, and the weight of the prior in a feature's counts.
PASSES, STEP, PRIOR = 1, 0.6, 20.0
#: The prior of a feature at a place in a tree, the ridge penalty, and the longest way of one weight in a pass.
WORD_PRIOR, RIDGE, REACH = 10.0, 10.0, 1.0
#: Most halvings of a class's words, and binary digits of the weights' table; both follow the training text up to these.
DEPTH, BITS = 7, 19
#: Most frequent words whose counts every task holds; the counts of all others are joined.
HEAD = 1 << 17
#: Added to a word's count, also to that of the one unknown word.
ADDED = 0.1
#: Bytes of text that are turned into tokens at a time.
CHUNK = 1 << 20
#: Tokens whose classes are scored at a time.
BLOCK = 1 << 13
#: Tokens whose ways down the trees are followed at a time.
WAYS = 1 << 14
#: Tasks that sum, at least, for each core, and files' parts in one of them beyond; what is summed grows by far less than the files.
SUMMING, SUMMING_A_CORE, PARTS = 32, 4, 8


class Tokens:
    """Turns texts into word ids, without a step per word.

    An id is a 64-bit polynomial hash of the word's bytes whose low five bits are the class of its ending.
    """

    def __init__(self, seed: int = 3) -> None:
        random = np.random.default_rng(seed)
        self.low = np.arange(256, dtype=np.uint8)
        self.low[65:91] += 32
        self.table = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.endings = random.integers(0, 1 << 16, (2, 256), dtype=np.int64)
        self.base = int(random.integers(1 << 60, 1 << 62)) * 2 + 1
        self.up = self.down = np.ones(1, dtype=U64)
        #: The end of a text; no word has this id, for a word's class is never 0.
        self.end = U64(0)

    def _powers(self, n: int) -> None:
        if n >= len(self.up):
            n = max(n + 1, CHUNK)
            self.up = np.full(n, self.base, dtype=U64)
            self.up[0] = 1
            self.up = np.cumprod(self.up, dtype=U64)
            self.down = np.full(n, pow(self.base, -1, 1 << 64), dtype=U64)
            self.down[0] = 1
            self.down = np.cumprod(self.down, dtype=U64)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all tokens, each text's words and then its end, and where each text begins; last, their number."""
        raw = [t.encode() for t in texts]
        data = self.low[np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)]
        self._powers(len(data))
        space = (data == 32) | ((data >= 9) & (data <= 13))
        starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
        ends = np.flatnonzero(space & np.r_[False, ~space[:-1]])
        sums = np.r_[U64(0), np.cumsum(self.table[data] * self.up[: len(data)], dtype=U64)]
        h = mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64))
        last, before = data[ends - 1], np.where(ends - starts > 1, data[ends - 2], 0)
        ending = OWN + (self.endings[0][last] + self.endings[1][before]) % (CLASSES - OWN)
        words = (h & ~U64(31)) | ending.astype(U64)
        edges = np.cumsum([0, *(len(r) + 1 for r in raw)])
        first = np.searchsorted(starts, edges)
        n = len(texts)
        begins = first + np.arange(n + 1)
        ids = np.empty(len(words) + n, dtype=U64)
        at = np.ones(len(ids), dtype=bool)
        at[begins[1:] - 1] = False
        ids[at] = words
        ids[~at] = self.end
        return ids, begins

    def batches(self, batch: pa.RecordBatch):
        """Row ranges of a batch of doc_id and text, with their tokens."""
        texts = batch.column(1).to_pylist()
        start = size = 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= CHUNK or k + 1 == len(texts):
                yield start, k + 1, *self.of(texts[start : k + 1])
                start, size = k + 1, 0


def contexts(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Rows of three hashes for each token: the previous word, the one before, both; beginnings are words too."""
    before = np.r_[U64(1), ids[:-1]]
    before[begins[:-1]] = U64(1)
    skip = np.r_[U64(2), before[:-1]]
    skip[begins[:-1]] = U64(2)
    both = mixed(before * U64(0x9E3779B97F4A7C15) + skip)
    return np.stack([mixed(before), mixed(skip + U64(0xABCDEF)), both])


def features(hashes: np.ndarray) -> np.ndarray:
    """The buckets of contexts(), each row's after those of the row before."""
    return (hashes % U64(BUCKETS)).astype(np.int64) + np.arange(3)[:, None] * BUCKETS


def classes(ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Each token's class; own: the sorted ids with classes of their own, and their classes."""
    place = np.minimum(np.searchsorted(own[0], ids), len(own[0]) - 1)
    return np.where(own[0][place] == ids, own[1][place].astype(np.int64), (ids & U64(31)).astype(np.int64))


class Trees:
    """The words of each class, halved by the bits of their ids; places in a tree are numbered as in a heap.

    inside: by class and leaf, the count of its words and what is added to them.
    """

    def __init__(self, inside: np.ndarray, bits: int) -> None:
        self.depth, self.bits = int(np.log2(inside.shape[1])), bits
        self.inside = np.log10(inside).ravel()
        whole = np.concatenate([np.zeros_like(inside), inside], axis=1)
        for place in range(inside.shape[1] - 1, 0, -1):
            whole[:, place] = whole[:, 2 * place] + whole[:, 2 * place + 1]
        half = np.zeros(inside.shape)  # log odds of a place's second half by the counts alone
        half[:, 1:] = np.log(whole[:, 3::2]) - np.log(whole[:, 2::2])
        self.half = half.ravel().astype(np.float32)

    def leaves(self, ids: np.ndarray, k: np.ndarray) -> np.ndarray:
        mask = U64((1 << self.depth) - 1)
        return (k << self.depth) + np.where(k < OWN, 0, ((ids >> U64(5)) & mask).astype(np.int64))

    def ways(self, ids: np.ndarray, k: np.ndarray, hashes: np.ndarray):
        """Blocks of the tokens that share their class: which, and by depth and token the place, whether its
        second half is taken, and for each context the weight that speaks for that.
        """
        if not self.depth:
            return
        shared = np.flatnonzero(k >= OWN)
        down = np.arange(self.depth)[:, None]
        for a in range(0, len(shared), WAYS):
            at = shared[a : a + WAYS]
            leaf = ((ids[at] >> U64(5)) & U64((1 << self.depth) - 1)).astype(np.uint32)
            place = (np.uint32(1) << down.astype(np.uint32)) | (leaf >> (self.depth - down).astype(np.uint32))
            place |= k[at].astype(np.uint32) << np.uint32(self.depth)
            second = (leaf >> (self.depth - 1 - down).astype(np.uint32)) & np.uint32(1) == 1
            spread = place * np.uint32(0x9E3779B1)
            weight = (hashes[:, None, at] >> U64(32)).astype(np.uint32) ^ spread
            weight *= np.uint32(0x85EBCA6B)
            weight >>= np.uint32(32 - self.bits)
            yield at, place, second, weight

    def chances(self, place: np.ndarray, weight: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The log odds of the second half at each place."""
        x = np.take(self.half, place)
        for w in weight:
            x += np.take(weights, w)
        return x


def scores_of_classes(f: np.ndarray, weights: np.ndarray, prior: np.ndarray):
    """Blocks of tokens: where each begins, and their classes' scores above the best one, classes by rows.

    weights has classes by rows too. A block's scores fit the processor's cache.
    """
    for a in range(0, f.shape[1], BLOCK):
        x = np.take(weights, f[0, a : a + BLOCK], axis=1)
        x += np.take(weights, f[1, a : a + BLOCK], axis=1)
        x += np.take(weights, f[2, a : a + BLOCK], axis=1)
        x += prior[:, None]
        x -= x.max(axis=0)
        yield a, x


def probabilities(f: np.ndarray, weights: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The softmax over classes, classes by rows and tokens by columns."""
    out = np.empty((CLASSES, f.shape[1]))
    for a, x in scores_of_classes(f, weights, prior):
        np.exp(x, out=x)
        x /= x.sum(axis=0)
        out[:, a : a + x.shape[1]] = x
    return out


def log_probabilities(f: np.ndarray, k: np.ndarray, weights: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The logarithm of each token's probability of its class k."""
    out = np.empty(f.shape[1])
    for a, x in scores_of_classes(f, weights, prior):
        n = x.shape[1]
        out[a : a + n] = x[k[a : a + n], np.arange(n)] - np.log(np.exp(x).sum(axis=0))
    return out


def summed(training: DataFrame, make, n: int) -> np.ndarray:
    """Sums of matrices of n rows of one number a class: one of each task, added up by row; the result has a fixed size."""
    names = [f"c{k}" for k in range(CLASSES)]

    def run(batches):
        total = make(batches)
        rows = np.flatnonzero(total.any(axis=1))
        for a in range(0, len(rows), BLOCK):
            part = rows[a : a + BLOCK]
            columns = [pa.array(part.astype(np.int32)), *(pa.array(c.astype(float)) for c in total[part].T)]
            yield pa.RecordBatch.from_arrays(columns, names=["f", *names])

    cores = training.sparkSession.sparkContext.defaultParallelism
    tasks = max(SUMMING, SUMMING_A_CORE * cores, training.rdd.getNumPartitions() // PARTS)
    parts = training.coalesce(tasks).mapInArrow(run, "f int, " + ", ".join(f"{c} double" for c in names))
    rows = parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    out = np.zeros((n, CLASSES))
    out[rows["f"].to_numpy(dtype=np.int64)] = rows[names].to_numpy()
    return out


def climbed(weights: np.ndarray, seen: np.ndarray, expected: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights after a step along the gradient of the penalised likelihood, each scaled by its curvature.

    n: how often each weight's feature occurs, of which it was seen to hold, and expected to hold, so often.
    """
    gradient = seen - expected - RIDGE * weights
    curvature = expected * np.maximum(1 - expected / np.maximum(n, 1), 0) + RIDGE
    return weights + STEP * np.clip(gradient / curvature, -REACH, REACH)


def train(
    training: DataFrame, own: np.ndarray, prior: np.ndarray, trees: Trees
) -> tuple[np.ndarray, np.ndarray]:
    """Weights by feature and class, and the trees' weights. prior: the share of each class in the training text.

    What a model without weights expects follows from counts alone, and gives the weights to start with; later
    passes compute it from the model.
    """
    sc = training.sparkSession.sparkContext
    base = sc.broadcast((own, np.log(prior).astype(np.float32), trees))
    size = 1 << trees.bits
    cells = 3 * BUCKETS * CLASSES

    def observed(batches):
        own, _, trees = base.value
        tokens, total, found = Tokens(), np.zeros(cells), np.zeros((3, size))
        for batch in batches:
            for _, _, ids, begins in tokens.batches(batch):
                hashes, k = contexts(ids, begins), classes(ids, own)
                total += np.bincount((features(hashes) * CLASSES + k).ravel(), minlength=cells)
                for _, place, second, weight in trees.ways(ids, k, hashes):
                    even = np.broadcast_to(1 / (1 + np.exp(-np.take(trees.half, place))), weight.shape)
                    found[0] += np.bincount(weight.ravel(), minlength=size)
                    found[1] += np.bincount(weight[:, second].ravel(), minlength=size)
                    found[2] += np.bincount(weight.ravel(), weights=even.ravel(), minlength=size)
        return np.concatenate([total, found.ravel()]).reshape(-1, CLASSES)

    found = summed(training, observed, (cells + 3 * size) // CLASSES).ravel()
    seen = found[:cells].reshape(-1, CLASSES)
    often, second, even = found[cells:].reshape(3, size)
    n = seen.sum(axis=1, keepdims=True)
    weights = STEP * np.log((seen + PRIOR * prior) / (n * prior + PRIOR * prior))
    # a weight that no token of the training text asks stays 0
    share = np.where(often > 0, even / np.maximum(often, 1), 0.5)
    more = np.log((second + WORD_PRIOR * share) / (even + WORD_PRIOR * share))
    less = np.log((often - second + WORD_PRIOR * (1 - share)) / (often - even + WORD_PRIOR * (1 - share)))
    words = STEP * (more - less)
    for _ in range(PASSES):
        now = sc.broadcast((by_class(weights), words.astype(np.float32)))

        def expect(batches, now=now):
            (own, logs, trees), (by_feature, by_place) = base.value, now.value
            tokens, total, chosen = Tokens(), np.zeros((CLASSES, 3, BUCKETS)), np.zeros(size)
            for batch in batches:
                for _, _, ids, begins in tokens.batches(batch):
                    hashes, k = contexts(ids, begins), classes(ids, own)
                    f = features(hashes)
                    p = probabilities(f, by_feature, logs)
                    for kind in range(3):
                        bucket = f[kind] - kind * BUCKETS
                        for c in range(CLASSES):
                            total[c, kind] += np.bincount(bucket, weights=p[c], minlength=BUCKETS)
                    for _, place, _, weight in trees.ways(ids, k, hashes):
                        chance = 1 / (1 + np.exp(-trees.chances(place, weight, by_place)))
                        every = np.broadcast_to(chance, weight.shape).ravel()
                        chosen += np.bincount(weight.ravel(), weights=every, minlength=size)
            return np.concatenate([total.reshape(CLASSES, -1).T.ravel(), chosen]).reshape(-1, CLASSES)

        expected = summed(training, expect, (cells + size) // CLASSES).ravel()
        weights = climbed(weights, seen, expected[:cells].reshape(-1, CLASSES), n)
        words = climbed(words, second, expected[cells:], often)
    return weights, words


def by_class(weights: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(weights.T, dtype=np.float32)


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0
) -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row.

    Learns from rows whose crc32(doc_id as text) mod folds is not held_fold. Tokens are the words between
    ASCII white space, A-Z lower-cased, and one end for each text; a null or empty text is the end
    alone. base_score is the sum of log10((c + 0.1) / (N + 0.1 (V + 1))); score is the model's log10
    probability, in which one unknown word of each leaf of a class's tree counts 0.1. Null doc_ids are scored, not learned
    from, and not held out; rows that repeat a doc_id are scored one by one. Without training text all
    words are unknown and the model's classes are equally likely.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    rows = id_text(docs, id_col, text_col)
    training = rows.where(crc_mod(F.col("doc_id"), folds) != held_fold)

    def count(batches):
        tokens = Tokens()
        for batch in batches:
            found = [ids for _, _, ids, _ in tokens.batches(batch)]
            if found:
                ids, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n)], names=["id", "n"])

    counts = stored(
        training.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")), folder, "counts"
    )
    # by class of endings: how many words, and how often; bounded by the number of classes
    endings = counts.groupBy(F.expr("id & 31").alias("k")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    total, kinds = sum(r.n for r in endings), sum(r.v for r in endings)
    # counts by size, in at most 520 steps, tell from which on the words are few enough to hold
    step = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("v")).orderBy(F.desc("step")).collect()
    least, held = 1 << 20, 0
    for r in sizes:
        if held + r.v > HEAD:
            break
        least, held = r.step, held + r.v
    head = counts.where(step >= least).toPandas().sort_values(["n", "id"], ascending=[False, True])
    top = [int(i) for i in head["id"] if i != 0][: OWN - 1]
    own_ids = np.array([0, *top], dtype=np.int64).view(U64)
    order = np.argsort(own_ids)
    own = np.stack([own_ids[order], order.astype(U64)])

    c = dict(zip(head["id"].tolist(), head["n"].tolist(), strict=True))
    mass = np.zeros(CLASSES)
    for r in endings:
        mass[r.k] += r.n
    for k, i in enumerate([0, *top]):
        n = c.get(i, 0)
        if i:
            mass[i & 31] -= n
        mass[k] = n
    prior = (mass + 1) / (mass + 1).sum()
    # trees and tables as large as the words and tokens they tell apart, up to a bound
    depth = min(DEPTH, int(np.ceil(np.log2(max(1, kinds / (CLASSES - OWN))))))
    bits = min(BITS, max(12, int(total or 0).bit_length()))
    leaf = F.expr(f"(id & 31) * {1 << depth} + (shiftrightunsigned(id, 5) & {(1 << depth) - 1})")
    held = counts.where(~F.col("id").isin([0, *top])).groupBy(leaf.alias("leaf"))
    held = held.agg((F.sum("n") + ADDED * F.count("*")).alias("inside")).toPandas()
    # one unknown word of each leaf; a class of its own has one word and no unknown one
    inside = np.full((CLASSES, 1 << depth), ADDED)
    inside.ravel()[held["leaf"].to_numpy(dtype=np.int64)] += held["inside"].to_numpy(dtype=float)
    inside[:OWN] = (mass + ADDED)[:OWN, None]
    trees = Trees(inside, bits)
    weights, by_place = np.zeros((3 * BUCKETS, CLASSES)), np.zeros(1 << bits)
    if total:
        weights, by_place = train(training, own, prior, trees)

    ordered = head.sort_values("id")
    shared = spark.sparkContext.broadcast(
        {
            "own": own,
            "prior": np.log(prior).astype(np.float32),
            "weights": by_class(weights),
            "trees": trees,
            "by_place": by_place.astype(np.float32),
            "ids": ordered["id"].to_numpy(dtype=np.int64),
            "logs": np.log10(ordered["n"].to_numpy(dtype=float) + ADDED),
        }
    )

    def score(batches):
        m, tokens = shared.value, Tokens()
        ids_held, logs = m["ids"], m["logs"]
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b, ids, begins in tokens.batches(batch):
                hashes, k, trees = contexts(ids, begins), classes(ids, m["own"]), m["trees"]
                model = log_probabilities(features(hashes), k, m["weights"], m["prior"])
                for at, place, second, weight in trees.ways(ids, k, hashes):
                    chance = trees.chances(place, weight, m["by_place"])
                    model[at] -= np.logaddexp(0, np.where(second, -chance, chance)).sum(axis=0)
                model = model / np.log(10) - trees.inside[trees.leaves(ids, k)]
                signed = ids.view(np.int64)
                if len(ids_held):
                    place = np.minimum(np.searchsorted(ids_held, signed), len(ids_held) - 1)
                    known = ids_held[place] == signed
                    words = np.where(known, logs[place], 0.0)
                else:
                    known, words = np.zeros(len(ids), dtype=bool), np.zeros(len(ids))
                rest = ~known
                edges = np.r_[0, np.cumsum(rest)][begins].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(key, key + b - a)),
                        batch.column(0)[a:b],
                        pa.array(np.diff(begins)),
                        pa.array(np.add.reduceat(known.astype(np.int64), begins[:-1])),
                        pa.array(np.add.reduceat(words, begins[:-1])),
                        pa.array(np.add.reduceat(model, begins[:-1])),
                        pa.ListArray.from_arrays(edges, signed[rest]),
                    ],
                    names=["key", "doc_id", "n_tokens", "n_held", "words", "model", "rest"],
                )
                key += b - a

    schema = "key long, doc_id long, n_tokens long, n_held long, words double, model double, rest array<long>"
    found = stored(rows.mapInArrow(score, schema), folder, "scores")
    asked = found.select("key", F.explode("rest").alias("id")).groupBy("id", "key").agg(F.count("*").alias("t"))
    joined = (
        asked.join(counts, "id", "left")
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("t")).otherwise(0)).alias("more_known"),
            F.sum(F.col("t") * F.log10(F.coalesce("n", F.lit(0)) + ADDED)).alias("more_words"),
        )
    )
    words = F.col("words") + F.coalesce("more_words", F.lit(0.0))
    return found.join(joined, "key", "left").select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), folds) == held_fold, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_held") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.log10(F.lit(total + ADDED * (kinds + 1)))).alias("base_score"),
        (words + F.col("model")).alias("score"),
    )
