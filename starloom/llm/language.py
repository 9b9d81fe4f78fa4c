"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A document is parsed, from left to
right, into the longest pieces that occur in that text; a language whose text resembles the document
needs few pieces. The language with the fewest pieces per character, weighted by what a piece costs to
name, wins.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import crc_mod, id_text

#: Characters of labelled text that each language's automaton is built from, at most.
SAMPLE_CHARS = 30_000
#: Texts are parsed side by side in lanes of so many characters.
LANE = 256
#: Characters that get a symbol of their own; letters beyond them share one.
SYMBOLS = 62
#: Lanes that are parsed together.
LANES = 100_000
#: The label of a text without a letter.
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def lowered(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)


def symbols(codes: np.ndarray, letters: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Letters as symbols; any run of other characters as one symbol 0."""
    out = np.where(letters[codes], table[codes], 0).astype(np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def suffix_automaton(text: np.ndarray, width: int) -> np.ndarray:
    """Transitions, states by symbols, of the automaton of all substrings of the text; -1 where there is none."""
    size = 2 * len(text) + 2
    step = np.full((size, width), -1, dtype=np.int32)
    link, depth = [-1], [0]
    last, states = 0, 1
    for c in text.tolist():
        new = states
        states += 1
        depth.append(depth[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and step[p, c] < 0:
            step[p, c] = new
            p = link[p]
        if p >= 0:
            q = int(step[p, c])
            if depth[p] + 1 == depth[q]:
                link[new] = q
            else:
                copy = states
                states += 1
                depth.append(depth[p] + 1)
                link.append(link[q])
                step[copy] = step[q]
                while p >= 0 and step[p, c] == q:
                    step[p, c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step[:states]


def phrases(step: np.ndarray, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many longest matches each lane is parsed into; a symbol that occurs nowhere is a piece of its own.

    lanes holds symbols column by column, and lanes are ordered by falling size.
    """
    width = step.shape[1]
    flat = step.ravel()
    state = np.zeros(lanes.shape[1], dtype=np.int32)
    count = np.zeros(lanes.shape[1], dtype=np.int32)
    for k in range(len(lanes)):
        n = int(np.searchsorted(-sizes, -k, side="left"))  # lanes longer than k
        if not n:
            break
        c = lanes[k, :n]
        to = flat[state[:n] * width + c]
        broken = np.flatnonzero(to < 0)
        if len(broken):
            count[broken] += state[broken] > 0
            again = flat[c[broken]]
            count[broken] += again < 0
            to[broken] = np.maximum(again, 0)
        state[:n] = to
    return count + (state > 0)


def learn(training: DataFrame, letters: np.ndarray, sample_chars: int = SAMPLE_CHARS) -> dict:
    """Symbols and automata by language, from rows of doc_id, lang and text. Languages are taken to be few.

    Each language's rows are thinned by hash to about four times the sample before they come to the
    driver, and a row brings sample_chars characters at most; the text used is theirs in order of the hash.
    """
    order = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    sized = training.select("lang", F.substring("text", 1, sample_chars).alias("text"), order.alias("order"))
    totals = sized.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("n"))
    # A row for each language, each of which gets an automaton on the driver anyway.
    thinned = totals.select(
        "lang",
        F.least(F.lit(1.0), F.greatest(F.lit(4.0 * sample_chars) / F.col("chars"), F.lit(30.0) / F.col("n"))).alias("share"),
    )
    taken = sized.join(F.broadcast(thinned), "lang").where(F.col("order") < F.col("share") * (1 << 30))
    rows = sorted(taken.collect(), key=lambda r: (r.lang, r.order, r.text))
    texts: dict[str, list[np.ndarray]] = {}
    room: dict[str, int] = {}
    for r in rows:
        left = room.setdefault(r.lang, sample_chars)
        codes = lowered(r.text)[:left]
        room[r.lang] = left - len(codes)
        texts.setdefault(r.lang, []).append(np.r_[codes, np.uint32(32)])
    held = {lang: np.concatenate(x) for lang, x in sorted(texts.items())}
    table = np.full(0x110000, SYMBOLS + 1, dtype=np.uint8)
    if held:
        seen, n = np.unique(np.concatenate(list(held.values())), return_counts=True)
        seen, n = seen[letters[seen]], n[letters[seen]]
        common = seen[np.lexsort((seen, -n))][:SYMBOLS]
        table[common] = np.arange(1, len(common) + 1)
    built = {}
    for lang, codes in held.items():
        text = symbols(codes, letters, table)
        built[lang] = (suffix_automaton(text, SYMBOLS + 2), len(text))
    return {"table": table, "languages": built}


def costs(model: dict, letters: np.ndarray, texts: list[str]) -> np.ndarray:
    """Bits per character that each text costs in each language; rows are texts."""
    parts = []
    for t in texts:
        parts.append(symbols(lowered(t), letters, model["table"]))
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    n_lanes = -(-lengths // LANE)
    owner = np.repeat(np.arange(len(parts)), n_lanes)
    total = np.zeros((len(parts), len(model["languages"])))
    padded = np.zeros(int(n_lanes.sum()) * LANE, dtype=np.uint8)
    sizes = np.full(len(owner), LANE, dtype=np.int64)
    starts = np.r_[0, np.cumsum(n_lanes)]
    for i, p in enumerate(parts):
        if len(p):
            padded[starts[i] * LANE : starts[i] * LANE + len(p)] = p
            sizes[starts[i + 1] - 1] = len(p) - (n_lanes[i] - 1) * LANE
    order = np.argsort(-sizes, kind="stable")
    grid = padded.reshape(-1, LANE)
    for a in range(0, len(order), LANES):
        at = order[a : a + LANES]
        lanes = np.ascontiguousarray(grid[at].T)
        for k, (step, n) in enumerate(model["languages"].values()):
            found = phrases(step, lanes, sizes[at])
            total[:, k] += np.bincount(owner[at], weights=found, minlength=len(parts)) * math.log2(n + 2)
    return total / np.maximum(lengths, 1)[:, None]


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_fold: int = 2,
) -> DataFrame:
    """Return doc_id, held_out, lang_pred and score (0 to 1) for every row.

    Learns from text and non-null lang of rows whose crc32(doc_id as text) mod folds is not held_fold;
    each language's automaton is built from SAMPLE_CHARS characters at most, picked by a hash. lang_pred
    is the language of the fewest bits per character, ties to the one whose label sorts first; the score is how much the others cost more, 0.5 where the runner-up
    costs the same and towards 1 as it costs more. A text that is null or has no letter is `und` with
    score 0, as is every text where nothing is learned. Null doc_ids are not learned from and not held
    out. Whole texts are parsed, in lanes of LANE characters at whose ends a piece ends too.
    """
    spark = docs.sparkSession
    learned_from = (
        docs.select(
            docs[id_col].cast("long").alias("doc_id"),
            docs[text_col].cast("string").alias("text"),
            docs[lang_col].cast("string").alias("lang"),
        )
        .where("text is not null and lang is not null")
        .where(crc_mod(F.col("doc_id"), folds) != held_fold)
    )
    letters = letter_table()
    model = spark.sparkContext.broadcast(learn(learned_from, letters))

    def run(batches):
        m, known = model.value, letter_table()
        names = list(m["languages"])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            preds, scores = [], []
            for a in range(0, len(texts), 2_000):
                some = texts[a : a + 2_000]
                cost = costs(m, known, some) if names else np.zeros((len(some), 0))
                for text, row in zip(some, cost, strict=True):
                    if not names or not any(map(str.isalpha, text)):
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    best = int(row.argmin())
                    rest = np.delete(row, best)
                    preds.append(names[best])
                    scores.append(float(rest.min() / (rest.min() + row[best])) if len(rest) and row[best] > 0 else 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    found = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), folds) == held_fold, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
