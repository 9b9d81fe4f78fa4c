"""Byte-pair encoding by a token automaton, and decoding by its arc labels.

The automaton reads tokens. It begins with one arc per byte between all states. Each merge (u, v)
into w, in order, adds one gadget: the arc v out of state u is cut, and a state w appears that is
entered wherever u was and left as v was. Copied arcs are shared, not copied: a gadget notes whose
arcs w has taken over and when, so the whole compilation takes time and memory in proportion to the
merges, and an arc between two states is looked up through these notes and then kept in a table.
What the finished automaton accepts are exactly the token sequences that the merges produce, and of
the sequences that spell a word it accepts exactly one.

Words are read by a deterministic machine over bytes, once from left to right. Its state is the longest
end of what was read that some token begins with; it tells the tokens that end here. Every beginning of a
word has one accepted sequence too, so exactly one of them may follow the last token of the beginning
before it: the last token of this beginning. A word's tokens are read off the last ones backwards. States
and arcs are worked out when first met and kept in tables bounded by the vocabulary and by HELD_ARCS.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_text

#: How the byte-level pre-tokenizer splits a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of encoded words that a worker keeps; beyond them it begins anew. Longer words are not kept.
CACHED_BYTES, CACHED_WORD = 128 << 20, 256
#: Arcs between tokens that a worker keeps; beyond them it begins anew.
HELD_ARCS = 1_000_000
#: Characters of text that a worker holds in encoded form before it hands them on.
CHUNK_CHARS = 2_000_000


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in the vocabulary file: printable ones for themselves, the rest from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def load(path: str) -> dict:
    """Labels by id, merges as ids and special tokens of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([*vocab.values(), *special.values()]) + 1
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
    for token, i in special.items():
        labels[i] = token.encode()
    merges = []
    for m in spec["model"]["merges"]:
        a, b = m.split(" ") if isinstance(m, str) else m
        merges.append((vocab[a], vocab[b], vocab[a + b]))
    return {"labels": labels, "merges": merges, "special": special}


class State(dict):
    """A state of the machine that reads bytes; as a dict, the states that follow, by byte.

    held: the longest end of what was read that some token begins with. ends: the tokens that end
    here, longest first, and their lengths.
    """

    __slots__ = ("machine", "held", "ends")

    def __init__(self, machine: Automaton, held: bytes, ends: list[tuple[int, int]]) -> None:
        self.machine, self.held, self.ends = machine, held, ends

    def __missing__(self, byte: int) -> State:
        after = self[byte] = self.machine.state(self.held + bytes((byte,)))
        return after


class Arcs(dict):
    """Whether token y may follow x, by x times the number of tokens plus y; below 0: y comes first."""

    def __init__(self, machine: Automaton) -> None:
        self.machine = machine

    def __missing__(self, key: int) -> bool:
        if len(self) > HELD_ARCS:
            self.clear()
        found = self[key] = key < 0 or self.machine.arc(*divmod(key, self.machine.size))
        return found


class Automaton:
    """States are tokens (the one read last); arc(x, y) tells whether y may follow x."""

    def __init__(self, spec: dict) -> None:
        self.labels = spec["labels"]
        self.special = spec["special"]
        size = len(self.labels)
        self.size = size
        self.entered_as = [-1] * size
        self.left_as = [-1] * size
        self.born = [-1] * size
        self.cut: dict[int, int] = {}
        for time, (u, v, w) in enumerate(spec["merges"]):
            self._gadget(time, u, v, w)
        hidden = set(self.special.values())
        hidden |= {w for _, _, w in spec["merges"] if self.born[w] < 0}
        self.ids = {x: i for i, x in enumerate(self.labels) if x and i not in hidden}
        #: All beginnings of tokens.
        self.beginnings = {x[:k] for x in self.ids for k in range(1, len(x) + 1)}
        self.sizes = list(map(len, self.labels))
        self.arcs = Arcs(self)
        #: States met so far, at most one for each beginning of a token.
        self.states: dict[bytes, State] = {}
        self.start = self.state(b"")
        self.cache: dict[str, bytes] = {}
        self.cached = 0
        self.split = regex.compile(SPLIT)
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )

    def _gadget(self, time: int, u: int, v: int, w: int) -> None:
        # If earlier merges keep u and v from meeting, or have made w another way, nothing changes.
        if not self._arc(u, v, time):
            return
        self.cut[u * self.size + v] = time
        self.entered_as[w], self.left_as[w], self.born[w] = u, v, time

    def arc(self, x: int, y: int) -> bool:
        return self._arc(x, y, self.size + 1)

    def _arc(self, x: int, y: int, time: int) -> bool:
        """Whether the arc is there after so many merges."""
        while True:
            if self.cut.get(x * self.size + y, time) < time:
                return False
            if self.born[x] < 0 and self.born[y] < 0:
                return True
            if self.born[y] >= self.born[x]:
                time, y = self.born[y] + 1, self.entered_as[y]  # entered as u after the gadget's cut
            else:
                time, x = self.born[x], self.left_as[x]  # left as v was before it

    def state(self, held: bytes) -> State:
        """The state of the longest end of held that some token begins with."""
        while held and held not in self.beginnings:
            held = held[1:]
        found = self.states.get(held)
        if found is None:
            ends = [held[k:] for k in range(len(held))]
            found = self.states[held] = State(self, held, [(self.ids[x], len(x)) for x in ends if x in self.ids])
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The one accepted path that spells the word, read once."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        size, arcs, state = self.size, self.arcs, self.start
        lasts = [-1]  # the last token of each beginning of the word; -1: nothing was read
        for byte in word:
            state = state[byte]
            for token, length in state.ends:
                if arcs[lasts[-length] * size + token]:
                    lasts.append(token)
                    break
            else:
                raise ValueError(f"no token for byte {byte}")
        path, at, sizes = [], len(word), self.sizes
        while at:
            token = lasts[at]
            path.append(token)
            at -= sizes[token]
        path.reverse()
        return path

    def _packed(self, word: str) -> bytes:
        raw = word.encode()
        out = np.array(self.encode_word(raw), dtype=np.int32).tobytes()
        if len(raw) <= CACHED_WORD:
            if self.cached > CACHED_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cached += 200 + len(raw) + len(out)
            self.cache[word] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        if self.split_special is not None and any(s in text for s in self.special):
            parts = [
                np.array([self.special[p]], dtype=np.int32) if p in self.special else self._ordinary(p)
                for p in self.split_special.split(text)
            ]
            return np.concatenate(parts)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> np.ndarray:
        get, make = self.cache.get, self._packed
        return np.frombuffer(b"".join([get(w) or make(w) for w in self.split.findall(text)]), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        labels, size = self.labels, self.size
        return b"".join([labels[i] for i in ids if 0 <= i < size]).decode("utf-8", "replace")


def chunks(texts, limit: int = CHUNK_CHARS):
    """Row ranges of a column whose texts come to about so many bytes."""
    start, size = 0, 0
    for k, x in enumerate(texts):
        size += len(x)
        if size >= limit:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id and ids (array<int>) of every row's whole text.

    A null or empty text has no ids; null and repeated doc_ids keep their rows; other columns are
    not read. The vocabulary file is read on the driver and sent to the executors (a few MB).
    """
    spec = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        held = spec.value  # a worker keeps it for its later tasks, and with it the words encoded so far
        if "automaton" not in held:
            held["automaton"] = Automaton(held)
        automaton = held["automaton"]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                ids = [automaton.encode(x) for x in texts[a:b]]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.ListArray.from_arrays(ends, np.concatenate(ids))],
                    names=["doc_id", "ids"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add text, the labels of ids one after the other; bytes that are not UTF-8 become U+FFFD.

    Takes doc_id and ids; a null list gives an empty text, and ids out of range spell nothing.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(load(path)["labels"])

    def run(batches):
        labels = spec.value
        size = len(labels)
        for batch in batches:
            ids = batch.column(1)
            texts = [
                b"".join([labels[i] for i in x if i is not None and 0 <= i < size]).decode("utf-8", "replace")
                for x in (ids[k].values.to_numpy(zero_copy_only=False).tolist() if ids[k].is_valid else [] for k in range(len(ids)))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode, decode again, and give the number of tokens and the digests of ids and decoded text."""
    return decode(encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
