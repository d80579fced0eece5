"""Token counts by compiled finite-state transducers.

Two deterministic transducers count the tokens a byte-level BPE tokenizer gives.

The splitter reads characters by class and marks where the pieces begin that merges stay
inside. A batch of texts is cut into chunks of equal length; a chunk's effect is a map from
every state to a state, read off one character at a time from the compiled table of maps, and
a parallel prefix scan composes the maps, so each chunk learns the state it starts in and all
chunks are then read at once.

The counter reads the bytes of the pieces, all pieces at once. Its state holds what the future
needs: for each place a token may still start from, the node of the prefix tree reached since,
the last token before that place and the count there less the count now. A transition is
annotated with the tokens it adds to the encoding of the prefix (it may take some back, when a
longer token replaces shorter ones). States are compiled when first met and shared by all
later texts of the worker; the table is emptied when it reaches its bound.

Special strings of the vocabulary are one token each and cut the text, as in the library. A
null text counts as empty: no bytes, no tokens. Repeated rows are counted one by one; further
columns are not read; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of
from .merges import Merges, from_json

LIMIT = 512
CHUNK = 1024
CHARACTERS_AT_ONCE = 2 << 20
STATES_HELD = 1 << 18
PIECES_AT_ONCE = 1 << 19

# splitter: classes of characters and states
PLAIN, CLOSES, R, V, LL, E, NUMBER, SPACE, BLANK, MARK, OTHER, END = range(12)
FRESH, LETTERS, NUMBERS, OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK = range(12)
BEFORE_LAST, BEFORE_THIS = 1, 2  # where a piece turns out to begin
STARTS = {NUMBER: NUMBERS, SPACE: ONE_SPACE, BLANK: ONE_BLANK, MARK: QUOTE, OTHER: OTHERS, END: FRESH}


def _step(state: int, kind: int) -> tuple[int, int]:
    """Next state and where pieces begin, for one character.

    A run of blanks leaves its last one to what follows: a space joins it, another blank is a
    piece of its own. A mark (') that begins a piece may be one of 's 't 'm 'd 're 've 'll.
    """
    letter = kind <= E
    starts = LETTERS if letter else STARTS[kind]
    if kind == END:
        return FRESH, BEFORE_LAST if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
    if state == FRESH:
        return starts, BEFORE_THIS
    if state in (LETTERS, NUMBERS, OTHERS):
        stays = {LETTERS: letter, NUMBERS: kind == NUMBER, OTHERS: kind in (OTHER, MARK)}[state]
        return (state, 0) if stays else (starts, BEFORE_THIS)
    if state == QUOTE:
        follow = {CLOSES: FRESH, R: QUOTE_R, V: QUOTE_V, LL: QUOTE_L, OTHER: OTHERS, MARK: OTHERS}.get(kind)
        return (follow, 0) if follow is not None else (starts, BEFORE_THIS)
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (LL if state == QUOTE_L else E):
            return FRESH, 0
        after, begins = _step(LETTERS, kind)
        return after, begins | BEFORE_LAST
    if kind in (SPACE, BLANK):
        return (RUN_SPACE if kind == SPACE else RUN_BLANK), 0
    if state == ONE_BLANK:
        return starts, BEFORE_THIS
    joined = OTHERS if kind == MARK else starts
    if state == RUN_BLANK:
        return starts, BEFORE_LAST | BEFORE_THIS
    return joined, BEFORE_LAST if state == RUN_SPACE else 0


class Splitter:
    def __init__(self):
        steps = [[_step(s, k) for k in range(12)] for s in range(12)]
        self.next = np.array([[n for n, _ in row] for row in steps], np.uint8)
        self.begins = np.array([[b for _, b in row] for row in steps], np.uint8)
        # all maps from state to state that texts can have, and the map after one more character
        maps, known, table = [tuple(range(12))], {tuple(range(12)): 0}, []
        for m in maps:
            row = []
            for kind in range(12):
                after = tuple(int(self.next[s, kind]) for s in m)
                if after not in known:
                    known[after] = len(maps)
                    maps.append(after)
                row.append(known[after])
            table.append(row)
        self.maps, self.extend = np.array(maps, np.uint8), np.array(table, np.uint16)
        self.kinds = np.full(0x110000, OTHER, np.uint8)
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        everything = points.astype("<u4").tobytes().decode("utf-32-le")
        for pattern, kind in ((r"\p{L}+", PLAIN), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
            for run in regex.finditer(pattern, everything):
                a, b = ord(run[0][0]), ord(run[0][-1])
                self.kinds[a:b + 1] = kind
        for chars, kind in (("stmd", CLOSES), ("r", R), ("v", V), ("l", LL), ("e", E), (" ", SPACE), ("'", MARK)):
            for c in chars:
                self.kinds[ord(c)] = kind

    def starts(self, kinds: np.ndarray) -> np.ndarray:
        """Places where pieces begin; ``kinds`` ends every text with END."""
        n = len(kinds)
        chunks = -(-n // CHUNK)
        padded = np.full(chunks * CHUNK, END, np.uint8)
        padded[:n] = kinds
        steps = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
        whole = np.zeros(chunks, np.uint16)
        for column in steps:
            whole = self.extend[whole, column]
        scanned = self.maps[whole]
        shift = 1
        while shift < chunks:  # inclusive prefix scan: the map of all chunks up to this one
            scanned[shift:] = np.take_along_axis(scanned[shift:], scanned[:-shift], axis=1)
            shift *= 2
        state = np.concatenate([[FRESH], scanned[:-1, FRESH]]).astype(np.uint8)
        marks = np.empty_like(steps)
        for at, column in enumerate(steps):
            marks[at] = self.begins[state, column]
            state = self.next[state, column]
        flat = marks.T.reshape(-1)[:n]
        begins = (flat & BEFORE_THIS) > 0
        begins[:-1] |= (flat[1:] & BEFORE_LAST) > 0
        return np.flatnonzero(begins)


class Transitions:
    """A hash array from state and byte to what the transition does; -1 where none is known."""

    def __init__(self, bits: int = 16):
        self.bits, self.held = bits, 0
        self.keys, self.does = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.does[slots], -1)
        rest = np.flatnonzero((there != keys) & (there >= 0))
        while rest.size:
            slots[rest] = slots[rest] + 1 & (1 << self.bits) - 1
            there = self.keys[slots[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.does[slots[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return out

    def add(self, keys: np.ndarray, does: np.ndarray) -> None:
        """New keys, each once."""
        while (self.held + len(keys)) * 2 > 1 << self.bits:
            old = self.keys >= 0
            keys, does = np.concatenate([keys, self.keys[old]]), np.concatenate([does, self.does[old]])
            self.__init__(self.bits + 1)
        self.held += len(keys)
        for key, slot, what in zip(keys.tolist(), self._slots(keys).tolist(), does.tolist()):
            while self.keys[slot] >= 0:
                slot = slot + 1 & (1 << self.bits) - 1
            self.keys[slot], self.does[slot] = key, what


class Counter:
    """The lazily compiled transducer from bytes of a piece to token counts."""

    def __init__(self, merges: Merges, most: int = STATES_HELD):
        self.merges, self.most = merges, most
        # the prefix tree by number: children, and the token that ends at a node
        self.children, self.token, trees = [], [], [merges.tree]
        for tree in trees:
            row = {}
            for byte, child in tree.items():
                if byte != -1:
                    row[byte] = len(trees)
                    trees.append(child)
            self.children.append(row)
            self.token.append(tree.get(-1))
        self._empty()

    def _empty(self) -> None:
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.transitions = Transitions()
        self._state((0, None, 0))

    def _state(self, places: tuple) -> int:
        """Number of a state: node, last token and count for each place, one after the other."""
        at = self.known.setdefault(places, len(self.states))
        if at == len(self.states):
            self.states.append(places)
        return at

    def _compile(self, state: int, byte: int) -> int:
        """The transition, as next state and added tokens."""
        fit, children, tokens, found, alive = self.merges.fit, self.children, self.token, None, []
        places = self.states[state]
        for i in range(0, len(places), 3):
            node = children[places[i]].get(byte)
            if node is None:
                continue
            last, back = places[i + 1], places[i + 2]
            token = tokens[node]
            if found is None and token is not None and (last is None or fit(last, token)):
                found, added = token, back + 1
            if children[node]:
                alive += [node, last, back]
        for i in range(2, len(alive), 3):
            alive[i] -= added
        return self._state((*alive, 0, found, 0)) << 8 | added + 128

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece ``data[start:end]``."""
        order = np.argsort(starts - ends, kind="stable")  # longest first: those still open come first
        starts, lengths = starts[order], (ends - starts)[order]
        state, total = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        falling = -lengths
        for step in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(falling, -step))
            now, byte = state[:n], data[starts[:n] + step]
            keys = now.astype(np.int64) << 8 | byte
            went = self.transitions.find(keys)
            if (went < 0).any():
                if len(self.states) > self.most:  # begin anew with the states that are open
                    held, places = np.unique(now, return_inverse=True)
                    open_states = [self.states[s] for s in held.tolist()]
                    self._empty()
                    now[:] = np.array([self._state(e) for e in open_states], np.int32)[places]
                    keys = now.astype(np.int64) << 8 | byte
                    went = self.transitions.find(keys)
                missing = np.flatnonzero(went < 0)
                new, places = np.unique(keys[missing], return_inverse=True)
                does = np.array([self._compile(k >> 8, k & 255) for k in new.tolist()], np.int64)
                self.transitions.add(new, does)
                went[missing] = does[places]
            state[:n] = went >> 8
            total[:n] += (went & 255) - 128
        out = np.empty_like(total)
        out[order] = total
        return out


class TokenCounter:
    def __init__(self, path: str):
        merges, special = from_json(path)
        self.splitter, self.counter = Splitter(), Counter(merges)
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        parts, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            between = [text]
            if self.special and self.special.search(text):
                between = self.special.split(text)
                total[i] = len(between) - 1
            parts += between
            owner += [i] * len(between)
        data = "".join(p + " " for p in parts)
        if not data:
            return total
        points = np.frombuffer(data.encode("utf-32-le"), "<u4")
        kinds = self.splitter.kinds[points]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1  # the place after each part
        kinds[ends] = END
        starts = self.splitter.starts(kinds)
        # a piece ends where the next begins, or at the end of its part
        part = np.searchsorted(ends, starts)
        stops = np.minimum(np.append(starts[1:], len(kinds)), ends[part])
        wide = np.concatenate([[0], np.cumsum(1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF), dtype=np.int64)])
        raw = np.frombuffer(data.encode(), np.uint8)
        a, b = wide[starts], wide[stops]
        tokens = np.concatenate([self.counter.count(raw, a[i:i + PIECES_AT_ONCE], b[i:i + PIECES_AT_ONCE]) for i in range(0, len(a), PIECES_AT_ONCE)] or [np.empty(0, np.int32)])
        np.add.at(total, np.array(owner)[part], tokens)
        return total


@lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    """One per worker process, kept over its tasks."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    schema = docs.select("doc_id", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = token_counter(path)
        for batch in batches:
            raw = bytes_of(batch.column("text"))
            sizes = np.array([len(t) for t in raw], np.int64)
            piece = np.cumsum(sizes) // CHARACTERS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(raw)]
            for i, j in zip(cuts, cuts[1:]):
                if j > i:
                    counts = made.counts([t.decode() for t in raw[i:j]])
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(sizes[i:j]), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
