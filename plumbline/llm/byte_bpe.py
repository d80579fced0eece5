"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Every prefix of a piece of text has exactly one token that can end its encoding: the one that
fits (see ``merges``) the last token of the prefix it leaves. Storing that last token per byte
is enough to read the encoding of any prefix backwards, so an append continues the table and
an edit recomputes it only from the edit on, until it meets the old table again.

A null text counts as empty and has no tokens; documents that repeat are encoded one by one;
further columns are not read. Texts are split by the pattern as a whole, whatever their length.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, slices
from .merges import Merges, from_ranks
from .token_counts import END, Splitter

PIECES_HELD = 60_000  # in each of two generations
TEXT_AT_ONCE = 1 << 20
#: fixed value: the pattern whose pieces ``token_counts.Splitter`` finds; for another one the regex itself is run
SPLITTER_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def last_tokens(merges: Merges, piece: bytes) -> list[int]:
    """The unique last token of every byte prefix of ``piece``, from its first byte."""
    last: list = [None] * len(piece)
    tree, fit, known = merges.tree, merges.fit, merges.side_by_side.get
    for start in range(len(piece)):
        before, node, end = last[start - 1], tree, start
        for byte in piece[start:]:
            node = node.get(byte)
            if node is None:
                break
            if last[end] is None:
                token = node.get(-1)
                if token is not None and (not start or (fit(before, token) if (fits := known((before, token))) is None else fits)):
                    last[end] = token
            end += 1
    return last


class PrefixTable:
    """The unique last token of every byte prefix of one piece, kept for appends and edits."""

    def __init__(self, merges: Merges, piece: bytes = b""):
        self.merges, self.piece, self.last = merges, piece, last_tokens(merges, piece)
        self.reach = max(map(len, merges.tokens)) if merges.reach is None else merges.reach
        merges.reach = self.reach

    def _fill(self, since: int, old: list | None = None, moved: int = 0) -> None:
        """Last tokens of the prefixes longer than ``since``; those up to it hold.

        With ``old``, the table of the text before an edit, filling stops as soon as a run of
        prefixes as long as the longest token has the last tokens the old table has there:
        the same bytes follow with the same choices, so all later entries are the old ones.
        """
        piece, last, fit, n, reach, alike = self.piece, self.last, self.merges.fit, len(self.piece), self.reach, 0
        for start in range(max(0, since - reach), n):
            if old is not None and start > since + reach:
                was = start - moved
                alike = alike + 1 if was > 0 and old[was - 1] == last[start - 1] else 0
                if alike >= reach:
                    last[start:] = old[was:]
                    return
            before = last[start - 1] if start else None
            node = self.merges.tree
            for end in range(start, n):
                node = node.get(piece[end])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None and end >= since and last[end] is None and (before is None or fit(before, token)):
                    last[end] = token

    def append(self, more: bytes) -> None:
        since = len(self.piece)
        self.piece += more
        self.last += [None] * len(more)
        self._fill(since)

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace the bytes from ``start`` to ``end``; the table before them is kept."""
        old, after, moved = self.last, self.piece[end:], len(new) - (end - start)
        self.piece, self.last = self.piece[:start] + new, old[:start] + [None] * len(new)
        self._fill(start)
        edge = len(self.piece)  # from here on the bytes are the old ones
        self.piece += after
        self.last += [None] * len(after)
        self._fill(edge, old, moved)

    def tokens(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes (all, if not given)."""
        at, out = len(self.piece) if length is None else length, []
        while at > 0:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.merges.text[token])
        return out[::-1]


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    return from_ranks(path)


class Encoder:
    """Token ids of texts. Pieces seen lately are remembered in two generations, so that rare ones
    push out each other and not the frequent ones."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.held, self.older = merges, {}, {}
        self.splitter = Splitter() if pattern == SPLITTER_PATTERN else None
        self.split = regex.compile(pattern).findall
        self.codes = {i: i.to_bytes(4, "little") for i in merges.text}
        self.sizes = {i: len(b) for i, b in merges.text.items()}

    def pieces(self, texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The pieces of all texts, and where in that list each text ends."""
        if self.splitter is None:
            found = [[p.encode() for p in self.split(t.decode())] for t in texts]
            return [p for f in found for p in f], list(itertools.accumulate(map(len, found)))
        raw = b"".join([t + b" " for t in texts])  # the blank stands for the end of the text
        data = raw.decode()
        points = np.frombuffer(data.encode("utf-32-le"), "<u4")
        wide = np.cumsum(1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF), dtype=np.int64)
        ends = np.searchsorted(wide, np.cumsum([len(t) + 1 for t in texts]))
        kinds = self.splitter.kinds[points]
        kinds[ends] = END
        starts = self.splitter.starts(kinds)
        owner = np.searchsorted(ends, starts)
        stops = np.minimum(np.append(starts[1:], len(kinds)), ends[owner])
        before = np.concatenate([[0], wide])
        stop = np.cumsum(np.bincount(owner, minlength=len(texts))).tolist()
        return [raw[i:j] for i, j in zip(before[starts].tolist(), before[stops].tolist())], stop

    def _code(self, piece: bytes) -> bytes:
        code = self.older.get(piece)
        if code is None:
            whole = self.merges.tokens.get(piece)
            if whole in self.merges.rank:
                code = self.codes[whole]
            else:
                last, at, tokens = last_tokens(self.merges, piece), len(piece), []
                while at:
                    tokens.append(self.codes[last[at - 1]])
                    at -= self.sizes[last[at - 1]]
                code = b"".join(tokens[::-1])
        if len(piece) <= 64:
            if len(self.held) >= PIECES_HELD:
                self.older = dict(self.held)
                self.held.clear()
            self.held[piece] = code
        return code

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        held, code = self.held.get, self._code
        pieces, stops = self.pieces(texts)
        codes = [held(p) or code(p) for p in pieces]
        return [b"".join(codes[i:j]) for i, j in zip([0, *stops], stops)]

    def ids(self, text: str) -> bytes:
        return self.encode([text.encode()])[0]

    def text(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process, kept over its tasks."""
    return Encoder(load(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and token_ids: the ids of the text as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        for rows in slices(batches, "text", TEXT_AT_ONCE):
            ids = made.encode(bytes_of(rows.column("text")))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "token_ids"])

    schema = docs.select("doc_id", F.lit(b"").alias("token_ids")).schema
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, token_ids) with decoded: the bytes of the tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        for rows in slices(batches, "token_ids", TEXT_AT_ONCE):
            texts = [made.text(c or b"") for c in rows.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], [*rows.schema.names, "decoded"])

    schema = encoded.select("doc_id", "token_ids", F.lit(b"").alias("decoded")).schema
    return encoded.select("doc_id", "token_ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, token_ids and decoded (the bytes of those tokens) in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        for rows in slices(batches, "text", TEXT_AT_ONCE):
            ids = made.encode(bytes_of(rows.column("text")))
            back = [made.text(i) for i in ids]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array(back, pa.binary())], ["doc_id", "token_ids", "decoded"])

    schema = docs.select("doc_id", F.lit(b"").alias("token_ids"), F.lit(b"").alias("decoded")).schema
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    both = round_trip(docs, path, pattern)
    return both.select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
