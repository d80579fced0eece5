"""Byte-pair vocabularies: merge trees, a prefix tree and which tokens may stand side by side.

A token's merge tree is fixed, so two tokens can meet in an encoding exactly when no merge
across their border happens before one side has been merged away from it. That needs only the
right spine of the first token and the left spine of the second.
"""

from __future__ import annotations

import base64
import json

SINGLE = -1  # rank of a byte: there from the start
PAIRS_HELD = 1 << 18


class Merges:
    """Tokens by id with ``rank`` (order of the merge that makes it), ``left`` and ``right`` part."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[tuple[int, int], tuple[int, int]]):
        """``tokens``: bytes to id; ``pairs``: ids side by side to (rank, id of the merged)."""
        self.tokens, self.pairs = tokens, pairs
        self.text = {i: b for b, i in tokens.items()}
        self.rank: dict[int, int] = {i: SINGLE for b, i in tokens.items() if len(b) == 1}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for token, i in tokens.items():
            if len(token) > 1 and (made := self._tree(token)):
                self.rank[i], self.left[i], self.right[i] = made
        #: nested by byte; the key -1 holds the id of the token that ends there
        self.tree: dict = {}
        for token, i in tokens.items():
            if i in self.rank:
                node = self.tree
                for byte in token:
                    node = node.setdefault(byte, {})
                node[-1] = i
        self.side_by_side: dict[tuple[int, int], bool] = {}
        self.reach: int | None = None  # length of the longest token, once asked for

    def _tree(self, token: bytes) -> tuple[int, int, int] | None:
        """Rank and parts of the merge that makes a token; None if no merges make it."""
        parts = [self.tokens[token[i:i + 1]] for i in range(len(token))]
        rank = SINGLE
        while len(parts) > 1:
            best = min(((*self.pairs[p], k) for k in range(len(parts) - 1) if (p := (parts[k], parts[k + 1])) in self.pairs), key=lambda m: (m[0], m[2]), default=None)
            if best is None:
                return None
            rank, merged, k = best
            made = rank, parts[k], parts[k + 1]
            parts[k:k + 2] = [merged]
        return made

    def fit(self, a: int, b: int) -> bool:
        """Whether the encoding of a's bytes followed by b's is the two tokens a, b."""
        known = self.side_by_side.get((a, b))
        if known is None:
            if len(self.side_by_side) >= PAIRS_HELD:
                self.side_by_side.clear()
            known = self.side_by_side[a, b] = self._fit(a, b)
        return known

    def _fit(self, a: int, b: int) -> bool:
        # back in time: undo the later of the two merges at the border until both are bytes
        never = float("inf")
        until_a = until_b = never  # when a, b were merged into something larger
        while True:
            merge = self.pairs.get((a, b))
            # of merges with one rank the left one comes first
            if merge is not None and merge[0] < until_a and merge[0] <= until_b:
                return False
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a == rank_b == SINGLE:
                return True
            if rank_a > rank_b:
                until_a, a = rank_a, self.right[a]
            else:
                until_b, b = rank_b, self.left[b]


def from_ranks(path: str) -> Merges:
    """A file of base64 tokens and ranks; any two tokens whose bytes join to a token merge."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    pairs = {}
    for token, rank in tokens.items():
        for cut in range(1, len(token)):
            a, b = tokens.get(token[:cut]), tokens.get(token[cut:])
            if a is not None and b is not None:
                pairs[a, b] = (rank, rank)
    return Merges(tokens, pairs)


def byte_letters() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def from_json(path: str) -> tuple[Merges, list[str]]:
    """A byte-level tokenizer file with a merge list; also the special strings it looks for in texts."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    special = [t["content"] for t in spec["added_tokens"]]
    vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    tokens = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
    pairs = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        pairs[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
    return Merges(tokens, pairs), special
