"""Byte-level BPE encoding and decoding with a segment tree.

Each match of the pattern is merged by itself.  A segment tree over the match's byte
positions stores the leftmost least rank of a pair of neighbouring tokens; its root is
the next merge.  A node has sixteen children, so the tree of most matches is one level.  A merge changes
three leaves at most (the pair itself, the one before it, the one after it, which is gone), each in a
logarithmic number of steps, so a match of any length takes n log n steps.

Matches repeat, so what they encode to is remembered per Python worker in a table of
bounded size.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from citewell.llm.common import map_batches

#: Unicode white space, as the tokenizer's own library takes ``\s``.
_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
_NONE = 1 << 30
_NEVER = _NONE << 32
#: Longer matches are not remembered; longer texts are matched one by one.
_REMEMBERED_LENGTH, _LONG_TEXT = 64, 1 << 20


def compiled(pattern: str, space: str = _SPACE, letter: str = r"\p{L}", number: str = r"\p{N}", engine=regex):
    """The pattern with its classes of characters spelt out, inside and outside of brackets."""
    classes = {r"\s": space, r"\p{L}": letter, r"\p{N}": number}

    def spelt(part: re.Match) -> str:
        if part[0].startswith("["):
            return re.sub(r"\\s|\\p\{[LN]\}", lambda m: classes[m[0]], part[0])
        return f"[^{space}]" if part[0] == r"\S" else f"[{classes[part[0]]}]"

    return engine.compile(re.sub(r"\[[^\]]*\]|\\[sS]|\\p\{[LN]\}", spelt, pattern))


def climb(tree: list[int], at: int) -> None:
    """Set a node of a tree of least values by its children, then those above it, as far up as something changes."""
    while at:
        least = min(tree[16 * at - 14 : 16 * at + 2])
        if tree[at] == least:
            return
        tree[at] = least
        at = (at + 14) >> 4


def put(tree: list[int], place: int, value: int) -> None:
    """Set a place of a tree of least values."""
    at = tree[0] + place
    tree[at] = value
    climb(tree, (at + 14) >> 4)


def tree_of(values: list[int]) -> list[int]:
    """A segment tree: node i holds the least of the sixteen nodes from 16i - 14, node 1 the least of all, number 0 where the values begin."""
    if len(values) <= 16:
        return [2, min(values), *values]
    levels, inner, width = [values], 0, 1
    while len(below := levels[-1]) > 1:
        levels.append([min(below[i : i + 16]) for i in range(0, len(below), 16)])
        inner, width = inner + width, width * 16
    # Levels above the values are filled up, so that places follow from numbers.
    filled, width = [], 1
    for level in levels[:0:-1]:
        filled += level + [_NEVER] * (width - len(level))
        width *= 16
    return [inner + 1, *filled, *values]


class Ranks(dict):
    """Ids of matches by a file of ranks; remembered are up to ``remember`` matches, and as many of before, of which those come back that are met again."""

    def __init__(self, path: str, pattern: str, remember: int = 400_000):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.keyed = {token: rank << 32 for token, rank in self.ranks.items()}
        self.remember, self.pattern, self.older = remember, compiled(pattern), {}
        self.plain = compiled(pattern, r"\x09-\x0D\x20", "A-Za-z", "0-9", re)

    def __missing__(self, match: str) -> tuple[int, ...]:
        if len(match) > _REMEMBERED_LENGTH:
            return tuple(self.merged(match.encode("utf-8", "surrogatepass")))
        ids = self.older.get(match) or tuple(self.merged(match.encode("utf-8", "surrogatepass")))
        if len(self) >= self.remember:
            self.older = dict(self)
            self.clear()
        self[match] = ids
        return ids

    def merged(self, match: bytes) -> list[int]:
        """The ids of one match: the least rank first, the leftmost of equal ones."""
        ranks = self.ranks
        if match in ranks:
            return [ranks[match]]
        keyed, last = self.keyed, len(match) - 1
        # A token is match[place:after[place]]; rank and place of the pair that begins at a place are one number.
        after, before = list(range(1, last + 2)), list(range(-1, last))
        tree = tree_of([keyed.get(match[i : i + 2], _NEVER) | i for i in range(last)])
        first = tree[0]
        while (least := tree[1]) < _NEVER:
            at = least & 0xFFFFFFFF
            gone = after[at]
            follows = after[at] = after[gone]
            # Places that change lie under one lowest node, mostly: those are set first, then the nodes above them.
            node = low = (first + at + 14) >> 4
            if gone < last:
                tree[first + gone] = _NEVER
                node = (first + gone + 14) >> 4
            if follows <= last:
                before[follows] = at
                tree[first + at] = keyed.get(match[at : after[follows]], _NEVER) | at
            else:
                tree[first + at] = _NEVER
            if at:
                left = before[at]
                tree[first + left] = keyed.get(match[left:follows], _NEVER) | left
                if (other := (first + left + 14) >> 4) != low:
                    climb(tree, other)
            climb(tree, low)
            if node != low:
                climb(tree, node)
        ids, at = [], 0
        while at <= last:
            ids.append(ranks[match[at : after[at]]])
            at = after[at]
        return ids

    def encode(self, text: str) -> np.ndarray:
        pattern = self.plain if text.isascii() else self.pattern
        matches = pattern.findall(text) if len(text) < _LONG_TEXT else (m[0] for m in pattern.finditer(text))
        return np.fromiter(itertools.chain.from_iterable(map(self.__getitem__, matches)), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@functools.cache
def _loaded(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def encode_and_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """key, ids, n_tokens and decoded (bytes) of every row; rows and repeats stay as they are.

    ``path`` is a file of base64 tokens and their ranks that every executor can read.  A
    null text is taken as empty and has no ids.  An empty table gives an empty one, and
    columns other than key and text are left out.
    """
    schema = f"key {dict(docs.dtypes)[key]}, ids array<int>, n_tokens bigint, decoded binary"

    def start():
        ranks = _loaded(path, pattern)

        def coded(keys, texts):
            ids = [ranks.encode(text or "") for text in texts]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            listed = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *ids]))
            return keys, listed, [len(i) for i in ids], [ranks.decode(i) for i in ids]

        return coded

    made = map_batches(docs.select(F.col(key).alias("key"), F.col(column).alias("text")), schema, start)
    return made.select(F.col("key").alias(key), "ids", "n_tokens", "decoded")
