"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no vocabulary token can be covered by no
token, so a word may be cut there before any merge is tried: no merge crosses the cut and
the two sides don't influence each other.  Words are cut at all such pairs, the fragments
are merged each by itself, and their ids are put together again.

Fragments of many words are merged side by side in numpy.  Words repeat, so what they
encode to is remembered per Python worker, in a table of bounded size; when it is full,
the words of the texts at hand stay.
"""

from __future__ import annotations

import functools
import json
import struct
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from citewell.llm.common import map_batches

#: White space of the vocabulary's pattern.
_SPACE = r"\x09-\x0d\x20\x85\xa0  -     　"
#: Fixed value: how the vocabulary parts lower-case text into words.
_PATTERN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_SPACES = regex.compile(f"[{_SPACE}]+")
#: str.split() takes these for spaces, the pattern does not.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
_END = "</w>"
_NEVER = 1 << 30


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where visible, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Pairs:
    """Rank and joined id of pairs of ids, looked up for whole arrays: hash tables, each for what the last had no place for."""

    def __init__(self, joins: dict[tuple[int, int], tuple[int, int]], bits: int = 18):
        keys = np.array([a << 16 | b for a, b in joins], np.uint64)
        values = np.array(list(joins.values()), np.int64).reshape(-1, 2)
        self.tables, self.shift, odd = [], np.uint64(64 - bits), 0x9E3779B97F4A7C15
        while len(keys):
            odd = (odd * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
            at = keys * np.uint64(odd) >> self.shift
            _, placed = np.unique(at, return_index=True)
            table = np.zeros((1 << bits), np.uint64), np.zeros((1 << bits, 2), np.int32)
            table[0][:] = np.uint64(1 << 63)
            table[0][at[placed]], table[1][at[placed]] = keys[placed], values[placed]
            self.tables.append((np.uint64(odd), *table))
            rest = np.setdiff1d(np.arange(len(keys)), placed)
            keys, values = keys[rest], values[rest]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        rank, joined = np.full(len(keys), _NEVER, np.int32), np.zeros(len(keys), np.int32)
        todo = np.arange(len(keys))
        for odd, known, values in self.tables:
            at = keys[todo] * odd >> self.shift
            hit = known[at] == keys[todo]
            found = values[at[hit]]
            rank[todo[hit]], joined[todo[hit]] = found[:, 0], found[:, 1]
            todo = todo[~hit]
        return rank, joined


class Vocabulary:
    """A word BPE file with word ends, lower-casing text."""

    def __init__(self, path: str, remember: int = 400_000):
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        model = loaded["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self.tokens = np.full(max([*self.ids.values(), *self.special.values()]) + 1, None, object)
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self.pairs = Pairs({(self.ids[a], self.ids[b]): (k, self.ids[a + b]) for k, (a, b) in enumerate(model["merges"])})
        # A byte inside a word has its value as symbol, a byte that ends one 256 more.
        letters = byte_letters()
        self.symbol_ids = np.array([self.ids[c] for c in letters] + [self.ids[c + _END] for c in letters], np.int32)
        place = {c: b for b, c in enumerate(letters)}
        self.inside = np.zeros((512, 512), bool)
        for token in self.ids:
            body = token.removesuffix(_END) or token
            symbols = [place[c] for c in body]
            symbols[-1] += 256 * (body != token)
            self.inside[symbols[:-1], symbols[1:]] = True
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[bytes, str]] = {}
        self.remember = remember

    def cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all words, where words begin, and where fragments begin.

        A fragment begins with each word and wherever no token can hold both neighbours.
        """
        raw = [w.encode() for w in words]
        starts = np.cumsum([0, *map(len, raw)])
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32)
        symbols[starts[1:] - 1] += 256
        begins = np.ones(len(symbols), bool)
        begins[1:] = ~self.inside[symbols[:-1], symbols[1:]]
        begins[starts[:-1]] = True
        return symbols, starts, begins

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's ids begin (and the end).

        Every fragment is merged by itself: in each round its lowest-ranked neighbours join;
        a fragment without neighbours to join is done.
        """
        symbols, starts, begins = self.cut(words)
        ids, kept = self.symbol_ids[symbols], np.ones(len(symbols), bool)
        live = np.arange(len(symbols))  # places that still matter, in order
        while len(live):
            first = begins[live]
            rank, joined = np.full(len(live), _NEVER, np.int32), np.zeros(len(live), np.int32)
            inner = np.flatnonzero(~first[1:])
            rank[inner], joined[inner] = self.pairs(ids[live[inner]], ids[live[inner + 1]])
            heads = np.flatnonzero(first)
            sizes = np.diff([*heads, len(live)])
            best = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            hits = np.flatnonzero((rank == best) & (best < _NEVER))
            # All equal pairs of a fragment join at once: what they make can only join later.
            # Where they overlap, as in aaa, every second one does, from the left.
            opens = np.r_[True, np.diff(hits) != 1] | first[hits]
            turn = np.arange(len(hits)) - np.maximum.accumulate(np.where(opens, np.arange(len(hits)), 0)) if len(hits) else hits
            hits = hits[turn % 2 == 0]
            ids[live[hits]] = joined[hits]
            kept[live[hits + 1]] = False
            stays = best < _NEVER
            stays[hits + 1] = False
            live = live[stays]
        return ids[kept], np.r_[0, np.cumsum(kept)][starts]

    def decode(self, ids) -> str:
        """The tokens of ``ids``, one space between them; special tokens stay, unknown ids go."""
        return " ".join([t for t in self.tokens[np.asarray(ids, np.int64)] if t is not None])

    def learn(self, chunks: set[str]) -> None:
        """Remember packed ids and decoded tokens of texts without spaces."""
        new = [c for c in chunks if c not in self.known]
        if len(self.known) + len(new) > self.remember:
            self.known = {c: self.known[c] for c in chunks if c in self.known}
        chunks = list(new)
        words = [_PATTERN.findall(c) for c in chunks]
        ids, starts = self.encode([w for found in words for w in found]) if any(words) else (np.zeros(0, np.int32), [0])
        packed, tokens = ids.astype("<u4").tobytes(), self.tokens[ids].tolist()
        ends = np.asarray(starts)[np.cumsum([0, *map(len, words)])].tolist()
        for chunk, a, b in zip(chunks, ends, ends[1:]):
            self.known[chunk] = packed[4 * a : 4 * b], " ".join(tokens[a:b])

    def round_trip(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Packed ids of whole texts, and what they decode to."""
        parted = [[*map(self._chunks, self.parts.split(t) if self.parts and "<|" in t else (t,))] for t in texts]
        self.learn({c for parts in parted for chunks in parts if isinstance(chunks, list) for c in chunks})
        all_packed, all_decoded = [], []
        for parts in parted:
            packed, decoded = [], []
            for chunks in parts:
                if isinstance(chunks, str):
                    packed.append(struct.pack("<I", self.special[chunks]))
                    decoded.append(chunks)
                    continue
                values = [self.known[c] for c in chunks]
                packed += [v[0] for v in values]
                decoded += [v[1] for v in values if v[1]]
            all_packed.append(b"".join(packed))
            all_decoded.append(" ".join(decoded))
        return all_packed, all_decoded

    def _chunks(self, part: str) -> list[str] | str:
        """Normalised text between spaces; a special token as it is."""
        if part in self.special:
            return part
        if not part.isascii():
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        part = part.lower()
        return [c for c in _SPACES.split(part) if c] if _SEPARATORS.search(part) else part.split()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_and_decode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), column: str = "text") -> DataFrame:
    """``keep``, packed_ids binary (32-bit little-endian), n_tokens long, decoded string for every row.

    Null and empty texts have no ids and decode to the empty text; repeated rows stay; other
    columns are left out whatever their names.  ``path`` must be readable on every executor.
    """
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keep) + "packed_ids binary, n_tokens long, decoded string"

    def start():
        known = vocabulary(path)

        def made(*columns):
            packed, decoded = known.round_trip([t or "" for t in columns[-1]])
            return *columns[:-1], packed, [len(p) // 4 for p in packed], decoded

        return made

    return map_batches(docs.select(*keep, F.col(column)), schema, start)
