"""What the operators share: table access, word patterns, and per-document Arrow maps."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Characters that part words, as a Java and Python character class.
SPACES = r"\x20\x09-\x0D"
#: A word is a longest run of anything else.
WORD = rf"[^{SPACES}]+"

# str.split() takes these for spaces, too; WORD does not.
_OTHER_SPACES = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORDS = re.compile(WORD)
# 64-bit factors of the places of a shingle's words.
_PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1) + 0x7F4A7C15 * 2 * i) % (1 << 64) | 1 for i in range(16)], np.uint64)

# Rows of a batch handed back to Spark, so that long texts don't pile up.
_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def map_batches(df: DataFrame, schema: str, start: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """Rows of ``schema`` from rows of ``df``, by Python over lists of at most 512 rows inside Arrow batches.

    ``start`` is called once in every task and returns the function that maps the columns
    (lists) to the columns of ``schema``.  Nothing is kept between tasks but what ``start``
    caches, so a lost task is simply run again.
    """
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_of = start()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                made = made_of(*(c.to_pylist() for c in batch.slice(at, _ROWS).columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(made, out)], schema=out)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """As ``map_batches``, one output row for each row, by a function of a row's values."""

    def of_batches():
        one = start()
        return lambda *columns: tuple(zip(*map(one, *columns)))

    return map_batches(df, schema, of_batches)


def words_of(text: str) -> list[str]:
    """The words of ``WORD``, inside Python."""
    return _WORDS.findall(text) if _OTHER_SPACES.search(text) else text.split()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a one-to-one mapping)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, remember: int = 300_000):
        self.remember = remember

    def __missing__(self, word: str) -> int:
        if len(self) >= self.remember:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def shingles(self, words: list[str], n: int) -> np.ndarray:
        """A hash for each ``n`` words in a row; for fewer words, one of them all; none without words."""
        return shingles_of(self.of(words), n)


# One random 64-bit number for each byte, as it is and with A-Z in lower case; powers of an odd number and their inverses.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER_BYTES = _BYTES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0xD1342543DE82EF95
_PIECE = 1 << 20


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    def of(base: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[:1] = 1
        return np.multiply.accumulate(factors)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def lower_word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word (``WORD``) of a text, A-Z taken as a-z, from its bytes by running sums."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    made = []
    at = 0
    while at < len(raw):
        piece = raw[at : at + _PIECE]
        if at + _PIECE < len(raw):  # a piece ends with a space, or with the word that fills it
            spaces = np.flatnonzero(_IS_SPACE[piece])
            if len(spaces):
                piece = piece[: spaces[-1] + 1]
            else:
                after = np.flatnonzero(_IS_SPACE[raw[at:]])
                piece = raw[at : at + int(after[0]) + 1] if len(after) else raw[at:]
        at += len(piece)
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[piece]
        turns = np.diff(inside)
        starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        powers, inverses = _powers(1 << max(len(piece) - 1, 1).bit_length())
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_LOWER_BYTES[piece] * powers[: len(piece)], out=sums[1:])
        made.append(mix((sums[ends] - sums[starts]) * inverses[starts]))
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def shingles_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` word hashes in a row; for fewer, one of them all; none without words."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    n = min(n, len(hashes))
    made = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        made += hashes[i : len(hashes) - n + i + 1] * _PLACES[i]
    return mix(made)
