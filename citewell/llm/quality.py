"""Quality rules: base counts of a text, and lines that too many documents of a host share.

Lines are normalised and hashed; documents are counted by host and line.  There are two limits: lines of
more than ``LIMIT`` documents of a host, and lines of ``FEW`` documents or more that are over ``SHARE`` of
the host's documents, count as removed from its documents.  A document that keeps less than
``LEAST`` of its words is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from citewell.llm.common import WordHashes, map_rows, words_of
from citewell.session import staged

#: Documents of one host that may share a line.
LIMIT = 20
#: Share of a host's documents that may have a line, and the least documents for which the share counts.
SHARE, FEW = 0.02, 4
#: Share of its words that a document must keep.
LEAST = 0.3
_WINDOW = 8
_SYMBOLS = "#*$%&|<>"
# A host's number of documents is met in as many places, as one host may have a third of all lines.
_PLACES = 32

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(hashes: np.ndarray, window: int = _WINDOW) -> int:
    """Words inside windows of ``window`` words that the text has twice or more."""
    if not len(hashes):
        return 0
    _, kind, times = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = (times[kind] > 1).astype(np.int64)
    covers = np.zeros(len(hashes) + window, np.int64)
    covers[: len(twice)] += twice
    covers[window:] -= twice
    return int((np.cumsum(covers) > 0).sum())


def base_counts(text: str, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = words_of(text)
    windows = hashes.shingles(words, _WINDOW) if len(words) >= _WINDOW else np.zeros(0, np.uint64)
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += bool(words_of(line))
        seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), again, repeated_words(windows)


def line_words(text: str) -> dict[int, int]:
    """Words by hash of a normalised line: lower case, single spaces; lines without a word don't count."""
    found: dict[int, int] = {}
    for line in text.lower().split("\n"):
        if words := words_of(line):
            mark = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63)
            found[mark] = found.get(mark, 0) + len(words)
    return found


def judge(
    docs: DataFrame, key: str = "doc_id", column: str = "text", host: str = "source",
    limit: int = LIMIT, least: float = LEAST, share: float = SHARE, few: int = FEW,
) -> DataFrame:
    """doc_id, the base counts, base_failed, n_removed_words and kept of every row.

    Null text has no words and fails the base rules.  A null host is a host of its own.  Repeated
    rows are documents of their own, each with its own verdict.  An empty table gives an empty
    one; other columns are left out.  The counts by line are made once and staged; a very common
    line is one row of each task before it is shuffled, and one row of the frequent lines.
    """
    chosen = docs.select(F.col(key), F.col(host), F.col(column))
    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds[key]}, host {kinds[host]}, {_STATS}, lines array<struct<line: long, words: int>>"

    def start():
        hashes = WordHashes()

        def one(row, where, text):
            text = text or ""
            lines = [{"line": k, "words": v} for k, v in line_words(text).items()]
            return row, where, *base_counts(text, hashes), lines

        return one

    counted = staged(map_rows(chosen, schema, start).withColumn("__row", F.monotonically_increasing_id()), "quality")
    lines = counted.select("__row", "host", F.explode("lines").alias("at")).select("__row", "host", "at.line", "at.words")
    counts = lines.groupBy(F.col("host").alias("__host"), F.col("line").alias("__line")).agg(F.count("*").alias("documents"))
    counts = counts.where(F.col("documents") >= min(few, limit + 1))
    sizes = counted.groupBy("host").agg(F.count("*").alias("size")).select("host", "size", F.explode(F.sequence(F.lit(0), F.lit(_PLACES - 1))).alias("place"))
    frequent = counts.join(
        sizes, F.col("__host").eqNullSafe(F.col("host")) & (F.expr(f"cast(pmod(__line, {_PLACES}) as int)") == F.col("place"))
    ).where((F.col("documents") > limit) | (F.col("documents") >= few) & (F.col("documents") > share * F.col("size")))
    frequent = frequent.select("__host", "__line")
    removed = lines.join(
        frequent, F.col("host").eqNullSafe(F.col("__host")) & (F.col("line") == F.col("__line"))
    ).groupBy("__row").agg(F.sum("words").alias("n_removed_words"))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        counted.drop("lines", "host").join(removed, "__row", "left").drop("__row")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (left >= least * F.col("n_words")))
    )
