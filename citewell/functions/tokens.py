"""Tokens and word n-grams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from citewell.functions.vocab import STOP_WORDS

# Fixed value: at least three characters, a letter first; word boundaries are Unicode-aware.
TOKEN_PATTERN = r"(?U)\b[a-zA-Z][a-zA-Z0-9-]{2,}\b"


def tokens(document: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case tokens in text order, stop words removed, repeats kept."""
    found = F.regexp_extract_all(F.lower(document), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(list(stop_words)))


def in_list(name: str, values: Iterable[str]) -> str:
    """SQL text of a membership test; thousands of values are slow to pass one by one."""
    escaped = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return f"{name} IN ({','.join(f"'{v}'" for v in escaped)})"


def known_words(words: str, keep: Iterable[str]) -> Column:
    """Tokens of the array column ``words`` that are in ``keep``; the others become null."""
    return F.expr(f"transform({words}, t -> CASE WHEN {in_list('t', keep)} THEN t END)")


def bigrams(words: Column) -> Column:
    """Neighbouring token pairs; a pair with a null word is left out."""
    count = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.array_compact(pairs)


def ngrams(words: Column) -> Column:
    """1-grams followed by 2-grams."""
    return F.concat(words, bigrams(words))


def one_per_row(df: DataFrame, items: Column, name: str, *carried: str) -> DataFrame:
    """Explode ``items`` next to the carried columns; empty arrays give no row.

    A plain explode lets the optimizer infer a size filter, which it pushes below as a
    second evaluation of the whole array expression.  The outer form does not.
    """
    return df.select(*carried, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())
