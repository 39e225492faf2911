"""Text expressions: titles, documents, match keys, markup, abstracts, labels."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Lower-case letters that full case folding expands.
_SPELLED_OUT = (
    ("ß", "ss"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"),
)

# White space in the sense of Unicode, plus the four ASCII separators.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def blank(c: Column) -> Column:
    """Null, empty or spaces only."""
    return c.isNull() | (F.trim(c) == "")


def nonempty(c: Column) -> Column:
    """The value, or null when it is the empty string."""
    return F.nullif(c, F.lit(""))


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACE_RUN, " "))


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def casefold(c: Column) -> Column:
    """Lower case, with the letters that folding spells out in full."""
    folded = F.translate(F.lower(c), "ſς", "sσ")
    for letter, spelled in _SPELLED_OUT:
        folded = F.replace(folded, F.lit(letter), F.lit(spelled))
    return folded


def normalize_title(c: Column) -> Column:
    return collapse_spaces(casefold(c))


def match_key(c: Column) -> Column:
    """Title reduced to ASCII words, without a leading arXiv number."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\d{4}\.\d{4,5}\s+", "")
    return F.trim(F.regexp_replace(casefold(bare), r"[^a-z0-9]+", " "))


def analysis_document(title: Column, abstract: Column, keywords: Column) -> Column:
    """Title, abstract and keywords in one text; empty parts are left out."""
    return F.concat_ws(" ", nonempty(title), nonempty(abstract), nonempty(F.concat_ws(" ", keywords)))


def keyword_list(c: Column) -> Column:
    """Comma text to a list of trimmed, non-blank keywords."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda k: k != "")


def json_text(items: Column) -> Column:
    """A string array as JSON text with a space after each comma."""
    quoted = F.transform(items, lambda k: F.regexp_replace(F.to_json(F.array(k)), r"^\[|\]\z", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def unescape(c: Column) -> Column:
    """Decode HTML entities in Arrow batches."""
    @F.pandas_udf(StringType())
    def decoded(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return decoded(c)


def strip_markup(c: Column) -> Column:
    """Decode entities, then put a space in place of each tag.

    Only texts that hold an ``&`` travel to the Arrow UDF.
    """
    decoded = F.coalesce(unescape(F.when(F.contains(c, F.lit("&")), c)), c)
    return strip_tags(decoded)


def inverted_abstract(index: Column) -> Column:
    """Text from a word -> positions map, ordered by (position, word); empty gives null."""
    pairs = F.flatten(
        F.transform(
            F.map_entries(index),
            lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("pos"), e["key"].alias("word"))),
        )
    )
    return nonempty(F.concat_ws(" ", F.transform(F.sort_array(pairs), lambda p: p["word"])))


def title_case(term: Column) -> Column:
    """Upper-case each letter that does not follow a letter."""
    def cased(char: Column, index: Column) -> Column:
        previous = F.substring(term, index, F.lit(1))
        starts = (index == 0) | ~previous.rlike(r"\p{L}")
        return F.when(starts, F.upper(char)).otherwise(F.lower(char))

    return F.array_join(F.transform(F.split(term, ""), cased), "")


def cluster_label(terms: Column, cluster_id: Column) -> Column:
    named = F.array_join(F.transform(terms, title_case), " / ")
    fallback = F.concat(F.lit("方向 "), (cluster_id + 1).cast("string"))
    return F.coalesce(nonempty(named), fallback)
