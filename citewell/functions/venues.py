"""Venue and year facets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from citewell.functions.text import collapse_spaces, nonempty
from citewell.functions.vocab import CONFERENCES, VENUE_ALIASES

_ANY_CONFERENCE = "|".join(CONFERENCES)


def canonical_venue(venue: Column) -> Column:
    """First conference whose name the venue contains, else null."""
    upper = F.upper(venue)
    return reduce(
        lambda chain, name: chain.when(F.contains(upper, F.lit(name)), F.lit(name)),
        CONFERENCES[1:],
        F.when(F.contains(upper, F.lit(CONFERENCES[0])), F.lit(CONFERENCES[0])),
    )


def facet_venue(query: Column) -> Column:
    return nonempty(F.upper(F.regexp_extract(query, rf"(?iU)\bvenue:({_ANY_CONFERENCE})\b", 1)))


def facet_year(query: Column) -> Column:
    return nonempty(F.regexp_extract(query, r"(?iU)\byear:(20[0-9]{2})\b", 1)).try_cast("int")


def facet_text(query: Column) -> Column:
    """Query text without its venue and year facets."""
    bare = F.regexp_replace(query, rf"(?iU)\b(?:venue:(?:{_ANY_CONFERENCE})|year:20\d{{2}})\b", "")
    return collapse_spaces(bare)


def facets_match(want_venue: Column, want_year: Column, venue: Column, year: Column) -> Column:
    """Year equal if asked for; venue text holds an alias of the asked conference."""
    upper = F.upper(F.coalesce(venue, F.lit("")))
    venue_ok = want_venue.isNull()
    for name, aliases in VENUE_ALIASES.items():
        named = reduce(lambda a, b: a | b, [F.contains(upper, F.lit(alias)) for alias in aliases])
        venue_ok = venue_ok | ((want_venue == name) & named)
    year_ok = want_year.isNull() | F.coalesce(year == want_year, F.lit(False))
    return year_ok & F.coalesce(venue_ok, F.lit(False))


def path_venue(path: Column) -> Column:
    """First conference in the path that a year or a non-digit follows."""
    return nonempty(F.regexp_extract(F.upper(path), rf"(?U)({_ANY_CONFERENCE})(?=\D|20\d{{2}})", 1))


def path_year(path: Column) -> Column:
    return nonempty(F.regexp_extract(path, r"(?U)(20[0-9]{2})", 1)).try_cast("int")


def file_title(name: Column) -> Column:
    """Readable title from a file name."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")
    spaced = F.replace(stem, F.lit("_"), F.lit(" "))
    cut = F.regexp_replace(spaced, rf"(?iU)\b(?:{_ANY_CONFERENCE})\s+20\d{{2}}\s+paper\b.*$", "")
    return F.btrim(collapse_spaces(cut), F.lit(" ._-"))
