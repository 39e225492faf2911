"""Stable keys and resolver addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from citewell.functions.text import nonempty, normalize_title

DOI_RESOLVER = "https://doi.org/"


def hashed_key(prefix: str, value: Column) -> Column:
    """``prefix:`` and the first 24 hex digits of the value's SHA-256."""
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(value, 256), 1, 24))


def title_key(prefix: str, title: Column) -> Column:
    return hashed_key(prefix, normalize_title(title))


def provider_key(prefix: str, identifier: Column, title: Column) -> Column:
    """``prefix:`` and the provider's identifier, or the title where it has none."""
    return F.concat(F.lit(prefix + ":"), F.coalesce(nonempty(identifier), title))


def doi_url(doi: Column) -> Column:
    return F.concat(F.lit(DOI_RESOLVER), F.regexp_replace(doi, "^" + DOI_RESOLVER, ""))


def bare_doi(doi: Column) -> Column:
    """Lower-case DOI without resolver prefix, for comparing the two stored forms."""
    return F.lower(F.regexp_replace(doi, r"(?i)^https?://(dx\.)?doi\.org/", ""))


def file_uri(path: Column) -> Column:
    """Percent-encoded ``file://`` address of an absolute path; a path that has a scheme stays as it is."""
    encoded = F.url_encode(path)
    for escaped, plain in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(escaped), F.lit(plain))
    return F.when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), path).otherwise(F.concat(F.lit("file://"), encoded))


def dedup_identity(key: Column, doi: Column, title: Column) -> Column:
    """Key, else DOI, else lower-case title; empty text counts as missing."""
    return F.trim(F.coalesce(nonempty(key), nonempty(doi), F.lower(title)))
