"""Saved responses of three public metadata services, turned into import rows.

Each reader takes JSON text files of response bodies.  Every row may carry ``query``,
the search text that produced the response, so that facets in it can filter the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citewell.functions.keys import doi_url, provider_key
from citewell.functions.text import inverted_abstract, nonempty, strip, strip_markup
from citewell.functions.venues import facet_venue, facet_year, facets_match
from citewell.sources.records import arrival, paper_rows, year_number

# One-or-many fields are VARIANT: a list, an object or a plain value, told apart after reading.
_DBLP_HITS = "result STRUCT<hits: STRUCT<hit: VARIANT>>"
_DBLP_PAGE = f"query STRING, {_DBLP_HITS}, pages ARRAY<STRUCT<query: STRING, {_DBLP_HITS.replace(' ', ': ', 1)}>>"
_DBLP_INFO = (
    "STRUCT<title: STRING, authors: STRUCT<author: VARIANT>, venue: STRING, year: STRING, "
    "doi: STRING, url: STRING, ee: VARIANT, key: STRING, type: STRING>"
)
_OPENALEX_PAGE = (
    "query STRING, results ARRAY<STRUCT<id: STRING, title: STRING, publication_year: INT, doi: STRING, "
    "primary_location: STRUCT<source: STRUCT<display_name: STRING>>, "
    "authorships: ARRAY<STRUCT<author: STRUCT<display_name: STRING>>>, "
    "concepts: ARRAY<STRUCT<display_name: STRING>>, abstract_inverted_index: MAP<STRING, ARRAY<INT>>>>"
)
_DATE = "STRUCT<`date-parts`: ARRAY<ARRAY<STRING>>>"
_CROSSREF_PAGE = (
    "query STRING, message STRUCT<items: ARRAY<STRUCT<DOI: STRING, title: ARRAY<STRING>, "
    "`container-title`: ARRAY<STRING>, author: ARRAY<STRUCT<given: STRING, family: STRING>>, "
    f"`published-print`: {_DATE}, `published-online`: {_DATE}, issued: {_DATE}, created: {_DATE}, "
    "URL: STRING, abstract: STRING, subject: ARRAY<STRING>>>>"
)


def one_or_many(value: Column) -> Column:
    """Array of variants from a variant that holds a list, one value, or nothing."""
    listed = F.try_variant_get(value, "$", "array<variant>")
    is_list = F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
    one = F.when(value.isNotNull() & ~F.is_variant_null(value), F.array(value))
    return F.coalesce(F.when(is_list, listed), one, F.array().cast("array<variant>"))


def _text_or_field(entry: Column, *fields: str) -> Column:
    """A plain string, or the first non-empty of ``fields`` when the entry is an object."""
    inner = F.coalesce(*[nonempty(F.try_variant_get(entry, f"$.{f}", "string")) for f in fields])
    is_object = F.startswith(F.schema_of_variant(entry), F.lit("OBJECT"))
    return F.when(is_object, inner).otherwise(nonempty(F.try_variant_get(entry, "$", "string")))


def _read_pages(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multi_line).withColumn("_at", arrival())


def _hits(pages: DataFrame, items: Column, name: str) -> DataFrame:
    """One row for each item of a page, with the page's query and its place."""
    numbered = pages.select(F.coalesce("query", F.lit("")).alias("query"), "_at", F.posexplode(items).alias("_place", name))
    return numbered.withColumn("_seq", F.struct("_at", "_place")).drop("_at", "_place")


def _with_query(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Import rows that keep ``query``."""
    return paper_rows(df, columns, carried=("query",))


def as_answers(records: DataFrame, source: str, priority: int) -> DataFrame:
    """Import rows with their ``query`` as staged answers of a source: ``source`` and ``priority`` are added."""
    return records.withColumns({"source": F.lit(source), "priority": F.lit(priority)})


def answers_of(queries: DataFrame, *sources: DataFrame) -> DataFrame:
    """``query_id`` and the rows of all sources whose page was fetched for that query's text."""
    rows = reduce(DataFrame.unionByName, sources)
    return queries.select("query_id", "query").join(rows, "query").drop("query")


def read_dblp(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Bare responses, or raw envelopes with a ``pages`` list; rows keep the ``query`` of their page."""
    pages = _read_pages(spark, path, _DBLP_PAGE, multi_line).select(
        "_at", F.posexplode(F.coalesce("pages", F.array(F.struct("query", "result")))).alias("_page", "page")
    ).select("page.query", F.col("_at").withField("place", F.col("_page")).alias("_at"), F.col("page.result.hits.hit").alias("hit"))
    hits = _hits(pages, one_or_many(F.col("hit")), "found")
    hits = hits.withColumn("info", F.try_variant_get("found", "$.info", _DBLP_INFO)).where("info IS NOT NULL")
    info = F.col("info")
    title = strip(F.coalesce(info["title"], F.lit("")))
    names = F.array_compact(
        F.transform(one_or_many(info["authors"]["author"]), lambda a: _text_or_field(a, "text", "name"))
    )
    editions = F.array_compact(
        F.transform(one_or_many(info["ee"]), lambda e: _text_or_field(e, "text", "href"))
    )
    return _with_query(
        hits.where(title != ""),
        {
            "title": title,
            "authors": F.transform(names, strip),
            "venue": info["venue"],
            "year": year_number(strip(info["year"])),
            "doi": info["doi"],
            "dblp_url": info["url"],
            "electronic_edition": editions,
            "dblp_key": info["key"],
            "paper_type": info["type"],
            "_seq": F.col("_seq"),
        },
    )


def read_openalex(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    items = _hits(_read_pages(spark, path, _OPENALEX_PAGE, multi_line), F.col("results"), "item")
    item, query = F.col("item"), F.col("query")
    title = strip(F.coalesce(item["title"], F.lit("")))
    venue, year = item["primary_location"]["source"]["display_name"], item["publication_year"]
    names = F.transform(item["authorships"], lambda a: nonempty(a["author"]["display_name"]))
    concepts = F.transform(item["concepts"], lambda c: nonempty(c["display_name"]))
    present = lambda items: F.coalesce(F.array_compact(items), F.array().cast("array<string>"))
    doi = nonempty(item["doi"])
    return _with_query(
        items.where((title != "") & facets_match(facet_venue(query), facet_year(query), venue, year)),
        {
            "title": title,
            "authors": present(names),
            "venue": venue,
            "year": F.nullif(year, F.lit(0)),
            "doi": item["doi"],
            "electronic_edition": F.when(doi.isNotNull(), F.array(doi_url(doi))).otherwise(F.array()),
            "dblp_key": provider_key("openalex", item["id"], title),
            "paper_type": F.lit("OpenAlex"),
            "abstract": inverted_abstract(item["abstract_inverted_index"]),
            "keywords": present(concepts),
            "_seq": F.col("_seq"),
        },
    )


def crossref_year(item: Column) -> Column:
    """Year from the first date field that has parts; a part that is no number gives null."""
    def parts(field: str) -> Column:
        return F.get(item[field]["date-parts"], F.lit(0))

    chain = None
    for field in ("published-print", "published-online", "issued", "created"):
        present = F.coalesce(F.size(parts(field)), F.lit(0)) > 0
        year = F.get(parts(field), F.lit(0)).try_cast("int")
        chain = F.when(present, year) if chain is None else chain.when(present, year)
    return chain


def read_crossref(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    items = _hits(_read_pages(spark, path, _CROSSREF_PAGE, multi_line), F.col("message.items"), "item")
    item, query = F.col("item"), F.col("query")
    first = lambda name: strip(F.coalesce(F.get(item[name], F.lit(0)), F.lit("")))
    title, venue, year = first("title"), nonempty(first("container-title")), crossref_year(item)
    names = F.transform(
        item["author"], lambda a: F.concat_ws(" ", nonempty(a["given"]), nonempty(a["family"]))
    )
    url = nonempty(item["URL"])
    empty = F.array().cast("array<string>")
    return _with_query(
        items.where((title != "") & facets_match(facet_venue(query), facet_year(query), venue, year)),
        {
            "title": title,
            "authors": F.coalesce(names, empty),
            "venue": venue,
            "year": year,
            "doi": item["DOI"],
            "electronic_edition": F.when(url.isNotNull(), F.array(url)).otherwise(F.array()),
            "dblp_key": provider_key("crossref", item["DOI"], title),
            "paper_type": F.lit("Crossref"),
            "abstract": strip_markup(nonempty(item["abstract"])),
            "keywords": F.coalesce(item["subject"], empty),
            "_seq": F.col("_seq"),
        },
    )
