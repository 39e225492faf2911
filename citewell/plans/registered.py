"""Named queries over the given tables; each takes a session and a table folder."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.functions import keys, text, tokens, venues
from citewell.operators import catalog, collect, grid, keywords, match, search, terms, topics, trends
from citewell.operators.rowindex import with_row_index
from citewell.plans import refresh as derive
from citewell.plans.library import Library
from citewell.session import checkpoint_root
from citewell.sources import listing, providers, records, sinks
from citewell.sources.corpus import FETCHED_AT, papers, table
from citewell.streaming.imports import paper_stream, start_import

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the SQL twins.
DRILLDOWN_KEYWORD = "tion"
SEARCH_TEXT = "Src1"
WILDCARD_TEXT = "the%thanedble"
EXACT_TITLE = "The and attion to  thanedble the, anea. Eriner THANEA."
RUN_AT = "2025-01-01 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _at():
    return F.lit(FETCHED_AT).cast("timestamp")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files a query writes and reads back."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Tokens, vocabulary, weights


@query
def normalized_titles(spark, sf_dir):
    return papers(spark, sf_dir).select("id", "title_normalized")


@query
def match_keys(spark, sf_dir):
    numbered = F.concat(F.lit("2508.13073 "), F.col("text"))
    return table(spark, sf_dir, "benchmark").select("item_id", text.match_key(numbered).alias("match_key"))


@query
def analysis_documents(spark, sf_dir):
    document = text.analysis_document(F.col("title"), F.col("abstract"), F.col("keywords"))
    return papers(spark, sf_dir).select("id", F.md5(document).alias("document_md5"), F.length(document).cast("bigint").alias("n_chars"))


@query
def token_df(spark, sf_dir):
    corpus = terms.paper_tokens(papers(spark, sf_dir))
    return terms.counted(F.array_distinct("tokens"), corpus).withColumnRenamed("n", "df")


@query
def conversation_token_df(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(tokens.tokens(F.col("text")).alias("tokens"))
    return terms.counted(F.array_distinct("tokens"), turns).withColumnRenamed("n", "df")


@query
def vocab_4000(spark, sf_dir):
    chosen = terms.vocabulary(terms.tokenized(papers(spark, sf_dir)))
    return spark.createDataFrame(chosen, "term STRING, n BIGINT")


@query
def tfidf_weights(spark, sf_dir):
    corpus = terms.weigh(papers(spark, sf_dir))
    return corpus.long().select("paper_id", corpus.term(F.col("idx")).alias("term"), F.round("weight", 6).alias("weight"))


@query
def keyword_weight(spark, sf_dir):
    stats = keywords.term_stats(terms.weigh(papers(spark, sf_dir)))
    return stats.select("keyword", "paper_count", F.round("total", 6).alias("weight"))


@query
def top_keywords(spark, sf_dir):
    stats = keywords.term_stats(terms.weigh(papers(spark, sf_dir)))
    return keywords.rank_keywords(stats, _at()).drop("run_at")


def _links(spark, sf_dir):
    corpus = terms.weigh(papers(spark, sf_dir))
    ranked = keywords.rank_keywords(keywords.term_stats(corpus), _at())
    return keywords.keyword_links(corpus, [r["keyword"] for r in ranked.collect()])


@query
def keyword_link_table(spark, sf_dir):
    return _links(spark, sf_dir)


@query
def drilldown(spark, sf_dir):
    found = keywords.papers_for_keyword(_links(spark, sf_dir), papers(spark, sf_dir), DRILLDOWN_KEYWORD, "250")
    return found.select("id", "title", "venue", "year")


@query
def paper_vectors(spark, sf_dir):
    corpus = terms.weigh(papers(spark, sf_dir))
    vector = keywords.paper_vector(corpus, F.col("weights"))
    exploded = corpus.vectors.select("paper_id", F.posexplode(vector).alias("position", "e"))
    return exploded.select("paper_id", "position", F.col("e.term").alias("term"), F.col("e.weight").alias("weight"))


@query
def trends_all(spark, sf_dir):
    return trends.select_trends(trends.trend_stats(terms.weigh(papers(spark, sf_dir))))


@query
def trends_selected(spark, sf_dir):
    words = tokens.one_per_row(table(spark, sf_dir, "benchmark"), tokens.tokens(F.col("text")), "keyword")
    return trends.select_trends(trends.trend_stats(terms.weigh(papers(spark, sf_dir))), words)


@query
def trends_listed(spark, sf_dir):
    stats = trends.trend_stats(terms.weigh(papers(spark, sf_dir)))
    return trends.select_trends(stats, [" " + DRILLDOWN_KEYWORD.upper(), "que", " "])


@query
def trend_year_venue_axes(spark, sf_dir):
    axes = trends.trend_axes(trends.trend_stats(terms.weigh(papers(spark, sf_dir))))
    return axes.select(F.concat_ws(",", F.transform("years", lambda y: y.cast("string"))).alias("years"), F.concat_ws(",", "venues").alias("venues"))


@query
def title_cased_terms(spark, sf_dir):
    chosen = terms.vocabulary(terms.tokenized(papers(spark, sf_dir)))
    return spark.createDataFrame(chosen, "term STRING, n BIGINT").select("term", text.title_case(F.col("term")).alias("label"))


@query
def run_metadata(spark, sf_dir):
    corpus = papers(spark, sf_dir)
    n = corpus.count()
    return derive.run_metadata(corpus, RUN_AT, topics.cluster_count(n), n).drop("run_at")


# Topics: iterative, so no SQL twin


@query
def topic_clusters(spark, sf_dir):
    corpus = terms.weigh(papers(spark, sf_dir))
    clusters = topics.topic_clusters(corpus, topics.assign(corpus), _at())
    return topics.top_topics(clusters).select(
        "cluster_id", "label", "paper_count", F.round("score", 6).alias("score"), F.concat_ws(",", "terms").alias("terms")
    )


@query
def cluster_assign(spark, sf_dir):
    return topics.assign(terms.weigh(papers(spark, sf_dir))).select("paper_id", "cluster_id")


@query
def refresh_summary(spark, sf_dir):
    """Whole refresh; one line per derived table row class."""
    built = derive.refresh(papers(spark, sf_dir), RUN_AT)
    meta, top, ranked = derive.summary(built)
    return (
        meta.select(F.lit("papers").alias("item"), F.lit("").alias("name"), "paper_count")
        .unionByName(top.select(F.lit("topic").alias("item"), F.col("label").alias("name"), "paper_count"))
        .unionByName(ranked.select(F.lit("keyword").alias("item"), F.col("keyword").alias("name"), "paper_count"))
    )


@query
def embedding_clusters(spark, sf_dir):
    """K-means starts over the given vectors: cluster sizes."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("weights"))
    model = topics.best_start(vectors, topics.cluster_count(vectors.count()))
    return model.transform(vectors).groupBy("cluster_id").agg(F.count("*").alias("vectors"))


# Search


@query
def list_all(spark, sf_dir):
    return search.search(papers(spark, sf_dir), "  ", limit=1000).select("id", "title", "venue", "year")


@query
def get_paper(spark, sf_dir):
    return search.paper_by_id(papers(spark, sf_dir), 7).select("id", "title", "venue", "year")


@query
def search_like(spark, sf_dir):
    return search.search(papers(spark, sf_dir), SEARCH_TEXT).select("id", "title", "venue", "year")


@query
def search_wildcard(spark, sf_dir):
    return search.search(papers(spark, sf_dir), WILDCARD_TEXT).select("id", "title", "venue", "year")


@query
def search_exact(spark, sf_dir):
    return search.search(papers(spark, sf_dir), EXACT_TITLE, exact=True).select("id", "title", "venue", "year")


@query
def backlog(spark, sf_dir):
    return search.missing_abstracts(papers(spark, sf_dir))


def _facet_queries(spark, sf_dir):
    """Whole benchmark texts, some with facets; whole titles of labelled documents; source names; facets alone."""
    item, doc = F.col("item_id"), F.col("doc_id")
    venue = lambda n: F.element_at(F.array(F.lit("cvpr"), F.lit("Iccv"), F.lit("ECCV")), (n % 9 / 3 + 1).cast("int"))
    facets = F.when(item % 3 == 0, F.concat(F.lit("venue:"), venue(item)))
    year = F.when(item % 4 == 1, F.concat(F.lit("year:"), (2022 + item % 5).cast("string")))
    texts = table(spark, sf_dir, "benchmark").select(item.alias("query_id"), F.concat_ws(" ", facets, "text", year).alias("query"))
    docs = table(spark, sf_dir, "documents")
    asked = docs.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    titles = asked.select((1_000_000_000 + doc).alias("query_id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("query"))
    sources = docs.groupBy("source").agg(F.min("doc_id").alias("doc_id")).select((2_000_000_000 + doc).alias("query_id"), F.col("source").alias("query"))
    cells = asked.select((3_000_000_000 + doc).alias("query_id"), F.concat(F.lit("year:"), 2022 + doc % 5, F.lit(" venue:"), venue(doc)).alias("query"))
    return texts.unionByName(titles).unionByName(sources).unionByName(cells)


@query
def parsed_queries(spark, sf_dir):
    return search.parsed_queries(_facet_queries(spark, sf_dir))


@query
def batch_search(spark, sf_dir):
    return search.batch_search(papers(spark, sf_dir), _facet_queries(spark, sf_dir)).select("query_id", "position", "id", "year", "venue")


@query
def batch_matches(spark, sf_dir):
    return search.query_matches(papers(spark, sf_dir), _facet_queries(spark, sf_dir), counted=True)


@query
def facet_counts(spark, sf_dir):
    """Papers per grid query, by facets alone."""
    cells = grid.grid_queries(spark).select(F.col("query").alias("query_id"), "query")
    return search.query_matches(papers(spark, sf_dir), cells).groupBy("query_id").agg(F.count("*").alias("matches"))


@query
def stored_of_fetched(spark, sf_dir):
    fetched = table(spark, sf_dir, "labels").select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("dblp_key"))
    return search.stored_of(papers(spark, sf_dir), fetched).select("id", "title")


# Catalog changes


def _batch(spark, sf_dir):
    """Import rows that hit stored keys twice, bring new keys, and miss some keys."""
    doc = F.col("doc_id")
    n = lambda e: F.expr(e)
    key = F.when(doc % 11 == 0, F.lit(None)).when(doc % 5 == 0, F.concat(F.lit("new:"), n("doc_id div 10"))).otherwise(F.concat(F.lit("doc:"), n("doc_id div 2")))
    return records.paper_rows(
        table(spark, sf_dir, "documents"),
        {
            "title": F.concat(F.lit("Batch "), F.split_part("text", F.lit("\n"), F.lit(1))),
            "venue": F.when(doc % 3 == 0, F.concat(F.lit("Workshop "), F.col("lang"))),
            "year": F.when(doc % 4 != 0, 2000 + doc % 20),
            "doi": F.when(doc % 6 == 0, F.concat(F.lit("10.1/"), doc.cast("string"))),
            "dblp_key": key,
            "paper_type": F.lit("batch"),
            "abstract": F.when(doc % 7 == 0, F.col("text")),
            "keywords": F.when(doc % 2 == 0, F.array("source")),
            "_seq": doc,
        },
    )


_MERGED = ("id", "title", "title_normalized", "venue", "year", "doi", "dblp_key", "paper_type", "source_query")


def _flat(df):
    return df.select(*_MERGED, F.md5("abstract").alias("abstract_md5"), F.concat_ws(",", "keywords").alias("keywords"))


@query
def merge_upsert(spark, sf_dir):
    return _flat(catalog.merge_upsert(papers(spark, sf_dir), _batch(spark, sf_dir), "batch-1", _at()))


@query
def update_papers(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    edits = labels.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("  Edited "), F.col("source"), F.lit(" ")).alias("title"),
        F.when(F.col("quality") == 1, "ECCV").alias("venue"),
        F.when(F.col("toxic") == 0, 2024).alias("year"),
        text.keyword_list(F.concat("lang", F.lit(" , ,new"))).alias("keywords"),
    )
    return _flat(catalog.update_papers(papers(spark, sf_dir), edits, _at()))


@query
def set_abstracts(spark, sf_dir):
    found = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Quality "), "quality").alias("abstract"),
        F.when(F.col("toxic") == 1, F.array(F.lit("flagged"))).alias("keywords"),
    )
    return _flat(catalog.set_abstracts(papers(spark, sf_dir), found))


@query
def delete_ids(spark, sf_dir):
    return _flat(catalog.delete_ids(papers(spark, sf_dir), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))))


@query
def deleted_rows(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return catalog.matching_ids(papers(spark, sf_dir), ids).agg(F.count("*").alias("deleted"))


@query
def purge_source(spark, sf_dir):
    return _flat(catalog.purge_source(papers(spark, sf_dir), "src3"))


@query
def fill_venues(spark, sf_dir):
    return catalog.fill_venues(papers(spark, sf_dir).select("id", "venue", "year"))


@query
def paper_count(spark, sf_dir):
    return papers(spark, sf_dir).agg(F.count("*").alias("paper_count"))


@query
def key_violations(spark, sf_dir):
    """Repeated DOIs, with resolver addresses and bare forms counted as one."""
    doi = F.concat(F.when(F.col("doc_id") % 2 == 0, "https://doi.org/").otherwise(""), F.lit("10.5/"), F.expr("doc_id div 3"))
    held = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 7 != 0, doi).alias("doi"))
    return catalog.key_violations(held, "doi", canonical_doi=True)


@query
def doi_clashes(spark, sf_dir):
    doi = F.concat(F.lit("10.9/"), F.col("source"), F.lit("/"), F.expr("doc_id div 30"))
    docs = table(spark, sf_dir, "documents").select("doc_id", doi.alias("doi"))
    touched = table(spark, sf_dir, "labels").join(docs, "doc_id").where("toxic = 1").select("doi")
    return catalog.doi_clashes(docs, touched)


def _collected(spark, sf_dir):
    """Records of two sources; titles and keys repeat."""
    doc = F.col("doc_id")
    one = records.paper_rows(
        table(spark, sf_dir, "documents"),
        {
            "title": F.split_part("text", F.lit("\n"), F.lit(1)),
            "dblp_key": F.when(doc % 3 == 0, "").when(doc % 3 == 1, F.concat(F.lit(" k"), F.expr("doc_id div 4"))),
            "doi": F.when(doc % 5 == 0, F.concat(F.lit("10.2/"), F.expr("doc_id div 20"))),
            "venue": F.col("source"),
            "_seq": doc,
        },
    )
    two = records.paper_rows(
        table(spark, sf_dir, "part"),
        {"title": F.upper("p_name"), "venue": F.col("p_brand"), "_seq": 1_000_000_000 + F.col("p_partkey")},
    )
    return collect.union_sources(one, two)


@query
def union_sources(spark, sf_dir):
    return _collected(spark, sf_dir).select("_seq", "title", "venue")


@query
def dedup_first(spark, sf_dir):
    return collect.first_by_identity(_collected(spark, sf_dir)).select("_seq", "title", "dblp_key", "doi", "venue")


@query
def cap_per_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("_seq"))
    return collect.cap_per_query(docs, 20, "source")


# Matching


@query
def venue_backfill(spark, sf_dir):
    place = F.element_at(F.array(F.lit("CVPR Workshops"), F.lit("Nowhere"), F.lit("Proc. eccv")), (F.col("doc_id") % 3 + 1).cast("int"))
    known = table(spark, sf_dir, "documents").select(
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), place.alias("venue"),
        (2010 + F.col("doc_id") % 10).cast("int").alias("year"), F.col("doc_id").alias("_seq"),
    )
    return match.backfill_venues(papers(spark, sf_dir), known).select("id", "title", "venue", "year")


@query
def venue_backfill_parts(spark, sf_dir):
    """Few distinct names over many rows on both sides."""
    brand = F.substring_index("p_brand", "#", -1).cast("int")
    place = F.element_at(F.array(F.lit("iccv 2023"), F.lit("none"), F.lit(""), F.lit("CVPR")), (brand % 4 + 1).cast("int"))
    part = table(spark, sf_dir, "part")
    blank_parts = part.select(
        F.col("p_partkey").alias("id"), "p_name", text.normalize_title(F.col("p_name")).alias("title_normalized"),
        F.lit("").alias("venue"), F.lit(None).cast("int").alias("year"),
    )
    known = part.select(F.upper("p_name").alias("title"), place.alias("venue"), F.col("p_size").alias("year"), F.col("p_partkey").alias("_seq"))
    return match.backfill_venues(blank_parts, known).select("id", "p_name", "venue", "year")


def _source_hits(spark, sf_dir):
    """Two sources' answers; one of them has none for queries of some document sources."""
    doc = F.col("doc_id")
    first = (doc % 3 == 0) & (F.substring("source", 4, 10).cast("int") % 10 < 6)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("q"), doc % 70).alias("query_id"), F.when(first, "OpenAlex").otherwise("Crossref").alias("source"),
        F.when(first, 0).otherwise(1).alias("priority"), doc.alias("_seq"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), (2000 + doc % 25).cast("int").alias("year"), F.col("source").alias("venue"),
    )


@query
def source_priority(spark, sf_dir):
    return collect.first_source_wins(_source_hits(spark, sf_dir), "query_id").select("query_id", "source", "_seq")


@query
def sources_without_answer(spark, sf_dir):
    asked = table(spark, sf_dir, "documents").select(F.concat(F.lit("q"), F.col("doc_id") % 90).alias("query_id"))
    return collect.empty_sources(asked, _source_hits(spark, sf_dir), {"OpenAlex": 0, "Crossref": 1}, "query_id")


@query
def local_first(spark, sf_dir):
    """Whole texts of the benchmark and source names asked of the catalog first, then of the staged sources."""
    asked = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("q"), F.col("item_id")).alias("query_id"), F.col("text").alias("query")
    )
    docs = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    asked = asked.unionByName(docs.select(F.concat(F.lit("s"), "doc_id").alias("query_id"), F.col("source").alias("query")))
    return match.local_first(papers(spark, sf_dir), asked, _source_hits(spark, sf_dir)).select("query_id", "source", "position", "title", "year")


def _titles_and_records(spark, sf_dir):
    stored = papers(spark, sf_dir)
    wanted = stored.where(text.blank(F.col("abstract"))).select(F.col("id").alias("paper_id"), "title")
    known = stored.where(~text.blank(F.col("abstract"))).select(F.col("id").alias("_seq"), "title", "abstract", "keywords")
    return wanted, known


@query
def title_lookup(spark, sf_dir):
    return match.title_hits(*_titles_and_records(spark, sf_dir)).select("paper_id", "query", "_seq", "title")


@query
def abstract_match(spark, sf_dir):
    found = match.matched_abstracts(*_titles_and_records(spark, sf_dir))
    return found.select("id", F.md5("abstract").alias("abstract_md5"), F.round("similarity", 6).alias("similarity"))


@query
def abstract_match_equal(spark, sf_dir):
    """The part of ``abstract_match`` whose titles have a record of the same match key."""
    found = match.matched_abstracts(*_titles_and_records(spark, sf_dir)).where("similarity = 1")
    return found.select("id", F.md5("abstract").alias("abstract_md5"), "similarity")


@query
def grid_coverage(spark, sf_dir):
    return grid.grid_coverage(papers(spark, sf_dir))


# Expressions


@query
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("body"))


@query
def strip_markup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_markup(F.col("html")).alias("body"))


@query
def hash_keys(spark, sf_dir):
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select(
        "doc_id", keys.title_key("user-import", title).alias("import_key"), keys.hashed_key("local-pdf", F.concat(F.lit("/data/"), title)).alias("path_key"),
        keys.provider_key("openalex", F.when(F.col("doc_id") % 2 == 0, ""), title).alias("provider_key"),
    )


@query
def doi_urls(spark, sf_dir):
    doi = F.concat(F.when(F.col("doc_id") % 2 == 0, "https://doi.org/").otherwise(""), F.lit("10.1/"), F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", keys.doi_url(doi).alias("url"))


def _word_positions(documents):
    """``(doc_id, index)``: word -> positions map of the whole text.

    Texts are shuffled once, by document; the map is built row by row: (word, position) pairs are sorted,
    and each word's run of pairs becomes an entry.  Positions of documents of one id are put together.
    """
    texts = documents.where("text IS NOT NULL").groupBy("doc_id").agg(F.collect_list("text").alias("texts"))
    placed = texts.select("doc_id", F.flatten(F.transform("texts", lambda t: F.transform(
        F.split(t, " "), lambda word, pos: F.struct(word.alias("word"), pos.alias("pos"))
    ))).alias("placed"))
    ordered = placed.select("doc_id", F.sort_array("placed").alias("placed"))
    starts = F.expr("filter(sequence(1, size(placed)), i -> i = 1 or placed[i - 1].word <> placed[i - 2].word)")
    runs = ordered.select("doc_id", "placed", starts.alias("starts"))
    ends = F.expr("concat(slice(starts, 2, size(starts) - 1), array(size(placed) + 1))")
    runs = runs.select("doc_id", "placed", F.arrays_zip("starts", ends.alias("ends")).alias("runs"))
    entries = F.expr("transform(runs, r -> struct(placed[r.starts - 1].word as word, transform(slice(placed, r.starts, r.ends - r.starts), p -> p.pos) as positions))")
    return runs.select("doc_id", F.map_from_entries(entries).alias("index"))


@query
def inverted_abstract(spark, sf_dir):
    """Word -> positions maps built from whole texts, then read back as text."""
    index = _word_positions(table(spark, sf_dir, "documents"))
    return index.select("doc_id", F.md5(text.inverted_abstract(F.col("index"))).alias("text_md5"))


@query
def canonical_venues(spark, sf_dir):
    raw = F.concat(F.lit("Proc. "), F.coalesce(F.lower("venue"), F.lit("misc")), F.lit(" and ECCV"))
    return papers(spark, sf_dir).select("id", venues.canonical_venue(F.when(F.col("id") % 2 == 0, raw).otherwise(F.col("venue"))).alias("venue"))


@query
def keyword_lists(spark, sf_dir):
    """Keywords of every line of a text."""
    listed = text.keyword_list(F.replace("text", F.lit("\n"), F.lit(",")))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(listed).alias("position", "keyword"))


# Sources and sinks: files are derived from the tables, then read


@query
def import_records(spark, sf_dir):
    out = _scratch(spark, "records")
    doc = F.col("doc_id")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    rows = table(spark, sf_dir, "documents").select(
        F.when(doc % 13 != 0, F.concat(F.lit(" "), title, F.lit(" "))).alias("title"),
        F.when(doc % 2 == 0, F.array("lang", "source")).alias("authors"),
        F.when(doc % 4 != 0, (2000 + doc % 25).cast("string")).alias("year"),
        F.when(doc % 3 == 0, F.concat(F.lit("k:"), doc)).alias("dblp_key"),
        F.when(doc % 5 == 0, "").alias("paper_type"),
        F.col("text").alias("abstract"),
    )
    rows.write.json(out)
    return records.read_records(spark, out).select(
        "title", F.concat_ws(",", "authors").alias("authors"), "year", "dblp_key", "paper_type", F.md5("abstract").alias("abstract_md5")
    )


@query
def import_titles(spark, sf_dir):
    out = _scratch(spark, "titles")
    table(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(out)
    return records.read_titles(spark, out).groupBy("title", "venue", "year", "dblp_key", "paper_type").agg(F.count("*").alias("n"))


@query
def dblp_pages(spark, sf_dir):
    """Saved pages: hits as a list, or one bare object; authors and links in all their shapes."""
    doc = F.col("doc_id")
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]\z", "")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    author = F.when(doc % 3 == 0, quoted(F.col("lang"))).when(
        doc % 3 == 1, F.to_json(F.struct(F.col("lang").alias("text")))
    ).otherwise(F.concat(F.lit("["), F.to_json(F.struct(F.lit("").alias("text"), F.col("source").alias("name"))), F.lit(","), quoted(F.concat(F.lit(" "), "lang")), F.lit("]")))
    link = F.when(doc % 2 == 0, quoted(F.concat(F.lit("http://x/"), doc))).otherwise(F.to_json(F.struct(F.concat(F.lit("http://y/"), doc).alias("href"))))
    hit = F.concat(
        F.lit('{"info":{"title":'), quoted(title), F.lit(',"authors":{"author":'), author, F.lit('},"venue":'), quoted(F.col("source")),
        F.lit(',"year":"'), F.when(doc % 9 == 0, "n.d.").otherwise((2000 + doc % 25).cast("string")), F.lit('","ee":'), link,
        F.lit(',"key":"conf/'), doc.cast("string"), F.lit('","type":"Conference"}}'),
    )
    hits = table(spark, sf_dir, "documents").select(F.expr("doc_id div 4").alias("page"), "doc_id", hit.alias("hit"))
    listed = F.when(F.size("hits") == 1, F.element_at("hits", 1)).otherwise(F.concat(F.lit("["), F.concat_ws(",", "hits"), F.lit("]")))
    out = _scratch(spark, "dblp")
    single = hits.where(doc % 4 == 3).select(F.array("hit").alias("hits"))
    many = hits.where(doc % 4 != 3).groupBy("page").agg(F.collect_list("hit").alias("hits")).select("hits")
    many.unionByName(single).select(F.concat(F.lit('{"result":{"hits":{"@total":"4","hit":'), listed, F.lit("}}}")).alias("value")).write.text(out)
    return providers.read_dblp(spark, out).select(
        "dblp_key", "title", F.concat_ws(",", "authors").alias("authors"), "venue", "year", F.concat_ws(",", "electronic_edition").alias("links"), "paper_type"
    )


@query
def openalex_pages(spark, sf_dir):
    doc = F.col("doc_id")
    index = _word_positions(table(spark, sf_dir, "documents"))
    doi = F.concat(F.when(doc % 2 == 0, "https://doi.org/").otherwise(""), F.lit("10.1/"), doc)
    item = F.struct(
        F.when(doc % 3 != 0, F.concat(F.lit("W"), doc)).alias("id"), F.col("title"),
        (2022 + doc % 3).cast("int").alias("publication_year"), F.when(doc % 5 != 0, doi).alias("doi"),
        F.struct(F.struct(F.when(doc % 4 != 0, "European Conference on Computer Vision").otherwise(F.col("source")).alias("display_name")).alias("source")).alias("primary_location"),
        F.array(F.struct(F.struct(F.col("lang").alias("display_name")).alias("author")), F.struct(F.struct(F.lit("").alias("display_name")).alias("author"))).alias("authorships"),
        F.array(F.struct(F.col("source").alias("display_name"))).alias("concepts"), F.col("index").alias("abstract_inverted_index"),
    )
    wanted = F.when(doc % 2 == 0, "vision venue:ECCV year:2023").otherwise("vision")
    head = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    page = head.join(index, "doc_id").select(wanted.alias("query"), F.array(item).alias("results"))
    out = _scratch(spark, "openalex")
    page.write.json(out)
    return providers.read_openalex(spark, out).select(
        "dblp_key", "title", F.concat_ws(",", "authors").alias("authors"), "venue", "year", "doi", F.concat_ws(",", "electronic_edition").alias("links"),
        F.md5("abstract").alias("abstract_md5"), F.concat_ws(",", "keywords").alias("keywords"),
    )


@query
def crossref_pages(spark, sf_dir):
    """Abstracts are the given pages' markup."""
    page = F.col("page_id")
    date = lambda c: F.struct(F.array(F.array(c.cast("string"), F.lit("1"))).alias("date-parts"))
    item = F.struct(
        F.when(page % 2 == 0, F.concat(F.lit("10.3/"), page)).alias("DOI"), F.array("url").alias("title"),
        F.when(page % 3 == 0, F.array(F.lit("ICCV"))).otherwise(F.array().cast("array<string>")).alias("container-title"),
        F.array(F.struct(F.lit("Ada").alias("given"), F.lit("Lee").alias("family")), F.struct(F.lit(None).cast("string").alias("given"), F.lit(None).cast("string").alias("family"))).alias("author"),
        F.when(page % 4 == 0, date(2000 + page % 20)).alias("published-print"), F.when(page % 4 == 1, date(F.lit("soon"))).alias("published-online"),
        date(1990 + page % 5).alias("issued"), date(F.lit("1980")).alias("created"), F.when(page % 5 != 0, F.col("url")).alias("URL"),
        F.when(page % 6 != 0, F.col("html")).alias("abstract"), F.array(F.lit("Vision")).alias("subject"),
    )
    out = _scratch(spark, "crossref")
    table(spark, sf_dir, "pages").select(F.lit("any").alias("query"), F.struct(F.array(item).alias("items")).alias("message")).write.json(out)
    return providers.read_crossref(spark, out).select(
        "dblp_key", "title", F.concat_ws(",", "authors").alias("authors"), "venue", "year", F.concat_ws(",", "electronic_edition").alias("links"),
        F.md5("abstract").alias("abstract_md5"), F.concat_ws(",", "keywords").alias("keywords"),
    )


@query
def answers_from_pages(spark, sf_dir):
    """Saved pages of two services, read back as answers of the queries they were fetched for, asked local-first."""
    docs = table(spark, sf_dir, "documents")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    fetched_for = F.concat(F.lit("zq~ "), F.col("source"))
    openalex, dblp = _scratch(spark, "answers-openalex"), _scratch(spark, "answers-dblp")
    item = F.struct(F.concat(F.lit("W"), F.col("doc_id")).alias("id"), title.alias("title"), F.lit(2024).alias("publication_year"))
    docs.where("lang = 'en'").select(fetched_for.alias("query"), F.array(item).alias("results")).write.json(openalex)
    info = F.struct(title.alias("title"), F.concat(F.lit("conf/"), F.col("doc_id")).alias("key"), F.lit("2023").alias("year"))
    hit = F.struct(F.struct(F.struct(info.alias("info")).alias("hit")).alias("hits"))
    docs.select(fetched_for.alias("query"), hit.alias("result")).write.json(dblp)
    named = docs.groupBy("source").agg(F.min("doc_id").alias("n"))
    asked = named.select(F.concat(F.lit("local"), "n").alias("query_id"), F.col("source").alias("query")).unionByName(
        named.select(F.concat(F.lit("fetched"), "n").alias("query_id"), fetched_for.alias("query"))
    )
    answers = providers.answers_of(
        asked, providers.as_answers(providers.read_openalex(spark, openalex), "OpenAlex", 0),
        providers.as_answers(providers.read_dblp(spark, dblp), "DBLP", 1),
    )
    shown = match.local_first(papers(spark, sf_dir), asked, answers, limit=1000)
    return shown.groupBy("query_id", "source").agg(F.count("*").alias("n"), F.min("title").alias("first_title"), F.max("year").alias("last_year"))


@query
def unreadable_lines(spark, sf_dir):
    """Documents as JSON lines, some cut short or with a field of another kind; what cannot be read is counted."""
    out = _scratch(spark, "unreadable")
    line = F.to_json(F.struct(F.concat(F.lit("t"), F.col("doc_id")).alias("title"), F.array("lang").alias("authors"), F.col("text").alias("abstract")))
    kept = F.when(F.col("lang") == "de", F.substring(line, 1, 20)).when(
        F.col("lang") == "fr", F.replace(line, F.lit('["fr"]'), F.lit('"fr"'))
    ).otherwise(line)
    table(spark, sf_dir, "documents").select(kept.alias("value")).write.text(out)
    none = F.lit(0).cast("bigint")
    counts = records.unreadable_counts(spark, out).select("lines", "lost", none.alias("imported"))
    read = records.read_records(spark, out).agg(F.count("*").alias("imported")).select(none.alias("lines"), none.alias("lost"), "imported")
    return counts.unionByName(read).agg(*[F.sum(c).alias(c) for c in ("lines", "lost", "imported")])


@query
def pdf_listing(spark, sf_dir):
    """A path per document; some downloads are not finished."""
    doc = F.col("doc_id")
    folder = F.element_at(F.array(F.lit("/data/ICCV2025/"), F.lit("/data/CV 2024 综述/"), F.lit("/x/cvpr papers/"), F.lit("/y/ECCV1999/")), (doc % 4 + 1).cast("int"))
    name = F.concat(F.col("lang"), F.lit("_"), F.col("source"), F.when(doc % 3 == 0, " CVPR 2023 paper_final").otherwise("__v1. "))
    ending = F.when(doc % 7 == 0, ".pdf.baiduyun.downloading.pdf").when(doc % 11 == 0, ".PDF").otherwise(".pdf")
    paths = table(spark, sf_dir, "documents").select(F.concat(folder, doc, F.lit("/"), name, ending).alias("path"))
    return listing.from_paths(paths).select("title", "venue", "year", "dblp_key", F.concat_ws(",", "electronic_edition").alias("uri"), "paper_type")


@query
def batches_of_50(spark, sf_dir):
    return sinks.numbered_batches(papers(spark, sf_dir).select("id", "title", "year")).select("id", "row_index", "batch_no")


@query
def lineitem_rows(spark, sf_dir):
    """Dense numbers over a larger table, with one order for all rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    numbered = with_row_index(lines, ["l_shipdate", "l_orderkey", "l_linenumber"])
    return numbered.groupBy(F.expr("(row_index - 1) div 1000").alias("batch_no")).agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("orderkeys"), F.sum(F.col("row_index") * F.col("l_linenumber")).alias("weighted")
    )


@query
def export_json(spark, sf_dir):
    out = _scratch(spark, "export")
    stored = papers(spark, sf_dir)
    sinks.export_json(stored, out)
    return _flat(spark.read.schema(stored.schema).json(out))


@query
def provenance_row(spark, sf_dir):
    cells = [f"venue:{v} year:{y}" for v in grid.CONFERENCES for y in grid.YEARS]
    row = sinks.provenance(papers(spark, sf_dir), "saved pages", "https://example.org/api", cells, RUN_AT)
    return row.select("source", "source_url", F.concat_ws(";", "queries").alias("queries"), "count")


@query
def stream_import(spark, sf_dir):
    """Documents arrive as JSON files, are merged batch by batch, and give the catalog."""
    arrivals, root = _scratch(spark, "arrivals"), _scratch(spark, "library")
    _batch(spark, sf_dir).write.json(arrivals)
    library = Library(spark, root)
    start_import(paper_stream(spark, arrivals), library, f"{root}/stream", "stream", refresh_every=0).awaitTermination()
    return _flat(library.papers()).drop("id")
