"""Search over the catalog: one query, or a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.functions.text import blank, json_text, normalize_title
from citewell.functions.tokens import one_per_row
from citewell.functions.venues import facet_text, facet_venue, facet_year, facets_match
from citewell.functions.vocab import CONFERENCES
from citewell.session import spread, staged

# Separates the searchable fields of a paper in one text; never part of a query.
_FIELD_BREAK = "\x01"

# Queries are located by a gram of this many characters, or fewer when shorter.
_GRAM = 5

# Fixed value: most rows of a page.
MOST_ROWS = 100


def newest_first() -> list[Column]:
    return [F.desc_nulls_last("year"), F.asc_nulls_first("title"), F.asc_nulls_first("id")]


def all_papers(papers: DataFrame, limit: int = 1000) -> DataFrame:
    return papers.orderBy(*newest_first()).limit(limit)


def paper_by_id(papers: DataFrame, paper_id: int) -> DataFrame:
    return papers.where(F.col("id") == paper_id)


def search_fields() -> list[Column]:
    """The lower-case texts a fuzzy search looks at."""
    empty = F.lit("")
    return [
        F.col("title_normalized"),
        F.lower(F.coalesce("venue", empty)),
        F.lower(F.coalesce("dblp_key", empty)),
        F.lower(json_text(F.coalesce("keywords", F.array().cast("array<string>")))),
    ]


def like_pattern(text: Column) -> Column:
    """``%text%``; ``%`` and ``_`` stay wildcards, a backslash is a plain character."""
    return F.concat(F.lit("%"), F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("%"))


def wildcard_regex(text: Column) -> Column:
    """A pattern that finds what ``like_pattern`` finds.

    LIKE takes time with the square of a pattern's length if the pattern is a column; this does not.  Each part between
    two ``%`` is held at its first place behind the part before, which leaves most to those that follow, so
    no place is tried again: time does not grow with a power of a text's length.
    """
    plain = F.regexp_replace(text, r"([^\p{L}\p{N}%_])", r"\\$1")
    parts = F.filter(F.split(F.replace(plain, F.lit("_"), F.lit(".")), "%"), lambda part: part != "")
    return F.concat(F.lit(r"(?s)\A"), F.array_join(F.transform(parts, lambda part: F.concat(F.lit("(?>.*?"), part, F.lit(")"))), ""))


def _any(conditions: list[Column]) -> Column:
    first, *rest = conditions
    for c in rest:
        first = first | c
    return first


def search(papers: DataFrame, query: str, exact: bool = False, limit: int = 50) -> DataFrame:
    """Papers matching one query; a blank query lists the newest."""
    if not query.strip():
        return all_papers(papers, limit)
    text = normalize_title(F.lit(query))
    if exact:
        hits = papers.where(F.col("title_normalized") == text)
        return hits.orderBy(F.desc_nulls_last("year"), F.asc_nulls_first("id")).limit(limit)
    # The pattern is foldable, so Spark plans a plain contains where it has no wildcard.
    hits = papers.where(_any([F.like(field, like_pattern(text)) for field in search_fields()]))
    return all_papers(hits, limit)


def parsed_queries(queries: DataFrame, facets: bool = True) -> DataFrame:
    """``(query_id, query)`` with the facets taken out of the text, or left in as plain text."""
    query = F.col("query")
    if not facets:
        return queries.select(
            "query_id",
            normalize_title(query).alias("text"),
            F.lit(None).cast("string").alias("want_venue"),
            F.lit(None).cast("int").alias("want_year"),
        )
    return queries.select(
        "query_id",
        normalize_title(facet_text(query)).alias("text"),
        facet_venue(query).alias("want_venue"),
        facet_year(query).alias("want_year"),
    )


def located_queries(queries: DataFrame, facets: bool = True) -> DataFrame:
    """Parsed queries with ``piece``, the longest part without wildcards, ``wild``, and ``least``: the
    characters that a text without any such part asks for."""
    pieces = F.transform(
        F.split("text", "[%_]"), lambda p: F.struct((-F.length(p)).alias("rank"), p.alias("piece"))
    )
    underscores = F.length("text") - F.length(F.replace("text", F.lit("_"), F.lit("")))
    return (
        parsed_queries(queries, facets)
        .withColumn("piece", F.element_at(F.sort_array(pieces), 1)["piece"])
        .withColumn("wild", F.col("text").rlike("[%_]"))
        .withColumn("least", F.when(F.col("piece") == "", underscores))
    )


def text_pieces(text: Column, lengths: list[int]) -> Column:
    """The distinct pieces of a text of each length, in one pass per length."""
    def pieces(n: int) -> Column:
        return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) if n else F.array(F.lit(""))

    return F.array_distinct(F.concat(*[pieces(n) for n in lengths]))


def _fields_of(papers: DataFrame) -> DataFrame:
    """What a match looks at: the four texts, all of them in one, and the length of the longest."""
    title, venue, key, words = search_fields()
    narrow = papers.select("id", "title", "title_normalized", "year", "venue", "dblp_key", "keywords")
    named = spread(narrow, "id").select(
        "id", "title", "title_normalized", "year", "venue",
        venue.alias("f_venue"), key.alias("f_key"), words.alias("f_words"),
    )
    fields = ("title_normalized", "f_venue", "f_key", "f_words")
    return named.withColumn("hay", F.concat_ws(_FIELD_BREAK, *fields)).withColumn("longest", F.greatest(*map(F.length, fields)))


_FOUND = ("query_id", "id", "title", "year", "venue")


def _words_holding(words: DataFrame, edges: DataFrame) -> DataFrame:
    """(text, word): the words that hold the ``edge`` of a text, found by the one of its grams that fewest words have."""
    whole = F.regexp_extract_all("edge", F.lit(f"(?s)(?=(.{{{_GRAM}}}))"), F.lit(1))
    grams = F.when(F.length("edge") <= _GRAM, F.array("edge")).otherwise(F.array_distinct(whole))
    wanted = staged(one_per_row(edges.select("edge").distinct(), grams, "gram", "edge"), "asked-grams")
    lengths = sorted(r[0] for r in wanted.select(F.length("gram")).distinct().collect())  # at most five
    offered = one_per_row(words, text_pieces(F.col("word"), lengths or [_GRAM]), "gram", "word")
    offered = staged(offered.join(wanted.select("gram").distinct(), "gram", "left_semi"), "offered-grams")
    counts = offered.groupBy("gram").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), "gram")
    rarest = wanted.join(counts, "gram", "left").groupBy("edge").agg(F.min_by("gram", rarity).alias("gram"))
    held = rarest.join(offered, "gram").where(F.contains("word", F.col("edge")))
    return edges.join(held, "edge").select("text", "word")


def _by_text(fields: DataFrame, asked: DataFrame) -> DataFrame:
    """Matches of the queries with a literal part, through an inverted index of words.

    What stands between two spaces of a text is a whole word of each paper it matches, so a text is looked up by the
    one of these words that fewest papers have.  A text without such a word is looked up by all words
    that hold its longest part.  The full condition is checked on what meets.
    """
    parts = F.split("piece", " ")
    inner = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda word: word != "")
    by_length = F.transform(parts, lambda part: F.struct((-F.length(part)).alias("rank"), part.alias("part")))
    texts = asked.select("text", "piece").distinct().select("text", inner.alias("inner"), F.array_min(by_length)["part"].alias("edge"))
    # A text of spaces alone is looked up by the space, which counts as a word of the papers that have one.
    inner = F.when(F.col("edge") == "", F.array(F.lit(" "))).otherwise(F.col("inner"))
    texts = staged(texts.withColumn("inner", inner), "asked-texts")
    space = F.when(F.contains("hay", F.lit(" ")), F.array(F.lit(" "))).otherwise(F.array().cast("array<string>"))
    words = F.array_distinct(F.filter(F.concat(F.split("hay", f"[ {_FIELD_BREAK}]"), space), lambda word: word != ""))
    words = staged(one_per_row(fields, words, "word", "row", "id"), "paper-words")
    wanted = staged(one_per_row(texts, F.array_distinct("inner"), "word", "text"), "asked-words")
    counts = words.join(wanted.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), "word")
    rarest = wanted.join(counts, "word", "left").groupBy("text").agg(F.min_by("word", rarity).alias("word")).select("text", "word")
    held = _words_holding(words.select("word").distinct(), texts.where("size(inner) = 0"))
    keyed = staged(rarest.unionByName(held), "asked-keys")
    met = staged(keyed.join(words, "word").select("text", "row", "id").distinct().select("text", "id"), "met")

    def checked(wild: bool, condition: Column) -> DataFrame:
        return met.where(F.col("text").rlike("[%_]") == wild).join(fields, "id").where(condition)

    pattern = wildcard_regex(F.col("text"))
    by_field = _any([F.rlike(F.col(c), pattern) for c in ("title_normalized", "f_venue", "f_key", "f_words")])
    hits = checked(False, F.contains(F.col("hay"), F.col("text"))).unionByName(checked(True, by_field))
    hits = hits.select("text", "id", "title", "year", "venue")
    facets_ok = facets_match(F.col("want_venue"), F.col("want_year"), F.col("venue"), F.col("year"))
    return hits.join(asked, "text").where(facets_ok).select(*_FOUND)


def _by_facets(fields: DataFrame, asked: DataFrame) -> DataFrame:
    """Matches of the queries with facets alone: an equi-join on conference and year."""
    named = F.array_compact(F.array(*[
        F.when(facets_match(F.lit(name), F.lit(None).cast("int"), F.col("venue"), F.col("year")), name) for name in CONFERENCES
    ]))
    open_too = lambda values: F.concat(values, F.array(F.lit(None)))
    years = F.array_distinct(open_too(F.array("year")))
    cells = F.flatten(F.transform(open_too(named), lambda v: F.transform(years, lambda y: F.struct(v.alias("v"), y.alias("y")))))
    offered = fields.select("id", "title", "year", "venue", "longest", F.explode(cells).alias("cell"))
    same = F.col("want_venue").eqNullSafe(F.col("cell.v")) & F.col("want_year").eqNullSafe(F.col("cell.y"))
    return offered.where("cell.v IS NOT NULL OR cell.y IS NOT NULL").join(asked, same).where("longest >= least").select(*_FOUND)


def _parted(papers: DataFrame, queries: DataFrame, facets: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fields of the papers, their matches by text or facets, and the queries that ask for neither."""
    fields = staged(_fields_of(papers).withColumn("row", F.monotonically_increasing_id()), "search-fields")
    asked = staged(located_queries(queries, facets), "asked-queries")
    faceted = (F.col("piece") == "") & (F.col("want_venue").isNotNull() | F.col("want_year").isNotNull())
    found = _by_text(fields, asked.where("piece <> ''")).unionByName(_by_facets(fields, asked.where(faceted)))
    return fields, found, asked.where((F.col("piece") == "") & ~faceted).select("query_id", "least")


def _folded(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each different query once, with a number as its ``query_id``, and the ids that ask it: (ask, query_id)."""
    once = staged(queries.select("query").distinct().withColumn("ask", F.monotonically_increasing_id()), "distinct-queries")
    return once.select(F.col("ask").alias("query_id"), "query"), queries.join(once, "query").select("ask", "query_id")


def query_matches(papers: DataFrame, queries: DataFrame, facets: bool = True, counted: bool = False) -> DataFrame:
    """All (query, paper) matches for a table of queries, without pairing everything.

    Queries meet papers by the rarest gram of their text, or by conference and year where
    they have no text.  A query with neither matches every paper whose longest
    field has as many characters as it has ``_``; those rows are all part of the answer.
    ``counted`` gives ``(query_id, matches, last_id)`` instead: how many they are and the greatest paper id.  The
    matches of equal queries are then counted once and never repeated for each id that asks.
    """
    once, askers = _folded(queries)
    fields, found, open_queries = _parted(papers, once, facets)
    lengths = open_queries.select("least").distinct()
    every = fields.join(F.broadcast(lengths), F.col("longest") >= F.col("least")).join(open_queries, "least")
    found = found.unionByName(every.select(*_FOUND)).withColumnRenamed("query_id", "ask")
    if counted:
        totals = found.groupBy("ask").agg(F.count("*").alias("matches"), F.max("id").alias("last_id")).join(askers, "ask")
        return totals.groupBy("query_id").agg(F.coalesce(F.sum("matches"), F.lit(0)).alias("matches"), F.max("last_id").alias("last_id"))
    return found.join(askers, "ask").select(*_FOUND)


def batch_search(papers: DataFrame, queries: DataFrame, limit: int = 20, facets: bool = True) -> DataFrame:
    """Newest ``limit`` matches of each query, numbered by ``position``.

    Queries that ask for neither text nor facets share one list of newest papers (one for
    each number of ``_`` in them).  Equal queries share their matches, too.
    """
    once, askers = _folded(queries)
    fields, found, open_queries = _parted(papers, once, facets)
    newest = Window.partitionBy("query_id").orderBy(*newest_first())
    ranked = found.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= limit)
    for row in open_queries.select("least").distinct().collect():  # one for each number of wildcards
        shown = all_papers(fields.where(F.col("longest") >= row["least"]), limit).select("id", "title", "year", "venue")
        numbered = shown.withColumn("position", F.row_number().over(Window.orderBy(*newest_first())))  # ``limit`` rows
        ranked = ranked.unionByName(open_queries.join(numbered.withColumn("least", F.lit(row["least"])), "least").drop("least"))
    # An id that asks several times has the newest of all that its queries found.
    asked = ranked.drop("position").withColumnRenamed("query_id", "ask").join(askers, "ask").drop("ask")
    return asked.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= limit).select(*_FOUND, "position")


def batch_exact(papers: DataFrame, queries: DataFrame, limit: int = 20) -> DataFrame:
    """Exact-title form of ``batch_search``."""
    asked = queries.select("query_id", normalize_title(F.col("query")).alias("title_normalized"))
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("year"), F.asc_nulls_first("id"))
    found = papers.select("id", "title", "title_normalized", "year", "venue").join(asked, "title_normalized")
    ranked = found.drop("title_normalized").withColumn("position", F.row_number().over(order))
    return ranked.where(F.col("position") <= limit)


def stored_of(papers: DataFrame, fetched: DataFrame) -> DataFrame:
    """Stored rows whose key is among the fetched ones."""
    return papers.join(fetched.select("dblp_key").distinct(), "dblp_key", "left_semi").select(*papers.columns)


def missing_abstracts(papers: DataFrame, limit: int = 200) -> DataFrame:
    """Enrichment backlog: known conferences first, newest first."""
    known = F.when(F.col("venue").isin(*CONFERENCES), 0).otherwise(1)
    return (
        papers.where(blank(F.col("abstract")))
        .orderBy(known, F.desc_nulls_last("year"), F.asc_nulls_first("id"))
        .limit(limit)
        .select("id", "title", "venue", "year")
    )


def page_size(asked: Column, usual: int = 50, most: int = MOST_ROWS) -> Column:
    """Rows to show for an asked text: a whole number, held to 1..``most``, or else ``usual``."""
    text = F.btrim(asked.cast("string"))
    held = F.least(F.greatest(text.try_cast("double"), F.lit(1)), F.lit(most))
    return F.when(text.rlike("^[+-]?[0-9]+$"), held).otherwise(usual).cast("int")
