"""Bulk record and title-list imports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citewell.functions.keys import title_key
from citewell.functions.text import nonempty, strip
from citewell.schemas import PAPER_IN

_RECORD = (
    "title STRING, authors ARRAY<STRING>, venue STRING, year STRING, doi STRING, dblp_url STRING, "
    "electronic_edition ARRAY<STRING>, dblp_key STRING, paper_type STRING, abstract STRING, keywords ARRAY<STRING>"
)


def paper_rows(df: DataFrame, columns: dict[str, Column], carried: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the import schema and ``carried``; columns not given are null, or empty arrays."""
    def value(field):
        if field.name == "_seq" and "_seq" in columns:
            return columns["_seq"]  # any type that sorts in arrival order
        if field.name in columns:
            return columns[field.name].cast(field.dataType)
        return (F.array() if field.dataType.typeName() == "array" else F.lit(None)).cast(field.dataType)

    return df.select(*[value(f).alias(f.name) for f in PAPER_IN], *carried)


def arrival(place: Column | None = None) -> Column:
    """Sorts the rows of a file scan as they arrived: files by modification time and path, then blocks of a file, then rows.

    The rows of one block are read in order by one task, so a number that grows within a task
    orders them; it is never compared across blocks.  ``place`` is the place inside a row.
    """
    file = F.col("_metadata")
    row = F.monotonically_increasing_id()
    return F.struct(
        file["file_modification_time"].alias("time"), file["file_path"].alias("file"), file["file_block_start"].alias("block"),
        row.alias("row"), (F.lit(0) if place is None else place).cast("int").alias("place"),
    )


def year_number(c: Column) -> Column:
    """Whole year, null when missing, zero or not a whole number of at most nine digits."""
    text = F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]{1,9})(?:\.0*)?\s*$", 1)
    return F.nullif(text.try_cast("int"), F.lit(0))


def from_records(records: DataFrame) -> DataFrame:
    """Import rows from record rows that carry ``_seq``; blank titles are skipped."""
    title = strip(F.coalesce("title", F.lit("")))
    key = nonempty(strip(F.coalesce("dblp_key", F.lit(""))))
    items = lambda name: F.coalesce(F.col(name), F.array().cast("array<string>"))
    rows = paper_rows(
        records.where(title != ""),
        {
            "title": title,
            "authors": items("authors"),
            "venue": F.col("venue"),
            "year": year_number(F.col("year")),
            "doi": F.col("doi"),
            "dblp_url": F.col("dblp_url"),
            "electronic_edition": items("electronic_edition"),
            "dblp_key": F.coalesce(key, title_key("bulk-import", title)),
            "paper_type": F.coalesce(nonempty(F.col("paper_type")), F.lit("bulk-import")),
            "abstract": F.col("abstract"),
            "keywords": items("keywords"),
            "_seq": F.col("_seq"),
        },
    )
    return rows


def _raw_records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    schema = f"{_RECORD}, papers ARRAY<STRUCT<{_RECORD}>>, _unreadable STRING"
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_unreadable")
    return reader.json(path, multiLine=multi_line)


def read_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read JSON records: bare records, a list, or ``{"papers": [...]}`` envelopes, in order of arrival.

    JSON lines split across tasks; ``multi_line`` reads each file as one document.  Of a line that is not quite
    a record, the fields that can be read are taken; ``unreadable_records`` lists such lines.
    """
    raw = _raw_records(spark, path, multi_line).withColumn("_at", arrival())
    names = [n for n in raw.columns if n not in ("papers", "_unreadable", "_at")]
    exploded = raw.select("_at", F.posexplode(F.coalesce("papers", F.array(F.struct(*names)))).alias("_place", "_paper"))
    return from_records(exploded.select("_paper.*", F.col("_at").withField("place", F.col("_place")).alias("_seq")))


def unreadable_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """file, line and title (null if nothing of it was imported) of every line that is no whole record."""
    raw = _raw_records(spark, path, multi_line)
    # Fields that nothing asks for are not parsed, and then not found wrong either.
    all_parsed = F.to_json(F.struct(*[c for c in raw.columns if c != "_unreadable"])) != ""
    found = raw.where(F.col("_unreadable").isNotNull() & all_parsed)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_unreadable").alias("line"), "title")


def unreadable_counts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """file, lines, lost: how many lines of each file are no whole record, and how many of them gave no title."""
    lines = unreadable_records(spark, path, multi_line)
    return lines.groupBy("file").agg(F.count("*").alias("lines"), F.count_if(F.col("title").isNull()).alias("lost"))


def from_titles(titles: DataFrame, venue: str = "CVPR", year: int = 2025) -> DataFrame:
    """Placeholder papers from rows ``(title, _seq)``."""
    title = strip(F.col("title"))
    return paper_rows(
        titles.where(title != ""),
        {
            "title": title,
            "venue": F.lit(venue),
            "year": F.lit(year),
            "dblp_key": title_key("user-import", title),
            "paper_type": F.lit("user-import"),
            "_seq": F.col("_seq"),
        },
    )


def read_titles(spark: SparkSession, path: str, venue: str = "CVPR", year: int = 2025) -> DataFrame:
    """One title per line."""
    lines = spark.read.text(path).select(F.col("value").alias("title"), arrival().alias("_seq"))
    return from_titles(lines, venue, year)
