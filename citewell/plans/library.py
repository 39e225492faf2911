"""A paper library in a shared folder: catalog versions, derived tables, and the calls over them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.functions.text import blank
from citewell.operators import catalog, collect, grid, keywords, match, search, trends
from citewell.plans import refresh as derive
from citewell.schemas import PAPERS
from citewell.session import checkpointed
from citewell.sources.records import from_records, from_titles


class Library:
    """Catalog and derived tables as Parquet folders under ``root``.

    Each change writes a whole new catalog version and then appends one pointer row, so
    readers never see half a change and a lost job leaves the old version current.  One
    writer at a time.  ``refresh_options`` go to every rebuild of the derived tables.
    """

    def __init__(self, spark: SparkSession, root: str, **refresh_options):
        self.spark = spark
        self.root = root.rstrip("/")
        self.refresh_options = refresh_options

    # Versions

    def _pointer(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _versions(self) -> DataFrame:
        return self._pointer("published_versions", "version BIGINT, folder STRING, batch_id STRING, changed_at TIMESTAMP")

    def _current(self):
        return self._versions().orderBy(F.desc("version")).first()

    def version(self) -> int:
        row = self._current()
        return row["version"] if row else 0

    def papers(self) -> DataFrame:
        row = self._current()
        if row is None:
            return self.spark.createDataFrame([], PAPERS)
        return self.spark.read.schema(PAPERS).parquet(f"{self.root}/versions/{row['folder']}")

    def applied(self, batch_id: str) -> bool:
        return not self._versions().where(F.col("batch_id") == batch_id).isEmpty()

    def _save(self, papers: DataFrame, batch_id: str | None = None) -> DataFrame:
        folder = uuid.uuid4().hex
        papers.write.parquet(f"{self.root}/versions/{folder}")
        row = (self.version() + 1, folder, batch_id)
        pointer = self.spark.createDataFrame([row], "version BIGINT, folder STRING, batch_id STRING")
        pointer = pointer.withColumn("changed_at", F.current_timestamp())
        pointer.coalesce(1).write.mode("append").parquet(f"{self.root}/published_versions")
        return self.papers()

    # Derived tables

    def refresh(self, **options) -> derive.Derived:
        version = self.version()
        built = derive.refresh(self.papers(), **{**self.refresh_options, **options})
        run_id = derive.publish(built, self.root, version)
        return derive.published(self.spark, self.root, run_id)

    def _run(self):
        runs = self._pointer("published_runs", "run_id STRING, catalog_version BIGINT, published_at TIMESTAMP")
        return runs.orderBy(F.desc("published_at")).first()

    def derived(self) -> derive.Derived:
        row = self._run()
        if row is None:
            return derive.refresh(self.spark.createDataFrame([], PAPERS))
        return derive.published(self.spark, self.root, row["run_id"])

    def is_stale(self) -> bool:
        """True when the catalog changed after the derived tables were built."""
        row = self._run()
        return (row["catalog_version"] if row else 0) != self.version()

    # Changes

    def upsert(self, batch: DataFrame, source_query: str | None = None, batch_id: str | None = None,
               refresh: bool = True) -> int:
        """Merge a batch of import rows; refuses a batch that would repeat a DOI.

        A ``batch_id`` that was merged before is skipped.
        """
        if batch_id is not None and self.applied(batch_id):
            return 0
        count = batch.count()
        if not count:
            return 0
        merged = catalog.merge_upsert(self.papers(), batch, source_query)
        if not batch.where("doi IS NOT NULL").isEmpty():
            clashes = [r["doi"] for r in catalog.doi_clashes(merged, batch).limit(5).collect()]
            if clashes:
                raise ValueError(f"DOI held by more than one paper: {', '.join(clashes)}")
        self._save(merged, batch_id)
        if refresh:
            self.refresh()
        return count

    def import_titles(self, titles: Sequence[str] | DataFrame, venue: str = "CVPR", year: int = 2025) -> int:
        if not isinstance(titles, DataFrame):
            titles = self.spark.createDataFrame([(t, i) for i, t in enumerate(titles)], "title STRING, _seq BIGINT")
        return self.upsert(from_titles(titles, venue, year), "user-import")

    def import_records(self, records: DataFrame, source_query: str = "bulk-import") -> int:
        """Record rows with ``_seq``, or rows already read by ``read_records``, under the mark of their source."""
        return self.upsert(from_records(records), source_query)

    def collect_grid(self, *sources: DataFrame) -> int:
        """Import the records of several sources that fall into the collection grid."""
        return self.upsert(grid.cell_batches(collect.in_source_order(*sources)))

    def lookup(self, queries: DataFrame, staged_hits: DataFrame, limit: int = 20, exact: bool = False) -> DataFrame:
        """Answer ``(query_id, query)`` rows local-first; answers from a source enter the catalog.

        ``staged_hits`` are import rows with ``query_id, source, priority``.  Returns
        ``query_id, source`` and the stored paper's columns.
        """
        before = self.papers()
        local = match.local_hits(before, queries, limit, exact).select("query_id", "id").withColumn("source", F.lit("local"))
        hits = match.fetched_hits(queries, local, staged_hits, limit).join(
            queries.select("query_id", F.col("query").alias("source_query")), "query_id"
        )
        fetched = checkpointed(hits)
        self.upsert(fetched.drop("query_id", "source", "priority"))
        after = self.papers()
        stored = fetched.where("dblp_key IS NOT NULL").select("query_id", "source", "dblp_key").distinct()
        found = after.join(stored, "dblp_key").select("query_id", "source", *after.columns)
        return after.join(local, "id").select("query_id", "source", *after.columns).unionByName(found)

    def update_paper(self, paper_id: int, title: str, venue: str | None, year: int | None,
                     keywords: Sequence[str] | str) -> DataFrame | None:
        if not title.strip():
            raise ValueError("title is required")
        if isinstance(keywords, str):
            keywords = [k.strip() for k in keywords.split(",")]
        words = [k for k in keywords if k.strip()]
        edit = self.spark.createDataFrame(
            [(paper_id, title, venue or None, year, words)],
            "id BIGINT, title STRING, venue STRING, year INT, keywords ARRAY<STRING>",
        )
        if search.paper_by_id(self.papers(), paper_id).isEmpty():
            return None
        self._save(catalog.update_papers(self.papers(), edit))
        self.refresh()
        return self.get_paper(paper_id)

    def update_abstract(self, paper_id: int, abstract: str, keywords: Sequence[str] | None = None) -> DataFrame:
        """Set one abstract; derived tables become stale until the next refresh."""
        words = list(keywords) if keywords is not None else None
        found = self.spark.createDataFrame([(paper_id, abstract, words)], "id BIGINT, abstract STRING, keywords ARRAY<STRING>")
        self._save(catalog.set_abstracts(self.papers(), found))
        return self.get_paper(paper_id)

    def enrich_abstracts(self, hits: DataFrame) -> int:
        """Fill missing abstracts from staged hits; papers that have one are left alone."""
        lacking = self.papers().where("abstract IS NULL OR abstract = ''").select(F.col("id").alias("paper_id"))
        found = match.best_abstracts(hits.join(lacking, "paper_id", "left_semi"))
        changed = found.count()
        if changed:
            self._save(catalog.set_abstracts(self.papers(), found))
        return changed

    def enrich_backlog(self, records: DataFrame, limit: int = 200) -> int:
        """Fill the abstracts of the backlog's first ``limit`` papers from the most similar titles of ``records``.

        ``records`` is ``(_seq, title, abstract, keywords)``, whatever their number.
        """
        titles = self.backlog(limit).select(F.col("id").alias("paper_id"), "title")
        found = checkpointed(match.matched_abstracts(titles, records))
        changed = found.count()
        if changed:
            self._save(catalog.set_abstracts(self.papers(), found))
        return changed

    def backfill_venues(self, records: DataFrame) -> int:
        """Fill missing venues from records of the same title; derived tables become stale."""
        filled = match.backfill_venues(self.papers(), records)
        named = F.count_if(~blank(F.col("venue")))
        changed = filled.agg(named).first()[0] - self.papers().agg(named).first()[0]
        if changed:
            self._save(filled)
        return changed

    def _replace(self, kept: DataFrame) -> int:
        removed = self.count() - kept.count()
        if removed:
            self._save(kept)
            self.refresh()
        return removed

    def delete_paper(self, paper_id: int) -> bool:
        ids = self.spark.createDataFrame([(paper_id,)], "id BIGINT")
        return self._replace(catalog.delete_ids(self.papers(), ids)) > 0

    def delete_by_source_query(self, source_query: str) -> int:
        return self._replace(catalog.purge_source(self.papers(), source_query))

    def apply_demo_venues(self) -> int:
        missing = self.papers().where("venue IS NULL OR trim(venue) = ''").count()
        if missing:
            self._save(catalog.fill_venues(self.papers()))
            self.refresh()
        return missing

    # Queries

    def count(self) -> int:
        return self.papers().count()

    def all(self, limit: int = 1000) -> DataFrame:
        return search.all_papers(self.papers(), limit)

    def get_paper(self, paper_id: int) -> DataFrame:
        return search.paper_by_id(self.papers(), paper_id)

    def backlog(self, limit: int = 200) -> DataFrame:
        """Papers that lack an abstract, in the order to fill them."""
        return search.missing_abstracts(self.papers(), limit)

    def search(self, query: str, exact: bool = False, limit: int = 20) -> DataFrame:
        return search.search(self.papers(), query, exact, limit)

    def summary(self, limit: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
        return derive.summary(self.derived(), limit)

    def keyword_papers(self, keyword: str, limit: object = 50) -> DataFrame:
        return keywords.papers_for_keyword(self.derived().keyword_papers, self.papers(), keyword, limit)

    def trends(self, keywords: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """Trend rows, and the years and venues that occur in them."""
        records = trends.select_trends(self.derived().trend_stats, list(keywords) if keywords is not None else None)
        return records, trends.trend_axes(records)
