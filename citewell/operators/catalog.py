"""Changes to the paper catalog: merge, edit, delete, fill, uniqueness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citewell.functions.keys import bare_doi
from citewell.functions.text import blank, normalize_title, strip
from citewell.functions.vocab import CONFERENCES
from citewell.operators.rowindex import with_row_index
from citewell.schemas import PAPERS

_OVERWRITE = (
    "title", "title_normalized", "authors", "dblp_url", "electronic_edition", "paper_type", "source_query",
    "fetched_at",
)
_KEEP_IF_NULL = ("venue", "year", "doi", "abstract")


def _as_papers(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAPERS])


def _incoming(batch: DataFrame, source_query: str | None, fetched_at: Column) -> DataFrame:
    empty = F.array().cast("array<string>")
    rows = batch.withColumn("title_normalized", normalize_title(F.col("title")))
    for name in ("authors", "electronic_edition", "keywords"):
        rows = rows.withColumn(name, F.coalesce(name, empty))
    if "source_query" not in batch.columns:
        rows = rows.withColumn("source_query", F.lit(source_query).cast("string"))
    return rows.withColumn("fetched_at", fetched_at)


def fold_batch(incoming: DataFrame) -> DataFrame:
    """One row per key: what applying the batch row by row would leave.

    Overwritten columns take the last arrival; kept columns the last non-null one;
    keywords the last non-empty one.  All are partial aggregates.
    """
    seq = F.col("_seq")
    last = F.max_by(F.struct(*_OVERWRITE), seq).alias("_last")
    kept = [F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c) for c in _KEEP_IF_NULL]
    words = F.max_by("keywords", F.when(F.size("keywords") > 0, seq)).alias("keywords")
    folded = incoming.where("dblp_key IS NOT NULL").groupBy("dblp_key").agg(
        last, *kept, words, F.min("_seq").alias("_seq")
    )
    return folded.select("dblp_key", "_last.*", *_KEEP_IF_NULL, "keywords", "_seq")


def merge_upsert(
    papers: DataFrame, batch: DataFrame, source_query: str | None, fetched_at: Column | None = None
) -> DataFrame:
    """Catalog after the batch (``PAPER_IN`` rows) is merged in on ``dblp_key``.

    A ``source_query`` column in the batch, where it has one, takes the place of the argument.

    The batch is folded to one row per key first.  Each join has the folded batch or its
    keys on the small side, so a batch under the broadcast threshold leaves the catalog
    unshuffled.  Catalog rows without a key cannot match and skip the join.
    New rows get dense ids after the present maximum, in arrival order.
    """
    incoming = _incoming(batch, source_query, F.current_timestamp() if fetched_at is None else fetched_at)
    folded = fold_batch(incoming)

    present = papers.where("dblp_key IS NOT NULL").alias("p")
    new = folded.alias("n")
    matched = F.col("n._seq").isNotNull()

    def merged(name: str) -> Column:
        old, fresh = F.col(f"p.{name}"), F.col(f"n.{name}")
        if name in ("id", "dblp_key"):
            return old
        if name in _OVERWRITE:
            return F.when(matched, fresh).otherwise(old)
        return F.coalesce(fresh, old)

    updated = present.join(new, F.col("p.dblp_key") == F.col("n.dblp_key"), "left").select(
        *[merged(f.name).alias(f.name) for f in PAPERS]
    )
    known = papers.select("dblp_key").join(folded.select("dblp_key"), "dblp_key", "left_semi")
    added = folded.join(known, "dblp_key", "left_anti").withColumn(
        "keywords", F.coalesce("keywords", F.array().cast("array<string>"))
    )
    added = added.unionByName(incoming.where("dblp_key IS NULL").select(*added.columns))
    top = papers.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    added = with_row_index(added, ["_seq"], "id", start=top + 1)
    return _as_papers(updated).unionByName(_as_papers(papers.where("dblp_key IS NULL"))).unionByName(_as_papers(added))


def key_violations(papers: DataFrame, column: str, canonical_doi: bool = False) -> DataFrame:
    """Values of a unique column held by more than one row; nulls never clash."""
    value = bare_doi(F.col(column)) if canonical_doi else F.col(column)
    return (
        papers.where(F.col(column).isNotNull())
        .groupBy(value.alias(column))
        .agg(F.count("*").alias("paper_count"))
        .where("paper_count > 1")
    )


def doi_clashes(merged: DataFrame, batch: DataFrame) -> DataFrame:
    """DOIs of the batch that more than one merged row holds."""
    touched = batch.where("doi IS NOT NULL").select("doi").distinct()
    return key_violations(merged.join(touched, "doi", "left_semi"), "doi")


def _one_per_id(edits: DataFrame, *columns: str) -> DataFrame:
    row = F.struct(*columns)
    order = F.col("_seq") if "_seq" in edits.columns else row
    return edits.groupBy("id").agg(F.max_by(row, order).alias("it")).select("id", *[F.col(f"it.{c}").alias(c) for c in columns])


def update_papers(papers: DataFrame, edits: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Apply edits ``(id, title, venue, year, keywords)``; of several for an id, the last by ``_seq`` or else by value counts.

    Venue and year may become null.  A blank title raises when the result is computed.
    """
    title = strip(F.col("title"))
    checked = F.when(F.coalesce(title, F.lit("")) == "", F.raise_error(F.lit("title is required")).cast("string"))
    new = _one_per_id(edits, "title", "venue", "year", "keywords").select(
        F.col("id").alias("edit_id"),
        checked.otherwise(title).alias("new_title"),
        *[F.col(c).alias("new_" + c) for c in ("venue", "year", "keywords")],
    )
    new = new.withColumn("new_title_normalized", normalize_title(F.col("new_title")))
    new = new.withColumn("new_fetched_at", F.current_timestamp() if fetched_at is None else fetched_at)
    edited = F.col("edit_id").isNotNull()
    joined = papers.join(new, papers.id == F.col("edit_id"), "left")
    columns = [
        F.when(edited, F.col("new_" + c)).otherwise(F.col(c)).alias(c) if "new_" + c in new.columns else F.col(c)
        for c in papers.columns
    ]
    return joined.select(*columns)


def set_abstracts(papers: DataFrame, found: DataFrame) -> DataFrame:
    """Set abstracts, and keywords where given, from ``(id, abstract, keywords)``; repeated ids as in ``update_papers``."""
    new = _one_per_id(found, "abstract", "keywords").select(
        F.col("id").alias("found_id"), F.col("abstract").alias("new_abstract"), F.col("keywords").alias("new_keywords")
    )
    hit = F.col("found_id").isNotNull()
    return (
        papers.join(new, papers.id == F.col("found_id"), "left")
        .withColumn("abstract", F.when(hit, F.col("new_abstract")).otherwise(F.col("abstract")))
        .withColumn("keywords", F.coalesce("new_keywords", "keywords"))
        .select(*papers.columns)
    )


def delete_ids(papers: DataFrame, ids: DataFrame) -> DataFrame:
    return papers.join(ids.select("id"), "id", "left_anti").select(*papers.columns)


def matching_ids(papers: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows a delete would remove."""
    return papers.join(ids.select("id"), "id", "left_semi").select(*papers.columns)


def purge_source(papers: DataFrame, source_query: str) -> DataFrame:
    """Drop the rows one import made; rows without a source stay."""
    return papers.where(~F.col("source_query").eqNullSafe(F.lit(source_query)))


def fill_venues(papers: DataFrame) -> DataFrame:
    """Give rows without a venue the conferences in turn, by id; other rows are untouched.

    Ids alone are sorted and numbered.
    """
    missing = blank(F.col("venue"))
    numbered = with_row_index(papers.where(missing).select("id"), ["id"], "_turn", start=0)
    name = F.element_at(F.array(*[F.lit(c) for c in CONFERENCES]), (F.col("_turn") % len(CONFERENCES) + 1).cast("int"))
    filled = papers.where(missing).drop("venue").join(numbered.select("id", name.alias("venue")), "id")
    return papers.where(~missing).unionByName(filled)
