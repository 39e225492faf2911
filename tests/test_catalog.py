"""Merge, edit, delete, fill, uniqueness, dedup."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citewell.operators import catalog, collect, grid
from citewell.operators.rowindex import with_row_index


def by_id(df):
    return {r.id: r for r in df.collect()}


def replay(stored, batch):
    """Row-by-row upsert over dicts, as a plain loop."""
    rows, top = [dict(r) for r in stored], max([r["id"] for r in stored], default=0)
    for new in batch:
        old = next((r for r in rows if new["dblp_key"] is not None and r["dblp_key"] == new["dblp_key"]), None)
        if old is None:
            top += 1
            rows.append({"id": top, **new, "keywords": new["keywords"] or []})
            continue
        old["title"] = new["title"]
        for c in ("venue", "year", "doi", "abstract"):
            old[c] = new[c] if new[c] is not None else old[c]
        old["keywords"] = new["keywords"] or old["keywords"]
    return sorted((r["id"], r["dblp_key"], r["title"], r["venue"], r["year"], r["doi"], r["abstract"], tuple(r["keywords"])) for r in rows)


def test_merge_equals_row_by_row(spark, papers_of, batch_of):
    empty = {"venue": None, "year": None, "doi": None, "abstract": None, "keywords": []}
    stored = [
        {**empty, "id": 1, "title": "one", "dblp_key": "k1", "venue": "CVPR", "year": 2020, "keywords": ["old"], "doi": "d1"},
        {**empty, "id": 2, "title": "two", "dblp_key": "k2"},
        {**empty, "id": 7, "title": "keyless", "dblp_key": None},
    ]
    batch = [
        {**empty, "title": "one a", "dblp_key": "k1", "abstract": "text"},
        {**empty, "title": "no key", "dblp_key": None, "keywords": None},
        {**empty, "title": "new", "dblp_key": "k9", "venue": "ECCV", "keywords": ["n"]},
        {**empty, "title": "one b", "dblp_key": "k1", "year": 2021},
        {**empty, "title": "no key", "dblp_key": None},
        {**empty, "title": "new again", "dblp_key": "k9", "year": 2000},
        {**empty, "title": "newer", "dblp_key": "k8"},
    ]
    merged = catalog.merge_upsert(papers_of(*stored), batch_of(*batch), "q")
    got = sorted((r.id, r.dblp_key, r.title, r.venue, r.year, r.doi, r.abstract, tuple(r.keywords)) for r in merged.collect())
    assert got == replay(stored, batch)
    touched = by_id(merged)
    assert touched[1].source_query == "q" and touched[1].title_normalized == "one b" and touched[2].source_query is None


def test_merge_into_nothing(papers_of, batch_of):
    merged = catalog.merge_upsert(papers_of(), batch_of({"title": "A", "dblp_key": "a"}, {"title": "B", "dblp_key": "b"}), None)
    assert sorted((r.id, r.title) for r in merged.collect()) == [(1, "A"), (2, "B")]


def test_merge_with_one_hot_key(spark, batch_of, papers_of):
    batch = spark.range(3000).select(
        F.concat(F.lit("t"), "id").alias("title"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("dblp_key"),
        F.when(F.col("id") == 0, "CVPR").alias("venue"), F.col("id").alias("_seq"),
    )
    full = batch_of({"title": "x"}).limit(0).unionByName(batch, allowMissingColumns=True)
    merged = catalog.merge_upsert(papers_of(), full, "q").collect()
    assert len(merged) == 51
    hot = next(r for r in merged if r.dblp_key == "hot")
    assert (hot.title, hot.venue, hot.id) == ("t2997", "CVPR", 1)


def test_doi_clash_is_reported(papers_of, batch_of):
    batch = batch_of({"title": "B", "dblp_key": "b", "doi": "10/1"})
    merged = catalog.merge_upsert(papers_of({"title": "A", "dblp_key": "a", "doi": "10/1"}), batch, None)
    assert [r.doi for r in catalog.doi_clashes(merged, batch).collect()] == ["10/1"]
    assert catalog.key_violations(merged, "dblp_key").count() == 0


def test_key_violations_see_both_doi_forms(papers_of):
    papers = papers_of({"title": "a", "doi": "10.1/X"}, {"title": "b", "doi": "https://doi.org/10.1/x"}, {"title": "c"}, {"title": "d"})
    assert catalog.key_violations(papers, "doi").count() == 0
    assert [tuple(r) for r in catalog.key_violations(papers, "doi", canonical_doi=True).collect()] == [("10.1/x", 2)]


def test_edits_may_clear_fields(spark, papers_of):
    papers = papers_of({"title": "a", "venue": "CVPR", "year": 2020, "abstract": "x"}, {"title": "b", "venue": "ICCV"})
    edits = spark.createDataFrame([(1, " New Title ", None, None, ["k"])], "id long, title string, venue string, year int, keywords array<string>")
    rows = by_id(catalog.update_papers(papers, edits))
    assert (rows[1].title, rows[1].title_normalized, rows[1].venue, rows[1].year, rows[1].keywords, rows[1].abstract) == (
        "New Title", "new title", None, None, ["k"], "x")
    assert (rows[2].title, rows[2].venue) == ("b", "ICCV")
    blank = spark.createDataFrame([(1, "  ", None, None, [])], edits.schema)
    with pytest.raises(PySparkException, match="title is required"):
        catalog.update_papers(papers, blank).collect()


def test_set_abstracts_keeps_keywords_unless_given(spark, papers_of):
    papers = papers_of({"title": "a", "keywords": ["x"]}, {"title": "b", "keywords": ["y"]}, {"title": "c", "abstract": "own"})
    found = spark.createDataFrame([(1, "A", None), (2, "B", ["z"])], "id long, abstract string, keywords array<string>")
    rows = by_id(catalog.set_abstracts(papers, found))
    assert [(rows[i].abstract, rows[i].keywords) for i in (1, 2, 3)] == [("A", ["x"]), ("B", ["z"]), ("own", [])]


def test_delete_and_purge(spark, papers_of):
    papers = papers_of({"title": "a", "source_query": "s"}, {"title": "b"}, {"title": "c", "source_query": "t"})
    ids = spark.createDataFrame([(1,), (99,)], "id long")
    assert sorted(by_id(catalog.delete_ids(papers, ids))) == [2, 3]
    assert sorted(by_id(catalog.matching_ids(papers, ids))) == [1]
    assert sorted(by_id(catalog.purge_source(papers, "s"))) == [2, 3]


def test_fill_venues_rotates_over_blank_rows(papers_of):
    papers = papers_of(*[{"title": "t", "venue": v} for v in (None, "", "NeurIPS", "  ", None)])
    assert {i: r.venue for i, r in by_id(catalog.fill_venues(papers)).items()} == {1: "CVPR", 2: "ICCV", 3: "NeurIPS", 4: "ECCV", 5: "CVPR"}


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    rows = with_row_index(df, [F.desc("v")]).collect()
    assert sorted((r.row_index, r.v) for r in rows) == [(i + 1, 4999 - i) for i in range(5000)]
    assert with_row_index(df.limit(0), ["v"]).count() == 0


def test_dedup_takes_the_first_arrival(batch_of):
    batch = batch_of(
        {"title": "A", "dblp_key": "k", "venue": "first"}, {"title": "B", "dblp_key": " k", "venue": "second"},
        {"title": "C", "dblp_key": "", "doi": "d"}, {"title": "D", "doi": "d "}, {"title": " Same ", "doi": ""}, {"title": "same"},
    )
    got = sorted(r.title for r in collect.first_by_identity(batch).collect())
    assert got == [" Same ", "A", "C"]


def test_source_priority_and_caps(spark):
    hits = spark.createDataFrame(
        [("q1", "X", 0, 1), ("q1", "Y", 1, 0), ("q2", "Y", 1, 5), ("q2", "Y", 1, 6)], "query string, source string, priority int, _seq long")
    assert sorted((r.query, r.source, r._seq) for r in collect.first_source_wins(hits).collect()) == [("q1", "X", 1), ("q2", "Y", 5), ("q2", "Y", 6)]
    assert sorted((r.query, r._seq) for r in collect.cap_per_query(hits, 1).collect()) == [("q1", 0), ("q2", 5)]
    queries = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "query string")
    silent = collect.empty_sources(queries, hits, {"X": 0, "Y": 1}).collect()
    assert sorted(map(tuple, silent)) == [("q2", "X"), ("q3", "X"), ("q3", "Y")]


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "b")], "x int, y string")
    assert sorted(map(tuple, collect.union_sources(a, b).collect())) == [(1, None), (2, "b")]


def test_grid(papers_of, spark):
    papers = papers_of({"title": "a", "venue": "cvpr workshops", "year": 2022}, {"title": "b", "venue": "CVPR/ICCV", "year": 2023}, {"title": "c"})
    cells = {(r.venue, r.year): r.paper_count for r in grid.grid_coverage(papers).collect()}
    assert len(cells) == 12 and {k for k, n in cells.items() if n} == {("CVPR", 2022), ("CVPR", 2023), ("ICCV", 2023)}
    assert grid.grid_queries(spark).first().query == "venue:CVPR year:2022"
