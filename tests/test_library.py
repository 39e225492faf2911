"""The library facade and the streaming import, end to end in a folder."""

import json

import pytest

from citewell.plans.library import Library
from citewell.schemas import PAPER_IN
from citewell.streaming.imports import paper_stream, start_import


@pytest.fixture()
def library(spark, tmp_path):
    return Library(spark, str(tmp_path / "library"), starts=1)


def test_empty_library(library):
    meta, topics, keywords = library.summary()
    assert (meta.first().paper_count, meta.first().cluster_count) == (0, 0)
    assert topics.count() == keywords.count() == library.count() == 0
    records, axes = library.trends()
    assert records.count() == 0 and (axes.first().years, axes.first().venues) == ([], [])
    assert library.delete_paper(1) is False and library.apply_demo_venues() == 0


def test_edit_then_delete(library, batch_of):
    library.upsert(batch_of({"title": "Editable", "dblp_key": "editable", "venue": "CVPR", "year": 2025, "paper_type": "user-import", "keywords": ["old-keyword"]}))
    row = library.update_paper(1, "Updated Vision Paper", "ECCV", 2024, " new-keyword , ").first()
    assert (row.title, row.venue, row.year, row.keywords) == ("Updated Vision Paper", "ECCV", 2024, ["new-keyword"])
    assert library.update_paper(5, "x", None, None, []) is None
    with pytest.raises(ValueError):
        library.update_paper(1, " ", None, None, [])
    assert library.delete_paper(1) and library.count() == 0 and not library.delete_paper(1)


def test_refresh_on_three_papers(library, batch_of):
    library.upsert(batch_of(
        {"title": "Vision Language Retrieval", "dblp_key": "a", "venue": "CVPR", "year": 2024, "paper_type": "Conference"},
        {"title": "Diffusion Video Generation", "dblp_key": "b", "venue": "ICCV", "year": 2025, "paper_type": "Conference"},
        {"title": "Temporary Imported Paper", "dblp_key": "c", "venue": "ECCV", "year": 2025, "paper_type": "user-import"}))
    meta, topics, _ = library.summary()
    assert meta.first().paper_count == 3 and topics.count() >= 2
    assert [r.title for r in library.keyword_papers(" Generation ", "250").collect()] == ["Diffusion Video Generation"]
    records, axes = library.trends()
    assert axes.first().venues == ["CVPR", "ICCV"] and axes.first().years == [2024, 2025]
    assert library.trends(["video"])[0].count() == 1 and not library.is_stale()


def test_imports_search_and_purge(library, spark):
    assert library.import_titles(["Imported paper", " ", "Imported  PAPER"], "ECCV", 2024) == 2
    found = library.search("imported").collect()
    assert [(r.title, r.venue, r.source_query) for r in found] == [("Imported  PAPER", "ECCV", "user-import")]
    assert library.import_titles([]) == 0
    records = spark.read.schema("title string, authors array<string>, venue string, year string, doi string, dblp_url string, electronic_edition array<string>, "
                                "dblp_key string, paper_type string, abstract string, keywords array<string>, _seq long").json(
        spark.sparkContext.parallelize([json.dumps({"title": "Record", "year": 2020, "_seq": 0})]))
    assert library.import_records(records) == 1 and library.count() == 2
    assert library.apply_demo_venues() == 1 and library.search("record").first().venue == "CVPR"
    assert library.delete_by_source_query("user-import") == 1 and library.delete_by_source_query("none") == 0


def test_abstracts_make_derived_tables_stale(library, batch_of, spark):
    library.upsert(batch_of({"title": "A b", "dblp_key": "a"}, {"title": "Has one", "dblp_key": "b", "abstract": "own"}))
    assert not library.is_stale()
    assert library.update_abstract(1, "text", ["k"]).first().keywords == ["k"] and library.is_stale()
    library.update_abstract(1, "")
    hits = spark.createDataFrame([(1, "A b", 0, "A b", "found", ["z"]), (2, "Has one", 0, "Has one", "other", [])],
                                 "paper_id long, query string, _seq long, title string, abstract string, keywords array<string>")
    assert library.enrich_abstracts(hits) == 1
    assert (library.get_paper(1).first().abstract, library.get_paper(2).first().abstract) == ("found", "own")
    library.refresh()
    assert not library.is_stale()


def test_lookup_stores_what_a_source_answers(library, batch_of, spark):
    library.upsert(batch_of({"title": "Vision nets", "dblp_key": "v"}), refresh=False)
    asked = spark.createDataFrame([("a", "vision"), ("b", "diffusion"), ("c", "nobody")], "query_id string, query string")
    hits = batch_of(*[{"title": t, "dblp_key": t} for t in ("Ignored", "Diffusion one", "Diffusion two", "Diffusion three", "Second source")])
    marks = spark.createDataFrame([(0, "a", "X", 0), (1, "b", "X", 0), (2, "b", "X", 0), (3, "b", "X", 0), (4, "b", "Y", 1)],
                                  "_seq long, query_id string, source string, priority int")
    rows = library.lookup(asked, hits.join(marks, "_seq"), limit=2).collect()
    assert sorted((r.query_id, r.source, r.title, r.source_query) for r in rows) == [
        ("a", "local", "Vision nets", None), ("b", "X", "Diffusion one", "diffusion"), ("b", "X", "Diffusion two", "diffusion")]
    assert library.count() == 3


def test_backfill_and_backlog(library, batch_of):
    library.upsert(batch_of({"title": "Deep nets", "dblp_key": "a"}, {"title": "Other", "dblp_key": "b", "venue": "X"}), refresh=False)
    assert [r.id for r in library.backlog().collect()] == [1, 2]
    records = batch_of({"title": "DEEP  Nets", "venue": "Proc. ECCV", "year": 2024})
    assert library.backfill_venues(records) == 1 and library.backfill_venues(records) == 0
    row = library.get_paper(1).first()
    assert (row.venue, row.year, library.is_stale()) == ("ECCV", 2024, True)


def test_collect_grid_keeps_the_cell(library, batch_of):
    records = batch_of({"title": "A", "dblp_key": "a", "venue": "cvpr 2022", "year": 2022}, {"title": "B", "dblp_key": "b", "venue": "CVPR", "year": 1999},
                       {"title": "C", "dblp_key": "c", "venue": "ECCV/CVPR", "year": 2023})
    more = batch_of({"title": "A later", "dblp_key": "a", "venue": "CVPR", "year": 2023})
    assert library.collect_grid(records, more) == 4
    assert sorted((r.title, r.source_query) for r in library.papers().collect()) == [
        ("A later", "CVPR:2023:openalex-crossref"), ("C", "ECCV:2023:openalex-crossref")]


def test_doi_clash_refuses_the_batch(library, batch_of):
    library.upsert(batch_of({"title": "A", "dblp_key": "a", "doi": "10/1"}), refresh=False)
    with pytest.raises(ValueError, match="10/1"):
        library.upsert(batch_of({"title": "B", "dblp_key": "b", "doi": "10/1"}), refresh=False)
    assert library.count() == 1 and library.version() == 1


def test_stream_import_merges_each_batch_once(spark, tmp_path, library):
    arrivals = tmp_path / "in"
    arrivals.mkdir()

    def arrive(name, *rows):
        (arrivals / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run(checkpoint):
        start_import(paper_stream(spark, str(arrivals), 1), library, str(tmp_path / checkpoint), "feed").awaitTermination()

    arrive("1.json", {"title": "One", "dblp_key": "k", "venue": "CVPR", "_seq": 0}, {"title": "Keyless", "_seq": 1})
    run("cp")
    assert library.count() == 2 and library.version() == 1 and not library.is_stale()
    arrive("2.json", {"title": "One again", "dblp_key": "k", "_seq": 0}, {"title": "Two", "dblp_key": "l", "_seq": 1})
    run("cp")
    rows = {r.dblp_key: (r.title, r.venue, r.source_query) for r in library.papers().collect()}
    assert rows == {"k": ("One again", "CVPR", "feed"), "l": ("Two", None, "feed"), None: ("Keyless", None, "feed")}
    # A lost checkpoint replays batch 0 and 1; both are known and change nothing.
    before = library.version()
    run("cp-lost")
    assert library.version() == before and library.count() == 3
    assert set(PAPER_IN.names) - {"_seq"} <= set(library.papers().columns)


def test_second_stream_of_a_source_is_merged(spark, tmp_path, library):
    def run(folder, checkpoint, *titles):
        (tmp_path / folder).mkdir(exist_ok=True)
        for title in titles:
            (tmp_path / folder / f"{title}.json").write_text(json.dumps({"title": title, "dblp_key": title, "_seq": 0}))
        stream = paper_stream(spark, str(tmp_path / folder))
        start_import(stream, library, str(tmp_path / checkpoint), "feed", refresh_every=0).awaitTermination()

    run("a", "cp", "One")
    run("b", "cp-b", "Two")
    assert {r.title for r in library.papers().collect()} == {"One", "Two"}
    # A fresh checkpoint over one more file: its first batch holds both files.
    run("a", "cp-fresh", "Three")
    assert {r.title for r in library.papers().collect()} == {"One", "Two", "Three"}
