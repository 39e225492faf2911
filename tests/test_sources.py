"""Readers over small hand-written files."""

import hashlib
import json
import os

from citewell.operators import catalog, collect
from citewell.sources import listing, providers, records, sinks


def write(path, *documents):
    path.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in documents), encoding="utf-8")
    return str(path)


def test_records_list_envelope_and_lines(spark, tmp_path):
    one = {"title": " A  ", "year": 2024, "keywords": ["k", 1], "dblp_key": " conf/a "}
    two = {"title": "B", "authors": ["x"], "year": 0, "paper_type": ""}
    blank = {"title": "  "}
    enveloped = write(tmp_path / "e.json", {"papers": [one, blank, two]})
    listed = write(tmp_path / "l.json", [one, blank, two])
    lines = write(tmp_path / "n.json", one, blank, two)
    key = "bulk-import:" + hashlib.sha256(b"b").hexdigest()[:24]
    want = [("A", [], 2024, "conf/a", "bulk-import", ["k", "1"]), ("B", ["x"], None, key, "bulk-import", [])]
    for path, multi in ((enveloped, True), (listed, True), (lines, False), (enveloped, False)):
        rows = records.read_records(spark, path, multi_line=multi).orderBy("_seq").collect()
        assert [(r.title, r.authors, r.year, r.dblp_key, r.paper_type, r.keywords) for r in rows] == want


def test_titles(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("Imported paper\n\n   \n Other \n")
    rows = records.read_titles(spark, str(path), "ECCV", 2024).orderBy("_seq").collect()
    assert [(r.title, r.venue, r.year, r.paper_type) for r in rows] == [
        ("Imported paper", "ECCV", 2024, "user-import"), ("Other", "ECCV", 2024, "user-import")]
    assert rows[0].dblp_key == "user-import:" + hashlib.sha256(b"imported paper").hexdigest()[:24]


def dblp(hit):
    return {"result": {"hits": {"@total": "2", "hit": hit}}}


def test_dblp_shapes(spark, tmp_path):
    many = [
        {"info": {"title": " T1 ", "authors": {"author": [{"text": " A B "}, {"name": "C"}, "D", {"text": "", "name": ""}]},
                  "venue": "CVPR", "year": "2024", "doi": "10.1/x", "url": "u", "ee": ["e1", {"href": "e2"}], "key": "k1", "type": "t"}},
        {"info": {"title": ""}},
        {"info": {"title": "T2", "authors": {"author": {"text": "Solo"}}, "year": "n.d.", "ee": {"text": "e3", "href": "no"}}},
    ]
    single = {"info": {"title": "T3", "authors": {"author": "Only"}, "ee": "e4"}}
    bare = write(tmp_path / "bare.json", dblp(many), dblp(single), {"result": {"hits": {"@total": "0"}}})
    raw = write(tmp_path / "raw.json", {"source": "s", "pages": [dblp(many), dblp(single)]})
    want = [
        ("T1", ["A B", "C", "D"], "CVPR", 2024, "10.1/x", ["e1", "e2"], "k1", "t"),
        ("T2", ["Solo"], None, None, None, ["e3"], None, None),
        ("T3", ["Only"], None, None, None, ["e4"], None, None),
    ]
    for path in (bare, raw):
        rows = providers.read_dblp(spark, path).orderBy("_seq").collect()
        assert [(r.title, r.authors, r.venue, r.year, r.doi, r.electronic_edition, r.dblp_key, r.paper_type) for r in rows] == want


def test_openalex_filters_by_the_query_facets(spark, tmp_path):
    def item(i, venue, year, **more):
        return {"id": f"W{i}", "title": f"T{i}", "publication_year": year, "primary_location": {"source": {"display_name": venue}}, **more}

    page = {"query": "x venue:eccv year:2024", "results": [
        item(1, "European Conference on Computer Vision", 2024, doi="https://doi.org/10.1/a", authorships=[{"author": {"display_name": "N"}}, {"author": None}],
             concepts=[{"display_name": "C"}, {"display_name": ""}], abstract_inverted_index={"vision": [1], "Learning": [0]}),
        item(2, "CVPR", 2024), item(3, "ECCV", 2023), {"title": None}, {"title": "no location", "primary_location": None},
    ]}
    free = {"results": [item(4, None, None, id=None)]}
    rows = providers.read_openalex(spark, write(tmp_path / "o.json", page, free)).orderBy("_seq").collect()
    assert [r.title for r in rows] == ["T1", "T4"]
    first, other = rows
    assert (first.authors, first.keywords, first.abstract) == (["N"], ["C"], "Learning vision")
    assert (first.doi, first.electronic_edition, first.dblp_key) == ("https://doi.org/10.1/a", ["https://doi.org/10.1/a"], "openalex:W1")
    assert (other.dblp_key, other.year, other.electronic_edition, other.abstract) == ("openalex:T4", None, [], None)


def test_crossref(spark, tmp_path):
    items = [
        {"DOI": "10.2/x", "title": [" T "], "container-title": ["ICCV"], "author": [{"given": "A", "family": "B"}, {"family": "C"}, {}],
         "issued": {"date-parts": [[2024, 1]]}, "URL": "http://u", "abstract": "<jats:p>a &amp; b</jats:p>", "subject": ["s"]},
        {"title": ["Bare"], "container-title": []},
        {"title": []},
    ]
    rows = providers.read_crossref(spark, write(tmp_path / "c.json", {"message": {"items": items}})).orderBy("_seq").collect()
    assert [(r.title, r.authors, r.venue, r.year, r.doi, r.electronic_edition, r.abstract, r.keywords, r.dblp_key) for r in rows] == [
        ("T", ["A B", "C", ""], "ICCV", 2024, "10.2/x", ["http://u"], " a & b ", ["s"], "crossref:10.2/x"),
        ("Bare", [], None, None, None, [], None, [], "crossref:Bare"),
    ]


def test_pdf_listing(spark, tmp_path):
    for name in ("ICCV2025/deep/finished.pdf", "ICCV2025/unfinished.pdf.baiduyun.downloading", "ICCV2025/part.BaiduYun.pdf",
                 "CV 2025 综述/ICCV2025 retrieval.pdf", "elsewhere/other.pdf", "ICCV2025/notes.txt"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"%PDF")
    rows = listing.from_paths(listing.list_pdfs(spark, str(tmp_path))).orderBy("_seq").collect()
    assert [r.title for r in rows] == ["ICCV2025 retrieval", "finished"]
    path = tmp_path / "CV 2025 综述/ICCV2025 retrieval.pdf"
    assert rows[0].electronic_edition == [path.as_uri()]
    assert rows[0].dblp_key == "local-pdf:" + hashlib.sha256(str(path).encode()).hexdigest()[:24]
    assert (rows[0].venue, rows[0].paper_type) == ("ICCV", "local-pdf")
    inside = listing.from_paths(listing.list_pdfs(spark, str(tmp_path / "ICCV2025")))
    assert [r.title for r in inside.collect()] == ["finished"]


def test_sinks(spark, papers_of, tmp_path):
    papers = papers_of({"title": "b", "year": 2020}, {"title": "a", "year": 2020}, {"title": "c"}, {"title": "d", "year": 2024})
    sinks.export_json(papers, str(tmp_path / "out"))
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["title"] for x in lines] == ["d", "a", "b", "c"]

    numbered = sinks.numbered_batches(papers, 3).orderBy("row_index").collect()
    assert [(r.title, r.row_index, r.batch_no) for r in numbered] == [("d", 1, 0), ("a", 2, 0), ("b", 3, 0), ("c", 4, 1)]
    sinks.export_batches(papers, str(tmp_path / "batches"), 1, batches_per_folder=2)
    assert spark.read.json(str(tmp_path / "batches")).select("batch_group", "batch_no").distinct().count() == 4

    sinks.write_collection(papers, str(tmp_path / "run"), "src", "http://s", ["q1", "q2"], "2025-01-01 00:00:00")
    row = spark.read.json(str(tmp_path / "run/provenance")).first()
    assert (row["count"], row["source"], row["queries"]) == (4, "src", ["q1", "q2"])


def _write(path, text, at):
    path.write_text(text)
    os.utime(path, (at, at))


def test_records_arrive_by_time_not_by_size(spark, tmp_path):
    _write(tmp_path / "b.json", "\n".join(f'{{"title": "first {i}"}}' for i in range(3)), 1_000)
    _write(tmp_path / "a.json", "\n".join(f'{{"title": "later {i}", "abstract": "{"x" * 5000}"}}' for i in range(40)), 2_000)
    _write(tmp_path / "c.json", '{"papers": [{"title": "last 0"}, {"title": "last 1"}]}', 3_000)
    got = [r.title for r in records.read_records(spark, str(tmp_path)).orderBy("_seq").collect()]
    assert got == [f"first {i}" for i in range(3)] + [f"later {i}" for i in range(40)] + ["last 0", "last 1"]


def test_titles_arrive_by_time_not_by_size(spark, tmp_path):
    _write(tmp_path / "z.txt", "one\ntwo", 1_000)
    _write(tmp_path / "a.txt", "\n".join("long " * 500 + str(i) for i in range(30)) + "\nlast", 2_000)
    got = [r.title for r in records.read_titles(spark, str(tmp_path)).orderBy("_seq").collect()]
    assert got[:2] == ["one", "two"] and got[-1] == "last" and len(got) == 33


def test_last_arrival_wins_in_a_merge(spark, tmp_path, papers_of):
    _write(tmp_path / "b.json", '{"title": "Old", "dblp_key": "k", "venue": "CVPR"}', 1_000)
    _write(tmp_path / "a.json", '{"title": "New", "dblp_key": "k", "abstract": "' + "x" * 9000 + '"}\n{"title": "Other"}', 2_000)
    merged = catalog.merge_upsert(papers_of(), records.read_records(spark, str(tmp_path)), "s").orderBy("id").collect()
    assert [(r.title, r.venue) for r in merged] == [("New", "CVPR"), ("Other", None)]


def test_unreadable_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"title": "whole"}\n{"title": "cut sho\n{"title": "odd", "authors": "A"}\n')
    assert sorted(r.title for r in records.read_records(spark, str(tmp_path)).collect()) == ["odd", "whole"]
    assert sorted((r.line[:16], r.title) for r in records.unreadable_records(spark, str(tmp_path)).collect()) == [
        ('{"title": "cut s', None), ('{"title": "odd",', "odd")]
    assert [(r.lines, r.lost) for r in records.unreadable_counts(spark, str(tmp_path)).collect()] == [(2, 1)]


def test_sources_keep_their_order(spark, batch_of):
    first, second = batch_of({"title": "a2", "_seq": 7}, {"title": "a1", "_seq": 3}), batch_of({"title": "b", "_seq": 0})
    assert [r.title for r in collect.in_source_order(first, second).orderBy("_seq").collect()] == ["a1", "a2", "b"]


def test_brackets_in_a_name_survive(spark, tmp_path):
    page = '{"query": "q", "result": {"hits": {"hit": {"info": {"title": "T", "authors": {"author": %s}, "ee": %s, "key": "k"}}}}}'
    lines = [page % ('"[Anon] X"', '"[x](y)"'), page % ('["[A] B", {"text": "[C] D"}]', '["l", {"href": "m"}]'), page % ("null", "null")]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    rows = providers.read_dblp(spark, str(tmp_path)).orderBy("_seq").collect()
    assert [r.authors for r in rows] == [["[Anon] X"], ["[A] B", "[C] D"], []]
    assert [r.electronic_edition for r in rows] == [["[x](y)"], ["l", "m"], []]
    assert {r["query"] for r in rows} == {"q"}
