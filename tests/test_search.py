"""Search and matching against brute force over small tables."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from citewell.functions.text import match_key
from citewell.operators import match, search
from citewell.plans import registered


@pytest.fixture()
def shelf(papers_of):
    return papers_of(
        {"title": "Vision-Language Representation", "year": 2024, "venue": "CVPR", "doi": "10.1000/demo", "dblp_key": "conf/cvpr/Demo"},
        {"title": "Diffusion 100% Video", "year": 2025, "venue": "ICCV", "keywords": ["Generation", "video"]},
        {"title": "Diffusion back\\slash", "year": 2025, "venue": "eccv"},
        {"title": "Old vision", "keywords": ["vision-language"]},
        {"title": "old  VISION", "year": 2001},
    )


def ids(df):
    return [r.id for r in df.collect()]


def test_fuzzy_search_looks_at_four_fields(shelf):
    assert ids(search.search(shelf, "vision-language")) == [1, 4]
    assert ids(search.search(shelf, " CVPR ")) == [1]
    assert ids(search.search(shelf, "conf/cvpr/demo")) == [1]
    assert ids(search.search(shelf, '"generation", "video"')) == [2]
    assert ids(search.search(shelf, "100%vid")) == [2]
    assert ids(search.search(shelf, "ol_ vision")) == [5, 4]
    assert ids(search.search(shelf, "back\\slash")) == [3]
    assert ids(search.search(shelf, "diffusion", limit=1)) == [2]
    assert ids(search.search(shelf, "absent")) == []


def test_exact_blank_and_lookup(shelf):
    assert ids(search.search(shelf, "OLD vision", exact=True)) == [5, 4]
    assert ids(search.search(shelf, "vision", exact=True)) == []
    assert ids(search.search(shelf, "  ", limit=3)) == [2, 3, 1]
    assert ids(search.paper_by_id(shelf, 4)) == [4] and ids(search.paper_by_id(shelf, 40)) == []


def test_limit_clamp(spark):
    asked = spark.createDataFrame([(i, v) for i, v in enumerate(("250", "0", "bad", None, "7", " 8 ", "-3", "1.5", "9" * 60))], "i int, v string")
    rows = asked.orderBy("i").select(search.page_size(F.col("v")).alias("n")).collect()
    assert [r.n for r in rows] == [100, 1, 50, 50, 7, 8, 1, 50, 100]
    assert asked.select(search.page_size(F.lit(30)).alias("n")).first().n == 30


def test_backlog_order(papers_of):
    papers = papers_of({"title": "a", "year": 2030}, {"title": "b", "venue": "CVPR", "year": 2020}, {"title": "c", "venue": "ECCV", "year": 2021, "abstract": "  "},
                       {"title": "d", "venue": "ICCV"}, {"title": "e", "venue": "CVPR", "abstract": "has"})
    assert ids(search.missing_abstracts(papers)) == [3, 2, 4, 1]
    assert ids(search.missing_abstracts(papers, 1)) == [3]


def brute(papers, queries):
    """(query, paper) pairs by testing every pair."""
    found = set()
    for number, text in queries:
        pattern = re.compile(".*" + "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text) + ".*", re.S)
        for p in papers:
            fields = (p.title_normalized, (p.venue or "").lower(), (p.dblp_key or "").lower(),
                      "[" + ", ".join(f'"{k}"' for k in p.keywords).lower() + "]")
            if any(pattern.fullmatch(f) for f in fields):
                found.add((number, p.id))
    return found


def test_batch_search_equals_brute_force(spark, papers_of):
    rng = random.Random(3)
    letters = "abcé "
    papers = papers_of(*[
        {"title": "".join(rng.choices(letters, k=rng.randint(1, 25))), "venue": rng.choice(["CVPR", "x y", None]), "year": rng.choice([2020, 2021, None]),
         "keywords": rng.choices(["ab", "a b", "cé"], k=rng.randint(0, 2)), "dblp_key": rng.choice([None, "k/ab"])} for _ in range(150)])
    texts = ["".join(rng.choices("abcé %_", k=rng.randint(1, 9))) for _ in range(60)] + ["%", "_", "", " ", "_" * 22, "%_%_", "k/ab", "it's", "ab\\"]
    queries = [(i, " ".join(t.split())) for i, t in enumerate(texts)]
    asked = spark.createDataFrame(queries, "query_id int, query string")
    got = [(r.query_id, r.id) for r in search.query_matches(papers, asked).collect()]
    want = brute(papers.collect(), queries)
    assert len(got) == len(set(got)) and set(got) == want
    place = {p.id: (-(p.year or 0), p.title, p.id) for p in papers.collect()}
    newest = {q: sorted((p for r, p in want if r == q), key=place.get)[:4] for q, _ in queries}
    shown = sorted((r.query_id, r.position, r.id) for r in search.batch_search(papers, asked, 4).collect())
    assert shown == sorted((q, i + 1, p) for q, ids in newest.items() for i, p in enumerate(ids))


def test_batch_search_facets_and_limit(spark, shelf):
    asked = spark.createDataFrame(
        [("a", "vision"), ("b", "venue:iccv year:2025"), ("c", "diffusion venue:ECCV"), ("d", "year:2025"), ("e", "nothing here")], "query_id string, query string")
    rows = search.batch_search(shelf, asked, limit=2).collect()
    assert sorted((r.query_id, r.position, r.id) for r in rows) == [("a", 1, 1), ("a", 2, 5), ("b", 1, 2), ("c", 1, 3), ("d", 1, 2), ("d", 2, 3)]
    exact = search.batch_exact(shelf, asked.limit(0).union(spark.createDataFrame([("x", "Old VISION")], asked.schema)))
    assert sorted((r.position, r.id) for r in exact.collect()) == [(1, 5), (2, 4)]


def test_stored_of_loses_no_row(spark, shelf):
    fetched = spark.createDataFrame([("conf/cvpr/Demo",), ("other",), (None,)], "dblp_key string")
    assert ids(search.stored_of(shelf, fetched)) == [1]


def test_abstract_match_drops_arxiv_number_and_rejects_unrelated(spark):
    hits = spark.createDataFrame(
        [(1, "2508.13073 Large VLM-based Vision-Language-Action Models", 0, "Unrelated thing", "wrong", ["w"]),
         (1, "2508.13073 Large VLM-based Vision-Language-Action Models", 1, "Large VLM-based Vision-Language-Action Models", "exact", []),
         (2, "Cooking for beginners", 0, "Quantum chromodynamics", "no", ["n"]),
         (3, "Graph nets", 0, "Graph nets", None, []), (3, "Graph nets", 1, "Graph net", "near", ["k"]), (3, "Graph nets", 2, "Graph net", "later", [])],
        "paper_id long, query string, _seq long, title string, abstract string, keywords array<string>")
    got = {r.id: (r.abstract, r.keywords) for r in match.best_abstracts(hits).collect()}
    assert got == {1: ("exact", None), 3: ("near", ["k"])}


def test_best_abstracts_equal_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcd", k=3))
    base = [" ".join(word() for _ in range(5)) for _ in range(40)]
    hits = []
    for paper, title in enumerate(base):
        for seq in range(6):
            kept = [w if rng.random() < 0.6 else word() for w in title.split()]
            hits.append((paper, title, seq, " ".join(kept), rng.choice(["text", "", None]) and f"abstract {paper} {seq}", []))
    df = spark.createDataFrame(hits, "paper_id long, query string, _seq long, title string, abstract string, keywords array<string>")
    want = {}
    for paper, title, seq, candidate, abstract, _ in hits:
        ratio = SequenceMatcher(None, title, candidate).ratio()
        if abstract and ratio >= 0.65 and (paper not in want or ratio > want[paper][0]):
            want[paper] = (ratio, abstract)
    assert {r.id: (r.similarity, r.abstract) for r in match.best_abstracts(df).collect()} == want


def _best_of_all_pairs(titles, records):
    best = {}
    for paper, a in titles:
        for seq, b, abstract in sorted(records):
            if abstract and 2 * min(len(a), len(b)) >= 0.65 * (len(a) + len(b)):
                ratio = SequenceMatcher(None, a, b).ratio()
                if ratio >= 0.65 and (paper not in best or ratio > best[paper][0]):
                    best[paper] = (ratio, seq)
    return best


def test_matched_abstracts_equal_all_pairs(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    base = [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(60)]

    def edited(title):
        words = [w if rng.random() < 0.8 else word() for w in title.split()]
        return " ".join(words[: rng.randint(max(1, len(words) - 2), len(words))])

    records = [(i, edited(t), f"abstract {i}" if rng.random() < 0.8 else rng.choice([None, ""])) for i, t in enumerate(base * 5)]
    records += [(500 + i, "the common words of all", f"c {i}") for i in range(40)]
    titles = [(i, t) for i, t in enumerate(base)] + [(900, "the common words of all"), (901, ""), (902, "zzzz"), (903, "the common word of all")]
    left = spark.createDataFrame(titles, "paper_id long, title string")
    right = spark.createDataFrame([(*r, ["k"] if r[0] % 2 else []) for r in records], "_seq long, title string, abstract string, keywords array<string>")
    got = {r.id: (r.similarity, int(r.abstract.split()[1]) + (500 if r.abstract[0] == "c" else 0), r.keywords) for r in match.matched_abstracts(left, right).collect()}
    want = _best_of_all_pairs(titles, records)
    missed = [p for p in want if p not in got or got[p][0] < want[p][0]]
    assert len(want) > 50 and len(missed) <= 1, missed
    assert all(p in want and got[p] == (*want[p], ["k"] if want[p][1] % 2 else None) for p in got if p not in missed)


def test_matched_abstracts_of_the_given_titles(spark):
    """Recall 1.0 against all pairs of the smallest tables."""
    titles, records = registered._titles_and_records(spark, "/root/testdata/sf0.001")
    key = match_key(F.col("title")).alias("key")
    left = [(r[0], r.key) for r in titles.select("paper_id", key).collect()]
    right = [(r[0], r.key, "text") for r in records.select("_seq", key).collect()]
    got = {r.id: r.similarity for r in match.matched_abstracts(titles, records).collect()}
    assert got == {p: ratio for p, (ratio, _) in _best_of_all_pairs(left, right).items()}


def test_title_hits_share_the_rarest_word(spark):
    titles = spark.createDataFrame([(1, "Common rare"), (2, "common"), (3, "absent")], "paper_id long, title string")
    records = spark.createDataFrame([(i, "common word", f"a{i}", []) for i in range(9)] + [(9, "Rare common", "r", [])],
                                    "_seq long, title string, abstract string, keywords array<string>")
    got = sorted((r.paper_id, r._seq) for r in match.title_hits(titles, records).collect())
    assert got == [(1, 9), *((2, i) for i in range(10))]


def test_venue_backfill(spark, papers_of):
    papers = papers_of({"title": "Deep Nets"}, {"title": "deep  nets", "venue": " ", "year": 2020}, {"title": "Deep Nets", "venue": "Kept"}, {"title": "Other"}, {"title": "Late"})
    records = spark.createDataFrame(
        [("DEEP nets", "Nowhere", 2001, 0), ("deep nets", "Proc. ICCV", 2023, 1), ("deep nets", "CVPR", 2024, 2), ("Other", "arXiv", 2020, 3)]
        + [("late", "none", None, i) for i in range(4, 7)] + [("late", "CVPR", 2020, 7)], "title string, venue string, year int, _seq long")
    rows = {r.id: (r.venue, r.year) for r in match.backfill_venues(papers, records).collect()}
    assert rows == {1: ("ICCV", 2023), 2: ("ICCV", 2020), 3: ("Kept", None), 4: (None, None), 5: ("CVPR", 2020)}


def test_local_first(spark, shelf):
    asked = spark.createDataFrame([("a", "vision-language"), ("b", "elsewhere"), ("c", "nobody")], "query_id string, query string")
    hits = spark.createDataFrame(
        [("a", "OpenAlex", 0, 0, "ignored", 2020, None), ("b", "Crossref", 1, 0, "second source", 2020, None),
         ("b", "OpenAlex", 0, 1, "first source", 2021, None)],
        "query_id string, source string, priority int, _seq long, title string, year int, venue string")
    rows = sorted((r.query_id, r.source, r.title) for r in match.local_first(shelf, asked, hits).collect())
    assert rows == [("a", "local", "Old vision"), ("a", "local", "Vision-Language Representation"), ("b", "OpenAlex", "first source")]
