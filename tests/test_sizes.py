"""Steps whose work must not grow with copies, hot words or chance pairs."""

import random
import re
import time
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from citewell.functions.text import inverted_abstract
from citewell.operators import match, search
from citewell.plans import registered
from citewell.session import staged


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_equal_letters_in_another_order_get_no_ratio(spark):
    a = "the quick brown fox jumps over lazy dogs"
    df = spark.createDataFrame([(a, a[::-1]), (a, a), (a, a[:30] + " cat"), ("ab", "ba")], "a string, b string")
    got = [r[0] for r in df.select(match._could_reach(F.col("a"), F.col("b"), 0.65)).collect()]
    assert got == [False, True, True, False]


def test_bound_never_drops_a_ratio(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choices("abc ", k=rng.randint(1, 30))), "".join(rng.choices("abc ", k=rng.randint(1, 30)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("ok", match._could_reach(F.col("a"), F.col("b"), 0.65))
    assert all(r.ok for r in df.collect() if SequenceMatcher(None, r.a, r.b).ratio() >= 0.65)


def test_similar_keys_are_the_same_for_any_blocks(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(30)]
    keys = sorted({" ".join(rng.choices(words, k=rng.randint(1, 8))) for _ in range(120)})
    left, right = (spark.createDataFrame([(k,) for k in part], "key string") for part in (keys[::2], keys[1::2]))
    whole = {tuple(r) for r in match.similar_keys(left, right).collect()}
    monkeypatch.setattr(match, "_TARGET_BLOCKS", (3, 8, 9))
    monkeypatch.setattr(match, "_CANDIDATE_BLOCKS", (4, 5, 7))
    monkeypatch.setattr(match, "_ROWS_AT_ONCE", 2)
    assert whole and {tuple(r) for r in match.similar_keys(left, right).collect()} == whole


def test_similar_keys_miss_no_pair_of_all(spark):
    """Pairs without a common gram, and long ones of which only rare letters start a match; runs of one letter and of odd letters, too."""
    rng = random.Random(7)
    wide = "abcdefghijklmnopqrstuvwxyz"
    keys = ["a", "b", "z" * 205, "z" * 230, "é" * 40, "é" * 50 + "𝄞"]
    for _ in range(25):
        keys.append("".join(rng.choices("ab", k=rng.randint(1, 90))))
        keys.append("".join(rng.choices(wide[: rng.randint(2, 26)] + "      ", k=rng.choice((3, 12, 63, 64, 126, 199, 200, 201, 320)))))
    for key in [*keys]:
        for share in (0.04, 0.12, 0.2, 0.3):
            kept = [x if rng.random() >= share else rng.choice(wide + "qqqq0123456789") for x in key]
            at = rng.randrange(len(kept) + 1)
            keys.append("".join(kept[at:] + kept[:at] if share == 0.2 else kept if share < 0.3 else kept[: len(kept) * 2 // 3] or kept))
    for _ in range(30):
        base = [rng.choice("etaoinshrdl  ") if rng.random() < 0.95 else rng.choice("qxzjkvwypb0123") for _ in range(rng.randint(205, 420))]
        for edits in (0, 1, 4, 9, 15):
            kept = [*base]
            for at in rng.sample(range(len(base)), edits):
                kept[at : at + 3] = rng.choices("etaoinq", k=rng.randint(0, 6))
            keys.append("".join(kept))
    keys = sorted({k for k in keys if k.strip()})
    rng.shuffle(keys)
    sides = ["abcdef", *keys[::2]], ["axbxcxdxexf", *keys[1::2]]
    left, right = (spark.createDataFrame([(k,) for k in side], "key string") for side in sides)
    want = {(a, b) for a in sides[0] for b in sides[1] if SequenceMatcher(None, a, b).ratio() >= 0.65}
    assert sum(len(b) >= 200 for _, b in want) > 20 and sum(len(b) < 200 for _, b in want) > 100 and ("abcdef", "axbxcxdxexf") in want
    got = {tuple(r) for r in match.similar_keys(left, right).collect()}
    assert not want - got and len(got) < len(keys) ** 2 / 8


def test_equal_queries_are_searched_once(spark, papers_of, monkeypatch):
    papers = papers_of({"title": "Deep vision nets", "year": 2020}, {"title": "Vision", "year": 2021})
    rows = {}

    def counting(df, name):
        rows[name] = df.count()
        return original(df, name)

    original = search.staged
    monkeypatch.setattr(search, "staged", counting)
    asked = spark.createDataFrame([(i, "vision") for i in range(50)], "query_id int, query string")
    found = search.query_matches(papers, asked)
    assert sorted((r.query_id, r.id) for r in found.collect()) == [(i, p) for i in range(50) for p in (1, 2)]
    assert rows["asked-queries"] == 1 and rows["met"] == 2
    shown = search.batch_search(papers, asked, 1).collect()
    assert sorted((r.query_id, r.position, r.id) for r in shown) == [(i, 1, 2) for i in range(50)]


def test_matches_are_counted_before_they_meet_the_ids_that_ask(spark, papers_of, monkeypatch):
    shelf = papers_of({"title": "Deep vision nets", "year": 2020}, {"title": "Vision", "year": 2021}, {"title": "a graph", "year": 2021})
    asked = spark.createDataFrame([(i % 30, q) for i in range(60) for q in ("vision", "year:2021", "nothing")] + [(77, "%"), (None, "graph")], "query_id int, query string")
    monkeypatch.setattr(registered, "papers", lambda *_: shelf)
    monkeypatch.setattr(registered, "_facet_queries", lambda *_: asked)
    counted = registered.QUERIES["batch_matches"](spark, "")
    pairs = search.query_matches(shelf, asked).groupBy("query_id").agg(F.count("*").alias("matches"), F.max("id").alias("last_id"))
    assert sorted(counted.collect(), key=str) == sorted(pairs.collect(), key=str) and counted.schema == pairs.schema
    assert {r.query_id: (r.matches, r.last_id) for r in counted.collect()}[0] == (8, 3)
    plan = _optimized(counted)
    assert re.search(r"Join Inner, \(?ask#", plan) and "Aggregate [ask#" in plan[plan.index("Join Inner, ("):]


def test_wildcards_take_no_time_with_a_power_of_the_length(spark):
    """All places of a part were tried again for each place of the part before."""
    texts = [("a b c d " * 4_000, "%a%b%c%d%e%"), ("a b c d " * 3, "%d%_a%d_"), ("xx(y", "x(%"), ("xy%", "x__"), ("", "%"), ("ab\nba", "b%b"), ("aab", "%ab"), ("aXbab", "a_b%b")]
    df = spark.createDataFrame(texts, "text string, pattern string")
    began = time.time()
    got = [r[0] for r in df.select(F.rlike("text", search.wildcard_regex(F.col("pattern")))).collect()]
    assert time.time() - began < 30 and got == [False, True, True, True, True, True, True, True]
    like = [r[0] for r in df.where("length(text) < 100").select(F.like("text", search.like_pattern(F.col("pattern")))).collect()]
    assert like == got[1:]


def test_an_id_that_asks_twice_has_one_numbered_list(spark, papers_of):
    papers = papers_of({"title": "a vision", "year": 2020}, {"title": "a graph", "year": 2021})
    asked = spark.createDataFrame([(1, "vision"), (1, "graph"), (1, "graph")], "query_id int, query string")
    got = [(r.position, r.id) for r in search.batch_search(papers, asked, 2).orderBy("position").collect()]
    assert got == [(1, 2), (2, 2)]


def test_longer_queries_are_located_by_whole_words(spark, papers_of, monkeypatch):
    papers = papers_of({"title": "the deep vision nets of all"}, {"title": "the vision"}, {"title": "deepvision nets"})
    staged_names = []
    original = search.staged
    monkeypatch.setattr(search, "staged", lambda df, name: staged_names.append((name, df.count())) or original(df, name))
    asked = spark.createDataFrame([(1, "e deep vision n"), (2, "epvis"), (3, "p v")], "query_id int, query string")
    got = sorted((r.query_id, r.id) for r in search.query_matches(papers, asked).collect())
    assert got == [(1, 1), (2, 3), (3, 1)]
    assert dict(staged_names)["asked-words"] == 2  # "deep" and "vision" of the first


def test_word_positions_are_built_without_a_row_for_each_word(spark):
    docs = spark.createDataFrame([(1, "b a  b"), (2, ""), (3, None), (4, "x"), (4, "y x"), (None, "n")], "doc_id long, text string")
    index = registered._word_positions(docs)
    assert "Generate" not in _optimized(index)
    got = {r.doc_id: {w: sorted(p) for w, p in r["index"].items()} for r in index.collect()}
    assert got == {1: {"b": [0, 3], "a": [1], "": [2]}, 2: {"": [0]}, 4: {"x": [0, 1], "y": [0]}, None: {"n": [0]}}
    assert index.where("doc_id = 1").select(inverted_abstract(F.col("index"))).first()[0] == "b a  b"


def test_found_titles_are_joined_last(spark):
    titles = spark.createDataFrame([(1, "rare one"), (2, "common")], "paper_id long, title string")
    records = spark.createDataFrame([(i, "common", "a", []) for i in range(3)] + [(9, "Rare", "r", [])],
                                    "_seq long, title string, abstract string, keywords array<string>")
    hits = match.title_hits(titles, records)
    first_join = next(line for line in _optimized(hits).splitlines() if "Join" in line)
    assert re.search(r"word#\d+ = word#\d+", first_join)
    assert sorted((r.paper_id, r._seq) for r in hits.collect()) == [(1, 9), (2, 0), (2, 1), (2, 2)]


def test_titles_are_not_shuffled_with_their_words(spark, monkeypatch):
    title = " ".join(f"w{i}" for i in range(40))
    titles = spark.createDataFrame([(1, title), (1, title), (2, title + " rare"), (None, "w3 w4"), (3, None)], "paper_id long, title string")
    records = spark.createDataFrame([(i, f"w{i} w39", "a", []) for i in range(40)] + [(90, "rare", "r", [])],
                                    "_seq long, title string, abstract string, keywords array<string>")
    plans = {}
    original = match.staged
    monkeypatch.setattr(match, "staged", lambda df, name: plans.update({name: _optimized(df)}) or original(df, name))
    hits = match.title_hits(titles, records)
    folded = next(line for line in plans["rarest-words"].splitlines() if "Aggregate [paper_id" in line)
    assert "title" not in folded
    got = sorted(((r.paper_id, r.query, r._seq) for r in hits.collect()), key=str)
    assert got == sorted([(1, title, 0), (2, title + " rare", 90), (None, "w3 w4", 3)], key=str)


def test_stage_tables_leave_no_shuffle_files(spark):
    """Shuffles behind a stage table are not kept until the driver collects its garbage; the user's setting stays."""
    def shuffle_bytes():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))

    keys = spark.range(200_000).withColumn("k", F.expr("xxhash64(id)"))
    before = shuffle_bytes()
    made = staged(keys.groupBy("k").count(), "released")
    after = shuffle_bytes()
    assert made.count() == 200_000 and after <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
