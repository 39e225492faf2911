"""Column expressions against Python's own text functions."""

import hashlib
import re
from pathlib import PurePosixPath

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from citewell.functions import keys, text, tokens, venues, vocab
from citewell.sources.providers import crossref_year


def evaluate(spark, build, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


SAMPLES = [
    "Vision-Language  Representation", "  Straße\tund Öl \n", "ﬁne ﬂow", "ΣΊΣΥΦΟΣ", "plain", "", "a_b 3D  x", "naïve café",
]


def test_normalize_title_is_casefold_and_collapse(spark):
    assert evaluate(spark, text.normalize_title, SAMPLES) == [
        "vision-language representation", "strasse und öl", "fine flow", "σίσυφοσ", "plain", "", "a_b 3d x", "naïve café",
    ]


def test_match_key(spark):
    samples = SAMPLES + ["2508.13073 Vision, Language!", "2508.1307 x", "12508.13073 y", "2508.13073", "x 2508.13073 y"]
    assert evaluate(spark, text.match_key, samples) == [
        "vision language representation", "strasse und l", "fine flow", "", "plain", "", "a b 3d x", "na ve caf",
        "vision language", "x", "12508 13073 y", "2508 13073", "x 2508 13073 y",
    ]


def test_tokens_match_the_pattern_and_drop_stop_words(spark):
    samples = ["The state-of-the-art survey of 3D U-Net models, été-x abc- abc-é x1y_z", "", "of the and", "éclair clair-3 ab abc"]
    pattern = re.compile(r"(?u)\b[a-zA-Z][a-zA-Z0-9-]{2,}\b")
    want = [[t for t in pattern.findall(s.lower()) if t not in vocab.STOP_WORDS] for s in samples]
    assert evaluate(spark, tokens.tokens, samples) == want


def test_ngrams_bridge_removed_words(spark):
    got = evaluate(spark, lambda c: tokens.ngrams(tokens.tokens(c)), ["graph of the networks paper learning", "alone", ""])
    assert got == [["graph", "networks", "learning", "graph networks", "networks learning"], ["alone"], []]


def test_known_words_limit_pairs(spark):
    rows = spark.createDataFrame([(["aa", "bb", "cc", "aa", "bb"],)], "w array<string>")
    kept = rows.select(tokens.known_words("w", ["aa", "bb", "it's \\ odd"]).alias("w"))
    assert kept.select(tokens.bigrams(F.col("w"))).first()[0] == ["aa bb", "aa bb"]


def test_stop_words_are_sparks_list(spark):
    assert list(vocab.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(vocab.DOMAIN_STOP_WORDS) == 15


def test_title_case(spark):
    samples = ["vision-language 3d", "x1y ab", "a", ""]
    assert evaluate(spark, text.title_case, samples) == [s.title() for s in samples]


def test_cluster_label_falls_back_to_number(spark):
    rows = spark.createDataFrame([(["deep nets", "gan"], 0), ([], 2)], "t array<string>, c int")
    got = [r[0] for r in rows.select(text.cluster_label(F.col("t"), F.col("c"))).collect()]
    assert got == ["Deep Nets / Gan", "方向 3"]


def test_strip_markup_decodes_first(spark):
    samples = ["<p>a &lt;b&gt; c</p>", "x &amp;lt; y &copy 1 &eacute;", "no markup", None, "a<br/>b", "1 < 2", ""]
    want = [" a   c ", "x &lt; y © 1 é", "no markup", None, "a b", "1 < 2", ""]
    assert evaluate(spark, text.strip_markup, samples) == want


def test_inverted_abstract(spark):
    maps = [{"vision": [1], "Learning": [0]}, {}, None, {"b": [1, 3], "a": [0, 2]}, {"z": [0], "a": [0]}]
    got = evaluate(spark, text.inverted_abstract, maps, "map<string,array<int>>")
    assert got == ["Learning vision", None, None, "a b a b", "a z"]


def test_keyword_list(spark):
    assert evaluate(spark, text.keyword_list, [" a, b ,, c", "", " , "]) == [["a", "b", "c"], [], []]


def test_json_text_has_spaced_commas(spark):
    got = evaluate(spark, text.json_text, [["a", 'q"x', "[y]"], []], "array<string>")
    assert got == ['["a", "q\\"x", "[y]"]', "[]"]


def test_facets(spark):
    samples = ["representation venue:cvpr year:2025", "venue:ICML year:1999 x", "avenue:cvpr year:20255", "Year:2024  a   b VENUE:Eccv"]
    assert evaluate(spark, venues.facet_venue, samples) == ["CVPR", None, None, "ECCV"]
    assert evaluate(spark, venues.facet_year, samples) == [2025, None, None, 2024]
    assert evaluate(spark, venues.facet_text, samples) == ["representation", "venue:ICML year:1999 x", "avenue:cvpr year:20255", "a b"]


def test_facet_predicate_uses_aliases(spark):
    rows = spark.createDataFrame(
        [("ICCV", 2024, "IEEE/CVF International Conference on Computer Vision", 2024), ("ICCV", 2024, "CVPR", 2024),
         ("ICCV", 2024, "ICCV", None), (None, None, None, None), ("ECCV", None, None, 2020)],
        "wv string, wy int, v string, y int",
    )
    got = [r[0] for r in rows.select(venues.facets_match(*[F.col(c) for c in ("wv", "wy", "v", "y")])).collect()]
    assert got == [True, False, False, True, False]


def test_canonical_venue_takes_the_first_name(spark):
    samples = ["Proc. eccv and cvpr", "ICCV Workshops", "NeurIPS", None]
    assert evaluate(spark, venues.canonical_venue, samples) == ["CVPR", "ICCV", None, None]


def test_file_title(spark):
    titles = {
        "Vision Transformers CVPR 2024 paper_review.pdf": "Vision Transformers", "object_tracking.pdf": "object tracking",
        "a.b_c  .pdf": "a.b c", "x ECCV 2022 Papers.pdf": "x ECCV 2022 Papers", "_-odd-_.pdf": "odd", "y iccv 2021 Paper.v2.pdf": "y",
    }
    assert evaluate(spark, venues.file_title, list(titles)) == list(titles.values())


def test_path_facets(spark):
    paths = ["ICCV2025/object_tracking.pdf", "/a/cvpr papers/2023/x.pdf", "/a/CVPR1999/x.pdf", "/none/x.pdf", "/eccv"]
    assert evaluate(spark, venues.path_venue, paths) == ["ICCV", "CVPR", None, None, None]
    assert evaluate(spark, venues.path_year, paths) == [2025, 2023, None, None, None]


def test_keys(spark):
    digest = hashlib.sha256("my title".encode()).hexdigest()[:24]
    assert evaluate(spark, lambda c: keys.title_key("user-import", c), ["  My   Title "]) == ["user-import:" + digest]
    assert evaluate(spark, keys.doi_url, ["10.1/x", "https://doi.org/10.1/x"]) == ["https://doi.org/10.1/x"] * 2
    assert evaluate(spark, keys.bare_doi, ["10.1/X", "http://dx.doi.org/10.1/x"]) == ["10.1/x"] * 2
    path = "/data/CV 2025 综述/a~b*c+d(é).pdf"
    assert evaluate(spark, keys.file_uri, [path]) == [PurePosixPath(path).as_uri()]
    assert evaluate(spark, keys.file_uri, ["hdfs://nn/a/x.pdf"]) == ["hdfs://nn/a/x.pdf"]


def test_odd_years_are_null(spark):
    from citewell.sources.records import year_number

    values = ["2024", " 2024 ", "2024.0", "nan", "99999999999", "2024.9", "1e3", "", None, "0", "２０２４"]
    assert evaluate(spark, year_number, values) == [2024, 2024, 2024, *[None] * 8]
    assert evaluate(spark, venues.path_year, ["a/20２４/x.pdf"]) == [None]
    assert evaluate(spark, venues.facet_year, ["x year:20２４"]) == [None]


def test_crossref_year_stops_at_the_first_filled_field(spark):
    date = "struct<`date-parts`: array<array<string>>>"
    schema = f"item struct<`published-print`: {date}, `published-online`: {date}, issued: {date}, created: {date}>"
    rows = [
        (((([["2024", "1"]],)), None, ([["2020"]],), None),),
        ((([],), ([["soon"]],), ([["2020"]],), None),),
        (((None,), ([[]],), ([["2019"]],), None),),
        ((None, None, None, None),),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(crossref_year(F.col("item"))).collect()]
    assert got == [2024, None, 2019, None]
