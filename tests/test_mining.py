"""Vocabulary, weights, keywords, trends and topics against plain loops."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from citewell.functions.vocab import STOP_WORDS
from citewell.operators import keywords, terms, topics, trends
from citewell.plans.refresh import refresh



def grams_of(title):
    words = [w for w in title.lower().split() if w not in STOP_WORDS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(titles, size):
    """Vocabulary counts and unit weights of a corpus of plain word titles."""
    docs = [Counter(grams_of(t)) for t in titles]
    total = sum(docs, Counter())
    vocab = sorted(total.items(), key=lambda e: (-e[1], e[0]))[:size]
    names = {t for t, _ in vocab}
    df = Counter(t for d in docs for t in d)
    weights = []
    for doc in docs:
        raw = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in doc.items() if t in names}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights.append({t: w / norm for t, w in raw.items()})
    return vocab, weights


@pytest.fixture(scope="module")
def titles():
    rng = random.Random(7)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 30))) for _ in range(120)]


@pytest.mark.parametrize("size", [5, 40, 143, 150, 100000])
def test_vocabulary_is_exact_with_and_without_pruning(papers_of, titles, size):
    corpus = terms.paper_tokens(papers_of(*[{"title": t} for t in titles]))
    assert terms.vocabulary(corpus, size) == expected(titles, size)[0]


def test_vocabulary_with_many_ties(papers_of):
    titles = [f"tie{chr(97 + i)}{chr(97 + j)} pairx" for i in range(10) for j in range(10)]
    corpus = terms.paper_tokens(papers_of(*[{"title": t} for t in titles]))
    for size in (1, 3, 20, 60):
        assert terms.vocabulary(corpus, size) == expected(titles, size)[0]


def test_weights_and_keywords(papers_of, titles):
    corpus = terms.weigh(papers_of(*[{"title": t} for t in titles]), size=60)
    vocab, weights = expected(titles, 60)
    assert corpus.terms == sorted(t for t, _ in vocab) and corpus.paper_count == len(titles)
    got = {(r.paper_id, corpus.terms[r.idx]): r.weight for r in corpus.long().collect()}
    want = {(i + 1, t): w for i, doc in enumerate(weights) for t, w in doc.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)

    df, total = Counter(t for d in weights for t in d), Counter()
    for doc in weights:
        total.update(doc)
    order = sorted(df, key=lambda t: (-df[t], -round(total[t], 9), t))[:10]
    ranked = keywords.rank_keywords(keywords.term_stats(corpus), F.current_timestamp(), kept=10).orderBy("rank").collect()
    assert [(r["keyword"], r["paper_count"], r["rank"]) for r in ranked] == [(t, df[t], i + 1) for i, t in enumerate(order)]
    links = sorted(map(tuple, keywords.keyword_links(corpus, order[:3]).collect()))
    assert links == sorted((t, i + 1) for i, d in enumerate(weights) for t in d if t in order[:3])

    vector = corpus.vectors.select("paper_id", keywords.paper_vector(corpus, F.col("weights"), kept=4).alias("v"))
    for r in vector.collect():
        doc = {t: round(w, 6) for t, w in weights[r.paper_id - 1].items()}
        assert [(e.term, e.weight) for e in r.v] == sorted(doc.items(), key=lambda e: (-e[1], e[0]))[:4]


def test_hand_computed_weights(papers_of):
    corpus = terms.weigh(papers_of({"title": "graph"}, {"title": "graph graph nets"}, {"title": "nets"}))
    got = {(r.paper_id, corpus.terms[r.idx]): round(r.weight, 6) for r in corpus.long().collect()}
    graph, pair = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    raw = {"graph": 2 * graph, "graph graph": pair, "graph nets": pair, "nets": graph}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert got[(1, "graph")] == 1.0 and got[(3, "nets")] == 1.0
    assert {t: got[(2, t)] for t in raw} == {t: round(v / norm, 6) for t, v in raw.items()}


def test_trends_need_conference_year_and_real_papers(papers_of, spark):
    corpus = terms.weigh(papers_of(
        {"title": "alpha beta", "venue": "cvpr", "year": 2024, "paper_type": "Conference"},
        {"title": "alpha", "venue": "CVPR", "year": 2024},
        {"title": "alpha", "venue": "ECCV", "year": 2023, "paper_type": "user-import"},
        {"title": "alpha", "venue": "CVPR workshop", "year": 2024}, {"title": "alpha", "venue": "ICCV", "year": 0},
        {"title": "alpha", "venue": "ICCV"}, {"title": "alpha", "venue": "ICCV", "year": 2025}))
    stats = trends.trend_stats(corpus)
    rows = [tuple(r) for r in trends.select_trends(stats).collect()]
    assert rows == [("alpha", "CVPR", 2024, 2), ("alpha beta", "CVPR", 2024, 1), ("beta", "CVPR", 2024, 1), ("alpha", "ICCV", 2025, 1)]
    assert trends.select_trends(stats, [" BETA ", ""]).count() == 1
    assert trends.select_trends(stats, []).count() == 4
    wanted = spark.createDataFrame([("Alpha ",), ("zzz",)], "keyword string")
    assert trends.select_trends(stats, wanted).count() == 2
    axes = trends.trend_axes(stats).first()
    assert (axes.years, axes.venues) == ([2024, 2025], ["CVPR", "ICCV"])


def test_cluster_count():
    assert [topics.cluster_count(n) for n in (0, 1, 2, 3, 6, 7, 12, 20, 90, 111, 10**9)] == [1, 1, 2, 2, 2, 3, 3, 4, 9, 10, 10]


def test_topics_hold_every_paper_once(papers_of, titles):
    built = refresh(papers_of(*[{"title": t} for t in titles]), vocabulary_size=80, starts=3)
    clusters = built.topic_clusters.collect()
    assert sum(c.paper_count for c in clusters) == len(titles) and 2 <= len(clusters) <= 10
    assigned = built.paper_analysis.collect()
    assert sorted(r.paper_id for r in assigned) == list(range(1, len(titles) + 1))
    sizes = Counter(r.cluster_id for r in assigned)
    assert sizes == {c.cluster_id: c.paper_count for c in clusters}
    weights = expected(titles, 80)[1]
    for c in clusters:
        mean = Counter()
        for r in assigned:
            if r.cluster_id == c.cluster_id:
                mean.update(weights[r.paper_id - 1])
        assert c.score == pytest.approx(sum(mean.values()) / c.paper_count)
        top = sorted(mean, key=lambda t: (-mean[t], t))[: len(c.terms)]
        assert sorted(round(mean[t], 9) for t in c.terms) == sorted(round(mean[t], 9) for t in top)
    again = refresh(papers_of(*[{"title": t} for t in titles]), vocabulary_size=80, starts=3)
    assert {r.paper_id: r.cluster_id for r in again.paper_analysis.collect()} == {r.paper_id: r.cluster_id for r in assigned}
    meta = built.analysis_meta.first()
    assert (meta.paper_count, meta.cluster_count, meta.vectorizer, meta.clusterer) == (120, 10, "tfidf", "kmeans")


def test_two_separate_subjects_fall_apart(papers_of):
    papers = papers_of(*[{"title": t} for t in ["graph nets", "graph nets deep", "nets graph"] + ["video sound", "sound video clip", "video sound"]])
    assigned = refresh(papers).paper_analysis.collect()
    first, second = ({r.cluster_id for r in assigned if (r.paper_id <= 3) == side} for side in (True, False))
    assert len(first) == len(second) == 1 and first != second


def test_degenerate_corpora(papers_of):
    empty = refresh(papers_of())
    assert [df.count() for df in empty.tables().values()] == [0, 0, 0, 0, 0, 1]
    assert (empty.analysis_meta.first().paper_count, empty.analysis_meta.first().cluster_count) == (0, 0)
    stopped = refresh(papers_of({"title": "the survey"}, {"title": "of"}))
    assert stopped.topic_clusters.count() == 0 and stopped.analysis_meta.first().paper_count == 2
    one = refresh(papers_of({"title": "Vision Transformer"}))
    cluster = one.topic_clusters.first()
    assert (cluster.cluster_id, cluster.paper_count, cluster.label) == (0, 1, "Transformer / Vision / Vision Transformer")
    same = refresh(papers_of(*[{"title": "same words"}] * 5))
    assert same.topic_clusters.agg(F.sum("paper_count")).first()[0] == 5
    assert one.trend_stats.count() == 0 and one.keyword_papers.count() == 3


def test_starts_read_no_persisted_table(spark, monkeypatch):
    """K-means keeps its own vectors only when its input is not persisted; a persisted one is decoded in every iteration."""
    kept, fit = [], topics.KMeans.fit
    monkeypatch.setattr(topics.KMeans, "fit", lambda self, data: (kept.append(data.storageLevel), fit(self, data))[1])
    rows = [(Vectors.sparse(6, {i % 6: 1.0 + i % 2}),) for i in range(24)]
    model = topics.best_start(spark.createDataFrame(rows, ["weights"]), 6, starts=3)
    assert len(kept) == 3 and not any(level.useMemory or level.useDisk for level in kept)
    assert len(model.clusterCenters()) == 6
