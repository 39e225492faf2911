import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citewell.llm import byte_bpe, hard_negatives, merkle
from citewell.llm.queries import _fold, ranks_path_and_pattern


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    import tiktoken

    path, pattern = ranks_path_and_pattern()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(spark, docs_of, odd, library):
    rng = random.Random(3)
    letters = "aàß漢1²Ⅷ٣ \t\n\r\x0b\x1c\x85\xa0​　'sStrve!.-🙂é́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += ["<|endoftext|>", " " * 900, "ab" * 3000, "'re 'RE \n\n  x", "don't", "x" * 7000 + "y"]
    docs = odd.select("doc_id", "text", "kind").unionByName(docs_of(*[(100 + i, t) for i, t in enumerate(texts)]).select("doc_id", "text", "kind"))
    coded = byte_bpe.encode_and_decode(docs, *ranks_path_and_pattern())
    assert coded.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    want = sorted((r.doc_id is None, r.doc_id or 0, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids, bytes(r.decoded)) for r in coded.collect())
    assert got == want
    assert all(r.n_tokens == len(r.ids) for r in coded.collect())


def test_byte_bpe_of_an_empty_table(none):
    assert byte_bpe.encode_and_decode(none, *ranks_path_and_pattern()).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 8, 13])
def test_segment_tree_gives_the_least(n):
    rng = random.Random(n)
    values = [rng.randrange(50) for _ in range(n)]
    tree = byte_bpe.tree_of(list(values))
    for _ in range(200):
        place, value = rng.randrange(n), rng.randrange(50)
        values[place] = value
        byte_bpe.put(tree, place, value)
        assert tree[1] == min(values)


def test_byte_bpe_long_texts_and_full_memory(library):
    path, pattern = ranks_path_and_pattern()
    ranks = byte_bpe.Ranks(path, pattern, remember=50)
    text = " ".join(f"word{i % 977}é" for i in range(160_000))
    assert len(text) > byte_bpe._LONG_TEXT
    assert ranks.encode(text).tolist() == library.encode_ordinary(text)
    assert len(ranks) <= 50


@pytest.mark.parametrize("n", [16, 17, 256, 257, 5000])
def test_segment_tree_of_several_levels(n):
    rng = random.Random(n)
    values = [rng.randrange(1 << 40) for _ in range(n)]
    tree = byte_bpe.tree_of(list(values))
    for _ in range(300):
        place, value = rng.choice([rng.randrange(n), values.index(min(values))]), rng.randrange(1 << 40)
        values[place] = value
        byte_bpe.put(tree, place, value)
        assert tree[1] == min(values) and len(tree) < 2 * n + 40


def test_byte_bpe_merges_no_match_again_that_is_met_again_and_again():
    ranks, merged = byte_bpe.Ranks(*ranks_path_and_pattern(), remember=50), []
    ranks.merged = lambda match, whole=ranks.merged: merged.append(match) or whole(match)
    for i in range(500):
        assert bytes(ranks.decode(ranks.encode(f"common{i}x"))) == f"common{i}x".encode()
    assert merged.count(b"common") == 1 and len(ranks) <= 50


# Merkle manifest


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(digests):
    """Root, and the siblings of each leaf from the leaf to the root with their sides."""
    paths, at, where = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(at) > 1:
        for leaf, node in enumerate(where):
            other = node ^ 1
            paths[leaf].append((node & 1, at[other] if other < len(at) else None))
        at = [_sha(*at[i : i + 2]) for i in range(0, len(at), 2)]
        where = [node // 2 for node in where]
    return at[0], paths


def _manifest(rows):
    leaf = lambda r, more=0: _sha(*map(_field, (r.doc_id, r.source, r.lang, r.n_chars + more if r.n_chars is not None else None, r.text)))
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[g] = _tree([leaf(r) for r in groups[g]])
    root, upper = _tree([trees[g][0] for g in order])
    made = []
    for place, g in enumerate(order):
        for r, path in zip(groups[g], trees[g][1]):
            path = path + upper[place]
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            at = leaf(r, int(tampered))
            for odd_side, other in path:
                at = _sha(at) if other is None else _sha(other, at) if odd_side else _sha(at, other)
            made.append((r.doc_id, leaf(r), trees[g][0], root, _sha(*[o for _, o in path if o]), at, at == root))
    return made


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def _checked(docs):
    return [tuple(r) for r in merkle.checked_manifest(docs, _fold(7) == 0).collect()]


def test_manifest_of_odd_rows(odd):
    assert sorted(_checked(odd), key=_key) == sorted(_manifest(odd.collect()), key=_key)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (1, 1, 1), (5, 8, 3), (70, 1, 33)])
def test_manifest_of_small_trees(spark, docs_of, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(100 * g + i, f"text {i}", None if g == 1 else f"l{g}", "s") for g, n in enumerate(sizes) for i in range(n)]
    docs = docs_of(*rows).withColumn("n_chars", F.when(F.col("doc_id") % 5 != 0, F.length("text").cast("bigint")))
    got = _checked(docs)
    assert sorted(got, key=_key) == sorted(_manifest(docs.collect()), key=_key)
    assert any(not r[-1] for r in got) or sum(sizes) < 10


def test_manifest_of_an_empty_table(none):
    assert _checked(none) == []


# Hard negatives


def _mined(rows, anchor):
    def whole(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    kept = [(i, g, [int(np.floor(256 * float(x))) for x in v]) for i, g, v in rows if i is not None and g is not None and whole(v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    made = []
    for i, g, v in kept:
        if not anchor(i):
            continue
        scored = sorted((-score(v, w), j, h) for j, h, w in kept if j != i)
        for s, j, h in [r for r in scored if r[2] == g][: hard_negatives.POSITIVES]:
            inside = [r for r in scored if r[2] != g and 30 * -s <= 100 * -r[0] <= 90 * -s][: hard_negatives.NEGATIVES]
            made += [(i, j, place + 1, n, -s, -t) for place, (t, n, _) in enumerate(inside)]
    return sorted(made)


def _vectors(spark, rows):
    full = [(i, v, g, 1, 2, "x", 3) for i, g, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, `row` int, block int, run string, score int")


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "TILE", 3)
    monkeypatch.setattr(hard_negatives, "ZONES", 7)
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.normal(0, 0.4, (9, 6))
    rows = []
    for i in range(900):
        # One label holds a third; components are coarse, so scores tie.
        c = i % 9
        vector = np.round(centres[c] + rng.normal(0, spread, 6), 1).astype(np.float32)
        rows.append((i, 0 if i % 3 == 0 else c, [float(x) for x in vector]))
    rows += [(900 + i, 1, rows[7][2]) for i in range(60)]
    got = hard_negatives.mined(_vectors(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == _mined(rows, lambda i: i % 20 == 0)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.4]), (2, 2, [0.5, 0.25]), (3, 2, [0.5, 0.25]), (3, 2, [0.5, 0.25]), (4, None, [1.0, 1.0]),
        (5, 1, None), (6, 1, [nan, 0.0]), (7, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (None, 2, [0.5, 0.25]), (9, 2, []), (10, 2, [0.6]),
        (20, 2, [0.5, 0.25, 7.0]), (40, 1, [-1.0, -1.0]), (60, 3, [0.0, 0.0]), (0, 2, [0.8, 0.1]), (80, 1, [3e4, -3e30]),
    ]
    got = hard_negatives.mined(_vectors(spark, rows), F.col("vec_id") % 20 == 0)
    rows = [(i, g, v if i != 80 else [3e4, -float(1 << 53) / 256]) for i, g, v in rows]
    assert sorted(map(tuple, got.collect())) == _mined(rows, lambda i: i % 20 == 0)
    assert hard_negatives.mined(_vectors(spark, rows), F.lit(False)).collect() == []
    assert hard_negatives.mined(_vectors(spark, rows[:0]), F.lit(True)).collect() == []


def test_bounds_hold_every_product():
    rng = np.random.default_rng(2)
    rows, points = rng.integers(-300, 300, (40, 5)), rng.integers(-300, 300, (30, 5))
    low, high = hard_negatives.bounds(points, rows.min(0)[None], rows.max(0)[None])
    exact = hard_negatives.products(points, rows)
    assert (low <= exact).all() and (exact <= high).all()
    huge = hard_negatives.products(np.array([[1 << 53, 3]]), np.array([[1 << 53, 5], [7, 2]]))
    assert huge.tolist() == [[1 << 61, 7 * (1 << 53) + 6]]


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(x, y) for x in range(16) for y in range(16)])
    place = {tuple(c): k for c, k in zip(cells.tolist(), hard_negatives.hilbert(cells))}
    walk = sorted(place, key=place.get)
    assert len(set(place.values())) == 256
    assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(walk, walk[1:]))
