"""N-gram Jaccard join with several global token orders.

Two documents link when their sets of word shingles have a Jaccard similarity of
a threshold or more, by default 0.9 on shingles of three words.  Under any order of all tokens, linked sets share a token among the
first ``n - ceil(0.9 n) + 1`` of each (0.9 stands for the threshold asked for).  Here three orders are used: tokens known to be
frequent come last, and within that the order is that of three different hashes.  Pairs
are found by the prefix of the first order, must share one in the others too, and are then
verified on the whole sets.

* Equal sets are one node from the start, so exact copies cost no pairs.
* Which tokens are frequent is counted exactly among the lowest hashes of all documents, and
  goes to the tasks as a bitmap of fixed size.  Any set of tokens may come last; it decides
  cost, not results.
* First every node is held against the most central nodes it shares a first token with, and
  what links becomes one component.  After that only tokens shared by different components, and
  only pairs across components, are looked at: a large group of near copies makes no pairs.  Where a
  token is shared by many sets, each is held against some of the others first, in rounds while these halve what is left.
* The parity of token hashes in 512 bits bounds the difference of two sets from below, inside the
  join, so hardly a pair comes out that doesn't link; large sets have 4,096 bits, compared after it.
* A pair comes out once for a run of shared first tokens, not once for each of them.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.llm.common import lower_word_hashes, map_batches, mix, shingles_of
from citewell.llm.components import components
from citewell.session import staged

#: By default shingles of three words; linked when 10 * common >= 9 * all.
SHINGLE, NUMERATOR, DENOMINATOR = 3, 9, 10
#: A counted token of more sets than this comes last.
FREQUENT = 64
#: Tokens counted of each set: the lowest sixth, and eight at least.
_COUNTED, _COUNTED_LEAST = 6, 8
#: First tokens of each order that look for a central node.
_STARS = 4
#: Tokens before a shared one that are looked at, so that a pair comes out once for a run of shared tokens.
_EARLIER = 4
#: Tokens that more sets share are looked up for some of them first, each set against so many others.
_CROWDED, _HEADS = 64, 16
_SALTS = tuple(np.uint64(s) for s in (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F))
_LOW = np.uint64((1 << 64) // _COUNTED)
_BITS = 1 << 26
_SMALL, _LARGE, _LARGE_FROM = 512, 4096, 900


def token_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, A-Z as a-z; of fewer words, one of them all."""
    return np.unique(shingles_of(lower_word_hashes(text or ""), shingle))


def node_of(tokens: np.ndarray) -> int | None:
    """A 64-bit name of a set; None for the empty one."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) if len(tokens) else None


def prefix_length(n: int, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> int:
    return n - -(-numerator * n // denominator) + 1


def parity(tokens: np.ndarray, bits: int) -> list[int]:
    """Which places of a bitmap an odd number of tokens falls on, as 64-bit numbers."""
    odd = (np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8").tolist()


def prefixes(tokens: np.ndarray, last: np.ndarray, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> list[list[int]]:
    """The first tokens of each order; ``last`` (0 to 3 for each token) comes before the hash."""
    p = prefix_length(len(tokens), numerator, denominator)
    out = []
    for salt in _SALTS:
        order = last << np.uint64(62) | (mix(tokens ^ salt) if salt else tokens) >> np.uint64(2)
        first = np.argpartition(order, p - 1)[:p]
        out.append(_signed(tokens[first[np.argsort(order[first])]]))
    return out


def bitmap(positions: DataFrame) -> np.ndarray:
    """A bitmap of ``_BITS`` places from a column ``at``; a million 64-bit rows come to the driver at most."""
    rows = positions.groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")
    ).collect()
    words = np.zeros(_BITS // 64, np.int64)
    words[[r.word for r in rows]] = [r.bits for r in rows]
    return words.view(np.uint64)


def _has(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _place(values: np.ndarray) -> np.ndarray:
    return values & np.uint64(_BITS - 1)


def _signed(tokens: np.ndarray) -> list[int]:
    return tokens.view(np.int64).tolist()


def _key_place(key: str = "key") -> Column:
    return F.expr(f"xxhash64({key}) & {_BITS - 1}").alias("at")


def _sets(docs: DataFrame, wanted, shingle: int) -> DataFrame:
    """key, node, tokens of the documents whose keys are at places of a bitmap; no other text is cut into shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def start():
        known = shared.value

        def made(keys, texts, places):
            rows = []
            for i in np.flatnonzero(_has(known, np.array(places, np.uint64))):
                tokens = token_set(texts[i], shingle)
                if (node := node_of(tokens)) is not None:
                    rows.append((keys[i], node, _signed(tokens)))
            return tuple(zip(*rows)) if rows else ((), (), ())

        return made

    return map_batches(docs.select("key", "text", _key_place()), f"key {dict(docs.dtypes)['key']}, node long, tokens array<long>", start)


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, shingle: int, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their whole sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(firsts, "node")
    wanted = bitmap(ends.select(_key_place()))
    sets = _sets(docs, wanted, shingle).join(ends.select("node", F.col("key").alias("__key")), "node")
    sets = staged(sets.where(F.col("key").eqNullSafe(F.col("__key"))).select("node", "tokens"), "jaccard-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    return both.where(denominator * common >= numerator * (F.size("x") + F.size("y") - common)).select("a", "b").distinct()


def _may_link(x: str, y: str, numerator: int, denominator: int) -> Column:
    """Whether sizes and small parities of two nodes leave room for a link: the difference is at most 1/19 of both sizes for 0.9."""
    gap = " + ".join(f"bit_count({x}.small[{i}] ^ {y}.small[{i}])" for i in range(_SMALL // 64))
    whole, apart = f"{denominator - numerator} * ({x}.n + {y}.n)", denominator + numerator
    return F.expr(f"{apart} * abs({x}.n - {y}.n) <= {whole} and {apart} * ({gap}) <= {whole}")


def _large_may_link(x: str, y: str, numerator: int, denominator: int) -> Column:
    """The same for the large parities, which large sets have."""
    whole, apart = f"{denominator - numerator} * ({x}.n + {y}.n)", denominator + numerator
    gap = f"aggregate(zip_with({x}.large, {y}.large, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"
    return F.expr(f"{x}.large is null or {y}.large is null or {apart} * {gap} <= {whole}")


def _open_rows(nodes: DataFrame, grouped: DataFrame) -> DataFrame:
    """The first tokens of nodes that nodes of another root have, too, with the tokens before and the number of sets; ``grouped`` is node, root."""
    placed = nodes.select("node", "p0").join(grouped, "node", "left").withColumn("root", F.coalesce("root", "node"))
    tokens = placed.select("node", "root", F.posexplode("p0").alias("i", "token"))
    shared = tokens.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count("*").alias("sets"))
    shared = shared.where("r1 != r2").select("token", "sets")
    earlier = F.expr(f"slice(p0, greatest(i - {_EARLIER - 1}, 1), least(i, {_EARLIER}))").alias("earlier")
    rows = tokens.join(shared, "token").join(nodes.select("node", "n", "small", "p0"), "node")
    return rows.select("token", "sets", "node", "root", "n", "small", earlier)


def _still_open(open_rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """``open_rows`` with the roots of ``grouped``, in which components have grown, without tokens that one root has alone now."""
    rows = open_rows.drop("root").join(grouped, "node", "left").withColumn("root", F.coalesce("root", "node")).select(open_rows.columns)
    shared = rows.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("token")
    return rows.join(shared, "token", "left_semi")


def _crowded_offers(open_rows: DataFrame, turn: int, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) that may link of the nodes of a crowded token with ``_HEADS`` of them, others for each token and turn.

    There are no more than ``_HEADS`` times the rows, however large a group is.
    """
    rows = open_rows.where(F.col("sets") > _CROWDED)
    by = Window.partitionBy("token").orderBy(F.xxhash64("node", "token", F.lit(turn)), "node")
    heads = rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= _HEADS)
    x, y = rows.alias("x"), heads.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & _may_link("x", "y", numerator, denominator))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def link_groups(
    docs: DataFrame, key: str = "doc_id", column: str = "text",
    shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR,
) -> DataFrame:
    """key, n_shingles and component_id of every row: the smallest key that links reach, its own included.

    Shingles have ``shingle`` words, and sets of Jaccard similarity ``numerator / denominator`` or more link.
    Null and empty texts have no shingles and link with nothing; equal texts link.  Repeated rows
    stay and link by their texts; a null key is never the smallest while another is there.  An
    empty table gives an empty one; other columns are left out.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(column).alias("text"))
    kind = dict(docs.dtypes)["key"]

    def start():
        def made(keys, texts):
            sets = [token_set(t, shingle) for t in texts]
            low = [_signed(s[: max(len(s) // _COUNTED, _COUNTED_LEAST)]) for s in sets]
            return keys, [len(s) for s in sets], [node_of(s) for s in sets], low

        return made

    rows = staged(map_batches(docs, f"key {kind}, n long, node long, low array<long>", start), "jaccard-rows")
    firsts = staged(
        rows.where("node is not null").groupBy("node").agg(F.min("key").alias("key"), F.count("*").alias("copies")), "jaccard-nodes"
    )
    frequent = rows.select(F.explode("low").alias("token")).groupBy("token").count().where(F.col("count") > FREQUENT)
    frequent = staged(frequent.select(F.expr(f"token & {_BITS - 1}").alias("at")), "jaccard-frequent")
    last = docs.sparkSession.sparkContext.broadcast(bitmap(frequent))

    def start_prefixes():
        late = last.value

        def made(keys, texts):
            out = []
            for key, text in zip(keys, texts):
                tokens = token_set(text, shingle)
                if n := len(tokens):
                    # Tokens of low hash were counted in most sets: they come first unless they are frequent.
                    rank = np.where(_has(late, _place(tokens)), np.uint64(2), (tokens >= _LOW).astype(np.uint64))
                    large = parity(tokens, _LARGE) if n >= _LARGE_FROM else None
                    out.append((key, node_of(tokens), n, parity(tokens, _SMALL), large, *prefixes(tokens, rank, numerator, denominator)))
            return tuple(zip(*out)) if out else ((),) * 8

        return made

    schema = f"key {kind}, node long, n long, small array<long>, large array<long>, p0 array<long>, p1 array<long>, p2 array<long>"
    made = map_batches(docs, schema, start_prefixes)
    nodes = staged(
        made.join(firsts.select("node", F.col("key").alias("__key")), "node")
        .where(F.col("key").eqNullSafe(F.col("__key"))).drop("key", "__key").dropDuplicates(["node"]), "jaccard-prefixes"
    )
    about = nodes.select("node", F.struct("n", "small", "large").alias("it"))

    # The most central node of each bucket first.
    heads = F.expr("concat(" + ", ".join(
        f"transform(slice(p{i}, 1, {_STARS}), t -> named_struct('order', {i}, 'token', t))" for i in range(len(_SALTS))
    ) + ")")
    entries = nodes.select("node", F.explode(heads).alias("at")).select("node", "at.order", "at.token")
    sizes = entries.groupBy("order", "token").count().where("count > 1")
    crowded = staged(entries.join(sizes, ["order", "token"]), "jaccard-entries")
    # Of a group of near copies, the one with fewest edits shares its first tokens with most others.
    central = crowded.groupBy("node").agg(F.sum("count").alias("weight"))
    chosen = crowded.join(central, "node").groupBy("order", "token").agg(F.max(F.struct("weight", "node")).alias("head"))
    offers = (
        crowded.join(chosen, ["order", "token"]).where("node != head.node")
        .select(F.col("node").alias("a"), F.col("head.node").alias("b"), F.col("head.weight").alias("weight")).distinct()
    )
    offers = offers.join(about.select(F.col("node").alias("a"), F.col("it").alias("x")), "a").join(
        about.select(F.col("node").alias("b"), F.col("it").alias("y")), "b"
    ).where(_may_link("x", "y", numerator, denominator) & _large_may_link("x", "y", numerator, denominator))
    offers = staged(offers.select("a", "b"), "jaccard-offers")  # 12 of a node at most
    stars = staged(_verified(offers, docs, firsts, shingle, numerator, denominator), "jaccard-stars")
    grouped = staged(components(stars), "jaccard-groups")

    # What is left: pairs across components, by shared tokens of the first order.
    open_rows, turn = staged(_open_rows(nodes, grouped), "jaccard-open"), 0
    left = open_rows.where(F.col("sets") > _CROWDED).count()
    while left:
        # Members of a large group that do not link with its centre: each is held against other members first, not against all.
        offers = staged(_crowded_offers(open_rows, turn, numerator, denominator), "jaccard-crowded")
        stars = stars.unionByName(staged(_verified(offers, docs, firsts, shingle, numerator, denominator), "jaccard-joined"))
        grouped, turn = staged(components(stars), "jaccard-groups"), turn + 1
        open_rows = staged(_still_open(open_rows, grouped), "jaccard-open")
        before, left = left, open_rows.where(F.col("sets") > _CROWDED).count()
        if 2 * left > before:
            break
    # Two nodes that share one of the tokens right before this one met there.
    x, y = open_rows.alias("x"), open_rows.alias("y")
    across = x.join(
        y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.node") < F.col("y.node"))
        & ~F.arrays_overlap("x.earlier", "y.earlier") & _may_link("x", "y", numerator, denominator)
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    others = nodes.select("node", F.struct("n", "large", "p1", "p2").alias("o"))
    across = across.join(others.select(F.col("node").alias("a"), F.col("o").alias("oa")), "a").join(
        others.select(F.col("node").alias("b"), F.col("o").alias("ob")), "b"
    ).where("arrays_overlap(oa.p1, ob.p1) and arrays_overlap(oa.p2, ob.p2)").where(
        _large_may_link("oa", "ob", numerator, denominator)
    ).select("a", "b")
    across = staged(across, "jaccard-across")
    links = stars.unionByName(_verified(across, docs, firsts, shingle, numerator, denominator))
    final = components(links)

    smallest = firsts.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = smallest.groupBy("root").agg(F.min("key").alias("component_id"))
    answer = smallest.join(by_root, "root").select(F.col("node").alias("__node"), "component_id")
    return rows.join(answer, F.col("node") == F.col("__node"), "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", column: str = "text",
    shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR,
) -> DataFrame:
    """The rows of ``docs`` but for those linked to a row of smaller key; one row for each key.

    Rows without a key are not compared and stay.
    """
    groups = link_groups(docs.where(F.col(key).isNotNull()), key, column, shingle, numerator, denominator)
    kept = groups.where(F.col(key) == F.col("component_id"))
    kept = kept.select(F.col(key).alias("__kept")).distinct()
    once = Window.partitionBy(key).orderBy(F.xxhash64(column))
    stays = docs.join(kept, F.col(key) == F.col("__kept"), "left_semi").withColumn("__turn", F.row_number().over(once))
    return stays.where("__turn = 1").drop("__turn").unionByName(docs.where(F.col(key).isNull()))
