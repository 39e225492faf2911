"""Merkle manifest of a dataset, with a proof for every leaf by pointer jumping.

Leaves of one group ascend by key and form a binary tree; a node without a
neighbour is hashed alone.  The groups' roots, in the order of the groups, form one more
tree, whose root stands for the dataset.

Every node knows its sibling and points to its parent.  In each round nodes are joined with
the nodes that they point to, take over their pointer and append their siblings, so the
distance doubles: 1, 2, 4, ... until every leaf points to the root.  Only nodes on levels
that a later round can still land on are carried on.

A segment holds 33 bytes for a level: 0 (none), 1 (left) or 2 (right), and the sibling's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from citewell.llm.common import map_rows
from citewell.operators.rowindex import with_row_index
from citewell.session import staged

#: Levels that one task raises a run of nodes by; the run has 2 ** LEVELS nodes at most.
LEVELS = 10
#: Tree number of the tree over the groups' roots.
_TOP = -1
_STEP = 33
# Rows of a batch handed back to Spark.
_ROWS = 4096


def _hashed(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """Digest of a row: of each field ``-`` if null, else its length in bytes, a colon and its value."""
    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(one, fields)), 256)


def sides(digests: list[str], first: int) -> list[tuple[int, bytes]]:
    """Number and segment of each of a run of nodes whose first, an even one, has the number ``first``."""
    made = []
    for at in range(len(digests)):
        other = at ^ 1
        side = 0 if other >= len(digests) else 1 if at & 1 else 2
        made.append((first + at, bytes([side]) + (bytes.fromhex(digests[other]) if side else bytes(_STEP - 1))))
    return made


def parents(digests: list[str]) -> list[str]:
    return [_hashed(*digests[at : at + 2]) for at in range(0, len(digests), 2)]


def follow(digest: str, proof: bytes) -> str:
    """The root that a leaf and its proof lead to."""
    for at in range(0, len(proof), _STEP):
        side, other = proof[at], proof[at + 1 : at + _STEP].hex()
        digest = _hashed(digest) if not side else _hashed(other, digest) if side == 1 else _hashed(digest, other)
    return digest


def siblings(proof: bytes) -> list[str]:
    """The sibling digests of a proof, from the leaf to the root."""
    return [proof[at + 1 : at + _STEP].hex() for at in range(0, len(proof), _STEP) if proof[at]]


_NODES = "tree bigint, level int, node bigint, height int, digest string, segment binary"


def _raised(nodes: DataFrame) -> DataFrame:
    """All nodes of the trees under their roots with ``segment``, and the roots with ``digest``.

    ``nodes`` are leaves: tree, level, node, height, digest.  Runs of 2 ** LEVELS nodes are
    raised at a time, and what is left of the runs is raised in the next pass.
    """
    out = to_arrow_schema(StructType.fromDDL(_NODES))

    def raise_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for batch in batches:
            for tree, level, height, run in zip(*batch.columns):
                tree, level, height, first = tree.as_py(), level.as_py(), height.as_py(), run[0]["node"].as_py()
                digests = run.values.field("digest").to_pylist()
                for at in range(level, min(level + LEVELS, height)):
                    made += [(tree, at, node, height, None, segment) for node, segment in sides(digests, first)]
                    first, digests = first >> 1, parents(digests)
                made.append((tree, min(level + LEVELS, height), first, height, digests[0], None))
                if len(made) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*made), out)], schema=out)
                    made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*made), out)], schema=out)

    done = []
    while True:
        run = F.expr(f"shiftright(node, {LEVELS})")
        grouped = nodes.groupBy("tree", "level", "height", run.alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("nodes")
        )
        made = staged(grouped.select("tree", "level", "height", "nodes").mapInArrow(raise_runs, _NODES), "merkle-nodes")
        done.append(made.where("segment is not null or level = height"))
        nodes = made.where("segment is null and level < height").drop("segment")
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _height(leaves: str) -> Column:
    """Levels from the leaves of a tree to its root."""
    return F.expr(f"cast(if({leaves} < 2, 0, length(bin({leaves} - 1))) as int)")


def proofs(leaves: DataFrame, key: str, group: str, digest: str = "leaf") -> DataFrame:
    """The columns of ``leaves``, and subroot, root and proof (segments from the leaf to the root) of each.

    Within a group leaves ascend by key (null first), equal keys by digest.  The group null comes first.
    An empty table gives an empty one.
    """
    order = [F.col(group).asc_nulls_first(), F.col(key).asc_nulls_first(), F.col(digest)]
    numbered = with_row_index(leaves, order, "__row", start=0)
    trees = numbered.groupBy(F.col(group).alias("__group")).agg(F.min("__row").alias("tree"), F.count("*").alias("leaves"))
    trees = staged(trees.withColumn("height", _height("leaves")), "merkle-trees")
    placed = numbered.join(trees, F.col(group).eqNullSafe(F.col("__group"))).withColumn("node", F.col("__row") - F.col("tree"))
    placed = placed.withColumnsRenamed({"tree": "__tree", "node": "__node"})

    nodes = _raised(placed.select(
        F.col("__tree").alias("tree"), F.lit(0).alias("level"), F.col("__node").alias("node"), "height", F.col(digest).alias("digest")
    ))
    roots = nodes.where("segment is null").select("tree", "height", "digest")
    ranked = staged(with_row_index(roots, ["tree"], "rank", start=0), "merkle-subroots")
    height = ranked.agg(_height("count(*)")).first()[0]
    upper = _raised(ranked.select(
        F.lit(_TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("rank").alias("node"), F.lit(height).alias("height"), "digest"
    ))
    root = next((r.digest for r in upper.where("segment is null").select("digest").collect()), None)  # one row

    # Above its own root each tree goes on as the path from there.
    path = ranked.select("tree", "height", "rank", F.explode(F.sequence(F.lit(0), F.lit(height))).alias("up")).where(F.col("up") < height)
    steps = upper.where("segment is not null").select(F.col("level").alias("up"), F.col("node").alias("__at"), "segment")
    path = path.join(steps, "up").where(F.expr("shiftright(rank, up)") == F.col("__at"))
    own = nodes.where("segment is not null").select("tree", "level", "node", "segment")
    jumped = own.unionByName(path.select("tree", (F.col("height") + F.col("up")).alias("level"), F.lit(0).cast("bigint").alias("node"), "segment"))

    deepest = height + (trees.agg(F.max("height")).first()[0] or 0)
    distance = 1
    while distance < deepest:
        after = jumped.where(F.col("level") % (2 * distance) == distance).select(
            "tree", (F.col("level") - distance).alias("level"), F.col("node").alias("parent"), F.col("segment").alias("further")
        )
        before = jumped.where(F.col("level") % (2 * distance) == 0).withColumn("parent", F.expr(f"shiftright(node, {min(distance, 63)})"))
        joined = before.join(after, ["tree", "level", "parent"], "left")
        segment = F.concat("segment", F.coalesce("further", F.lit(b"")))
        jumped = staged(joined.select("tree", "level", "node", segment.alias("segment")), "merkle-jumped")
        distance *= 2

    found = jumped.where("level = 0").select(F.col("tree").alias("__tree"), F.col("node").alias("__node"), "segment")
    subroots = ranked.select(F.col("tree").alias("__tree"), F.col("digest").alias("__subroot"))
    return placed.join(subroots, "__tree").join(found, ["__tree", "__node"], "left").select(
        *[F.col(f"`{c}`") for c in leaves.columns], F.col("__subroot").alias("subroot"), F.lit(root).alias("root"),
        F.coalesce("segment", F.lit(b"")).alias("proof"),
    )


def verified(proven: DataFrame, claim: str, columns: Sequence[str]) -> DataFrame:
    """columns, proof_sha256, folded_root and verified: whether the digest ``claim`` and the proof lead to the root."""
    types = dict(proven.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", proof_sha256 string, folded_root string, verified boolean"

    def start():
        def one(root, digest, proof, *kept):
            folded = follow(digest, proof)
            return *kept, _hashed(*siblings(proof)), folded, folded == root

        return one

    return map_rows(proven.select(F.col("root").alias("__root"), claim, "proof", *columns), schema, start)


def checked_manifest(docs: DataFrame, altered: Column, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of every row of documents.

    Where ``altered`` holds, the leaf that is checked has one more in n_chars than the manifest's; a null n_chars
    stays.  Nulls are fields of their own; repeated rows are leaves of their own with equal
    digests.  Other columns are left out.
    """
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    fields = [F.col(c) for c in (key, "source", group, "n_chars", "text")]
    tampered = F.when(altered & F.col("n_chars").isNotNull(), leaf(*fields[:3], more, fields[4]))
    leaves = docs.select(F.col(key), F.col(group), leaf(*fields).alias("leaf"), tampered.alias("tampered"))
    proven = proofs(leaves, key, group).withColumn("__claim", F.coalesce("tampered", "leaf"))
    return verified(proven, "__claim", (key, "leaf", "subroot", "root"))


#: The manifest in DuckDB's SQL; crc32 bit by bit.
SQL = """
WITH RECURSIVE
d AS (
  SELECT doc_id, lang, source, n_chars, text, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)
    ) AS crc FROM documents
),
f AS (
  SELECT doc_id, lang, crc, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM d
),
l AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN n_chars IS NOT NULL AND xor(crc, 4294967295::UBIGINT) % 7 = 0
      THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS tampered FROM f
),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS size FROM l
),
nodes AS (
  SELECT g, 0 AS level, n, leaf AS h, size FROM o
  UNION ALL
  SELECT g, any_value(level) + 1, n // 2, sha256(string_agg(h, '' ORDER BY n)), (any_value(size) + 1) // 2
  FROM nodes WHERE size > 1 GROUP BY g, n // 2
),
top AS (
  SELECT 0 AS level, g AS n, h, (SELECT count(DISTINCT g) FROM o) AS size FROM nodes WHERE size = 1
  UNION ALL
  SELECT any_value(level) + 1, n // 2, sha256(string_agg(h, '' ORDER BY n)), (any_value(size) + 1) // 2
  FROM top WHERE size > 1 GROUP BY n // 2
),
up AS (SELECT g, max(level) AS height FROM nodes GROUP BY g),
steps AS (
  SELECT a.g, a.n, a.level, a.n >> a.level AS place, s.h AS sibling
  FROM (SELECT o.g, o.n, unnest(range(height)) AS level FROM o JOIN up ON up.g = o.g) a
  LEFT JOIN nodes s ON s.g = a.g AND s.level = a.level AND s.n = xor(a.n >> a.level, 1)
  UNION ALL
  SELECT a.g, a.n, a.height + a.level, a.g >> a.level, s.h
  FROM (SELECT o.g, o.n, height, unnest(range((SELECT max(level) FROM top))) AS level FROM o JOIN up ON up.g = o.g) a
  LEFT JOIN top s ON s.level = a.level AND s.n = xor(a.g >> a.level, 1)
),
fold AS (
  SELECT g, n, 0 AS level, coalesce(tampered, leaf) AS h, '' AS proof FROM o
  UNION ALL
  SELECT fold.g, fold.n, fold.level + 1,
    sha256(CASE WHEN place % 2 = 1 THEN coalesce(sibling, '') || h ELSE h || coalesce(sibling, '') END), proof || coalesce(sibling, '')
  FROM fold JOIN steps ON steps.g = fold.g AND steps.n = fold.n AND steps.level = fold.level
),
root AS (SELECT h AS root FROM top WHERE size = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
FROM o JOIN up ON up.g = o.g JOIN root ON true
JOIN nodes s ON s.g = o.g AND s.size = 1
JOIN fold ON fold.g = o.g AND fold.n = o.n AND fold.level = height + (SELECT max(level) FROM top)
"""
