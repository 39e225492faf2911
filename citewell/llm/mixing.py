"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies.  The running sum of
expected copies is walked once from one random offset; a document is taken once for each
whole number its step crosses.  Documents are walked by size class, so that the words taken
come near the target as well as the number of documents.

The running sum needs no ordered pass over a source.  Documents are counted by stratum
(source, size class, ``SPREAD`` parts by doc_id); a running sum over the few strata of a
source says where each stratum begins, and places within a stratum are numbered in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from citewell.llm.common import WORD, whole
from citewell.session import staged

#: A document is taken at most so many times.
MOST = 3
#: Parts of a size class; a source that holds all rows is still numbered in that many tasks and more.
SPREAD = 64
#: Copies are counted in steps of 1 / 2**24.
_BITS = 24

_SOURCE, _SIZE, _CLASS, _PART = "__mix_source", "__mix_size", "__mix_class", "__mix_part"


def _strata_of(docs: DataFrame, column: str, source: str, key: str) -> DataFrame:
    bits = F.expr(f"length(bin({_SIZE}))")
    return (
        docs.withColumn(_SOURCE, F.col(source))
        .withColumn(_SIZE, F.regexp_count(whole(column), F.lit(WORD)).cast("long"))
        .withColumn(_CLASS, bits * 16 + F.expr(f"shiftright({_SIZE} * 8, length(bin({_SIZE})) - 1)"))
        .withColumn(_PART, F.coalesce(F.pmod(F.col(key), F.lit(SPREAD)), F.lit(0)))
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source: (source, size) becomes (source, number, size, weight, target).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ...  They share the whole size by
    weight; none gets more than three times its own, and what is over goes to the others by weight.
    One row per source meets in one task.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    # Sources reach their limit in the order of size by weight; before each: limits and weights of the earlier ones.
    earlier = Window.orderBy(F.expr("size * (6 div weight)"), "number").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        sizes.withColumn("number", F.row_number().over(ordered))
        .withColumn("weight", (F.col("number") - 1) % 3 + 1)
        .withColumn("total", F.sum("size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum(MOST * F.col("size")).over(earlier), F.lit(0)))
        .withColumn("rest_weights", F.col("weights") - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("full", F.expr(f"rest * weight > {MOST} * size * rest_weights"))
    )
    # Those not full share what the full ones leave.
    shared = left.withColumn("share", F.min_by(
        F.when(~F.col("full"), F.struct("rest", "rest_weights")),
        F.when(~F.col("full"), F.struct(F.expr("size * (6 div weight)"), "number")),
    ).over(everything))
    return shared.select(
        "source", "number", "size", "weight",
        F.when(F.col("full"), (MOST * F.col("size")).cast("double"))
        .otherwise(F.expr("(weight * share.rest) / share.rest_weights")).alias("target"),
    )


def with_copies(
    docs: DataFrame, column: str = "text", source: str = "source", key: str = "doc_id", seed: str = "mix"
) -> DataFrame:
    """``docs`` with size, source_size, target (double) and copies: how often the mix takes a row.

    Size is the number of words; null text has none.  A null source is a source of its own, the
    last.  A source without words has target 0 and no copies.  Rows without a key and repeated
    rows count as rows of their own.  An empty table gives an empty one.  Columns of ``docs``
    named like the four new ones are replaced.
    """
    docs = docs.drop(*({"size", "source_size", "target", "copies"} - {column, source, key}))
    placed = _strata_of(docs, column, source, key)
    strata = staged(
        placed.groupBy(_SOURCE, _CLASS, _PART).agg(F.count("*").alias("rows"), F.sum(_SIZE).alias("words")), "mix-strata"
    )
    sources = targets(strata.groupBy(F.col(_SOURCE).alias("source")).agg(F.sum("words").alias("size")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, _BITS // 4), 16, 10)
    sources = sources.select(
        F.col("source").alias("__s"), F.col("size").alias("source_size"), "target", offset.cast("long").alias("__offset"),
        F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size") * 2**_BITS)).otherwise(0).cast("long").alias("__step"),
    )
    before = Window.partitionBy(_SOURCE).orderBy(_CLASS, _PART).rowsBetween(Window.unboundedPreceding, -1)
    begins = strata.withColumn("__before", F.coalesce(F.sum("rows").over(before), F.lit(0))).join(
        sources, F.col(_SOURCE).eqNullSafe(F.col("__s"))
    ).select(
        F.col(_SOURCE).alias("__s"), F.col(_CLASS).alias("__c"), F.col(_PART).alias("__p"),
        "source_size", "target", "__before", "__offset", "__step",
    )
    within = Window.partitionBy(_SOURCE, _CLASS, _PART).orderBy(key, _SIZE)
    numbered = placed.withColumn("__place", F.row_number().over(within)).join(
        begins,
        F.col(_SOURCE).eqNullSafe(F.col("__s")) & (F.col(_CLASS) == F.col("__c")) & (F.col(_PART) == F.col("__p")),
    )
    passed = "shiftright((__before + __place{}) * __step + __offset, {})"
    copies = F.expr(passed.format("", _BITS)) - F.expr(passed.format(" - 1", _BITS))
    return numbered.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(_SIZE).alias("size"), "source_size", "target", copies.alias("copies")
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    taken = with_copies(docs, **settings).where(F.col("copies") > 0)
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


#: DuckDB SQL of doc_id, size, source_size, target, taken over ``documents``.
SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), placed AS (
  SELECT *, length(bin(size)) * 16 + ((size * 8) >> (length(bin(size)) - 1)) AS class,
         coalesce(((doc_id % 64) + 64) % 64, 0) AS part
  FROM sized
), sizes AS (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source),
numbered AS (
  SELECT *, (number - 1) % 3 + 1 AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM sizes)
), left_over AS (
  SELECT *, sum(size) OVER () - coalesce(sum(3 * size) OVER earlier, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS rest_weights
  FROM numbered
  WINDOW earlier AS (ORDER BY size * (6 // weight), number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (SELECT *, rest * weight > 3 * size * rest_weights AS is_full FROM left_over),
share AS (SELECT rest, rest_weights FROM judged WHERE NOT is_full ORDER BY size * (6 // weight), number LIMIT 1),
targets AS (
  SELECT j.source, j.size, CASE WHEN is_full THEN (3 * j.size)::DOUBLE
         ELSE (weight * share.rest)::DOUBLE / share.rest_weights::DOUBLE END AS target,
         ('0x' || substr(md5('mix:' || coalesce(j.source, '')), 1, 6))::BIGINT AS start
  FROM judged j, share
), ranked AS (
  SELECT p.doc_id, p.size, t.size AS source_size, t.target, t.start,
         CASE WHEN t.size > 0 THEN floor(t.target / t.size::DOUBLE * 16777216)::BIGINT ELSE 0 END AS step,
         row_number() OVER (PARTITION BY p.source ORDER BY class, part, doc_id, p.size) AS place
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (((place * step + start) >> 24) - (((place - 1) * step + start) >> 24)) * size AS taken
FROM ranked
"""
