"""One registered query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.llm import (
    bpe, byte_bpe, fingerprint, hard_negatives, jaccard_join, language, line_dedup, merkle, mixing, pii, quality, toxicity, url_filter,
)
from citewell.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def vocabulary_path() -> str:
    """The word vocabulary's file where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ranks_path_and_pattern() -> tuple[str, str]:
    """The byte vocabulary's file and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: Of op2: verdict, host and path.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


@query
def op2_url_filter(spark, sf_dir):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, model, URL_RULES).drop("url")


def _fold(of: int):
    """crc32 of the decimal doc_id, modulo ``of``."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)), F.lit(-1))


@query
def op1_fingerprint(spark, sf_dir):
    return fingerprint.compared_with_next(table(spark, sf_dir, "documents"))


@query
def op3_line_dedup(spark, sf_dir):
    return line_dedup.removals(table(spark, sf_dir, "documents"))


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(_fold(4) != 2))
    return language.predict(docs, model).withColumn("held_out", _fold(4) == 2)


@query
def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.link_groups(table(spark, sf_dir, "documents"))


@query
def op6_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark, sf_dir):
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("packed_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_fold(5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.with_copies(docs).select("doc_id", "size", "source_size", "target", taken)


SQL["op9_mixing"] = mixing.SQL


@query
def op10_pii(spark, sf_dir):
    found = pii.spans_of(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count_of(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count_of(kind) for kind in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL["op11_hard_negatives"] = hard_negatives.SQL


@query
def op12_merkle(spark, sf_dir):
    return merkle.checked_manifest(table(spark, sf_dir, "documents"), _fold(7) == 0)


SQL["op12_merkle"] = merkle.SQL


@query
def op13_byte_bpe(spark, sf_dir):
    coded = byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"), *ranks_path_and_pattern())
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", "n_tokens", F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
