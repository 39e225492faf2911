"""Maps the document tables onto the paper schema.

The mapping is synthetic: venues and years are spread by formula and carry no meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.functions.text import normalize_title
from citewell.schemas import PAPERS

FETCHED_AT = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers_from_documents(documents: DataFrame) -> DataFrame:
    doc = F.col("doc_id")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    source_no = F.substring("source", 4, 10).cast("int")
    columns = {
        "id": doc,
        "title": title,
        "title_normalized": normalize_title(title),
        "authors": F.array().cast("array<string>"),
        "venue": F.when(source_no % 4 == 0, "CVPR").when(source_no % 4 == 1, "ICCV").when(source_no % 4 == 2, "ECCV"),
        "year": F.when(doc % 17 != 0, (2022 + F.expr("doc_id div 20") % 4).cast("int")),
        "doi": F.lit(None),
        "dblp_url": F.lit(None),
        "electronic_edition": F.array().cast("array<string>"),
        "dblp_key": F.concat(F.lit("doc:"), doc.cast("string")),
        "paper_type": F.when(F.expr("doc_id div 3") % 10 == 0, "user-import").otherwise("Conference"),
        "abstract": F.when(F.expr("doc_id div 7") % 5 != 0, F.col("text")),
        "keywords": F.array("lang", "source"),
        "source_query": F.col("source"),
        "fetched_at": F.lit(FETCHED_AT),
    }
    return documents.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in PAPERS])


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers_from_documents(table(spark, sf_dir, "documents"))
