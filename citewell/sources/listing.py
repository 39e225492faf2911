"""Papers from a listing of PDF files; file contents are never read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.functions.keys import file_uri, hashed_key
from citewell.functions.venues import file_title, path_venue, path_year
from citewell.sources.records import paper_rows

# Folder names that hold paper collections.
COLLECTIONS = ("CV 2024 综述", "CV 2025 综述", "ICCV2025")

# Fixed value: part of the name of a download that has not finished.
PARTIAL_MARK = ".baiduyun."


def from_paths(paths: DataFrame) -> DataFrame:
    """Import rows from a table with an absolute ``path`` per file, in path order."""
    name = F.substring_index("path", "/", -1)
    title = file_title(name)
    listed = paths.where(
        F.endswith(name, F.lit(".pdf")) & ~F.contains(F.lower(name), F.lit(PARTIAL_MARK)) & (title != "")
    )
    ordered = listed.select("path").orderBy("path").withColumn("_seq", F.monotonically_increasing_id())
    path = F.col("path")
    return paper_rows(
        ordered,
        {
            "title": title,
            "venue": path_venue(path),
            "year": path_year(path),
            "electronic_edition": F.array(file_uri(path)),
            "dblp_key": hashed_key("local-pdf", path),
            "paper_type": F.lit("local-pdf"),
            "_seq": F.col("_seq"),
        },
    )


def list_pdfs(spark: SparkSession, root: str, collections: Sequence[str] = COLLECTIONS) -> DataFrame:
    """Paths of the PDF files in the named collections under ``root``.

    Only the path column of the binary reader is selected, so no file is opened.
    """
    root = root.rstrip("/")
    if root.rsplit("/", 1)[-1] in collections:
        roots = [root]
    else:
        escaped = ",".join(c.replace(",", "\\,") for c in collections)
        roots = [f"{root}/{{{escaped}}}"]
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.pdf")
        .load(roots)
    )
    return listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
