"""Table schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DataType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType,
)

_TEXT, _TEXTS, _INT, _LONG, _REAL, _TIME = (
    StringType(), ArrayType(StringType()), IntegerType(), LongType(), DoubleType(), TimestampType(),
)
_TERM_WEIGHTS = ArrayType(StructType().add("term", _TEXT).add("weight", _REAL))


def _table(**columns: DataType) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


PAPER_IN = _table(
    title=_TEXT, authors=_TEXTS, venue=_TEXT, year=_INT, doi=_TEXT, dblp_url=_TEXT, electronic_edition=_TEXTS,
    dblp_key=_TEXT, paper_type=_TEXT, abstract=_TEXT, keywords=_TEXTS, _seq=_LONG,
)
PAPERS = _table(
    id=_LONG, title=_TEXT, title_normalized=_TEXT, authors=_TEXTS, venue=_TEXT, year=_INT, doi=_TEXT,
    dblp_url=_TEXT, electronic_edition=_TEXTS, dblp_key=_TEXT, paper_type=_TEXT, abstract=_TEXT, keywords=_TEXTS,
    source_query=_TEXT, fetched_at=_TIME,
)
TOPIC_CLUSTERS = _table(cluster_id=_INT, label=_TEXT, paper_count=_LONG, score=_REAL, terms=_TEXTS, run_at=_TIME)
PAPER_ANALYSIS = _table(paper_id=_LONG, cluster_id=_INT, vector=_TERM_WEIGHTS, analyzed_at=_TIME)
KEYWORD_STATS = _table(keyword=_TEXT, paper_count=_LONG, weight=_REAL, rank=_INT, run_at=_TIME)
KEYWORD_PAPERS = _table(keyword=_TEXT, paper_id=_LONG)
TREND_STATS = _table(keyword=_TEXT, venue=_TEXT, year=_INT, paper_count=_LONG)
ANALYSIS_META = _table(run_at=_TIME, paper_count=_LONG, cluster_count=_INT, vectorizer=_TEXT, clusterer=_TEXT)
