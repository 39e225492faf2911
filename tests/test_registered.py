"""Registered queries against their SQL twins on the smallest tables."""

import os
import re
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import TABLES, rows

SF_DIR = "/root/testdata/sf0.001"
SOME = (
    "normalized_titles", "token_df", "vocab_4000", "top_keywords", "trends_selected", "search_wildcard", "batch_search",
    "merge_upsert", "fill_venues", "dedup_first", "venue_backfill", "local_first", "title_lookup", "strip_markup", "dblp_pages",
    "crossref_pages", "batches_of_50",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, engine, name):
    df = queries()[name](spark, SF_DIR)
    result = engine.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 80


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_no_local_checkpoint_and_no_cross_join_in_the_package():
    for path in Path(__file__).parent.parent.joinpath("citewell").rglob("*.py"):
        assert not re.search(r"localCheckpoint|crossJoin|\.toPandas\(", path.read_text()), path
