import pytest
from odd_rows import ODD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node string, `key` string, score int, kind string, document int"

@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents with columns that clash with what operators add."""

    def build(*rows):
        full = [(*row, *([None] * (4 - len(row))), 1, 2, "n", "k", 3, "z", 4) for row in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(*ODD).cache()


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of()
