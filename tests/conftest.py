import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citewell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__driver__memory="6g", spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def papers_of(spark):
    """Catalog rows from short dicts; ids count from one."""
    from pyspark.sql import functions as F

    from citewell.functions.text import normalize_title
    from citewell.schemas import PAPERS

    def build(*rows):
        defaults = {"authors": [], "electronic_edition": [], "keywords": []}
        filled = [{"id": i + 1, **defaults, **row} for i, row in enumerate(rows)]
        data = [tuple(r.get(f.name) for f in PAPERS) for r in filled]
        return spark.createDataFrame(data, PAPERS).withColumn("title_normalized", normalize_title(F.col("title")))

    return build


@pytest.fixture()
def batch_of(spark):
    """Import rows from short dicts, in arrival order."""
    from citewell.schemas import PAPER_IN

    def build(*rows):
        data = [tuple({"_seq": i, **row}.get(f.name) for f in PAPER_IN) for i, row in enumerate(rows)]
        return spark.createDataFrame(data, PAPER_IN)

    return build
