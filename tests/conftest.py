import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lienflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Runs SQL expressions over a column ``v`` of texts and returns the values."""

    def run(values, *expressions):
        numbered = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        found = numbered.selectExpr("i", *[f"{e} AS c{n}" for n, e in enumerate(expressions)]).orderBy("i").collect()
        return [row[1] if len(expressions) == 1 else tuple(row)[1:] for row in found]

    return run
