import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillon.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["small", "bucketed", "split again"])
def any_size(request, monkeypatch):
    """Run a test on the path of small tables, on the one of large tables, and on the one of very large tables."""
    if request.param != "small":
        from quillon.operators import ranks

        monkeypatch.setattr(ranks, "SMALL_ROWS", -1)
        monkeypatch.setattr(ranks, "CUT_SAMPLE", 0.5)
        if request.param == "split again":
            monkeypatch.setattr(ranks, "SPLIT_ROWS", 20)
    return request.param


@pytest.fixture
def animals(spark):
    rows = [(0, "dog", 1.0, "Lance"), (1, "cat", 3.0, "Barry"), (2, "pig", 9.0, None), (3, "dog", 4.0, "Barry"),
            (4, "mouse", None, "Tom")]
    return spark.createDataFrame(rows, "id bigint, species string, age double, name string")


@pytest.fixture
def column_of():
    def values(df, name, key="id"):
        return [r[name] for r in df.orderBy(key).collect()]

    return values
