import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from turnstile import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.session(
        "local[8]",
        spark_sql_shuffle_partitions="4",
        spark_driver_memory="4g",
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """Small frames from text: ``frame("a int, b string", (1, "x"), ...)``."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
