import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mailshape.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def mails(spark):
    """Make a mail frame with a text column from (mail_id, text, label) rows."""
    def make(rows, partitions=3):
        return spark.createDataFrame(
            rows, "mail_id bigint, text string, label int").repartition(partitions)
    return make
