import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import STATE_STORE, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    """Panel rows of one series from a list of y, one day apart; None skips the day."""
    import datetime

    from tidewatch.schema import PANEL

    def make(ys, store="S001", product="P001", start=datetime.date(2024, 1, 1)):
        rows = [
            (store, product, start + datetime.timedelta(days=i), float(y))
            for i, y in enumerate(ys)
            if y is not None
        ]
        return spark.createDataFrame(rows, PANEL)

    return make
