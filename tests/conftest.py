import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rillflow.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                    spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                    spark__driver__memory="4g",
                    spark__sql__warehouse__dir=os.path.join("/tmp", f"rillflow-wh-{os.getpid()}"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def make_events(spark):
    """Events from (seconds after T0, user[, type[, value[, session]]]) tuples; ids are positions."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            sec, user, kind, value, session = (*r, *(None,) * (5 - len(r)))
            full.append((i, user, session or f"s{user}", kind or "view", value,
                         T0 + timedelta(microseconds=round(sec * 1e6)),
                         f"/p{i % 3}", None, '{"k": 1}'))
        return spark.createDataFrame(full, (
            "id long, user_id string, session_id string, event_type string, value double, "
            "timestamp timestamp_ntz, page_url string, user_agent string, event_data string"))

    return make


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
