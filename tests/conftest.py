import sys
from datetime import timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from support import HOME, START  # noqa: E402
from tidewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TXN_COLUMNS = (
    "transaction_id string, user_id string, amount double, event_time timestamp, "
    "latitude double, longitude double"
)


@pytest.fixture
def txns(spark):
    """Build transactions from (id, user, seconds after START[, place[, amount]])."""

    def build(rows):
        full = []
        for row in rows:
            tid, user, second, *rest = row
            place = rest[0] if rest else HOME
            amount = rest[1] if len(rest) > 1 else 10.0
            time = None if second is None else START + timedelta(seconds=second)
            full.append((tid, user, amount, time, *place))
        return spark.createDataFrame(full, TXN_COLUMNS)

    return build
