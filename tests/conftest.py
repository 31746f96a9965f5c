import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture
def hourly(spark):
    """Build a single-key series from values, one per hour (a value or (hour, value))."""
    import datetime

    def build(values, key="a", kind="double"):
        start = datetime.datetime(2022, 1, 1)
        pairs = [v if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
        rows = [(key, start + datetime.timedelta(hours=h), v) for h, v in pairs]
        return spark.createDataFrame(rows, f"entity string, hourutc timestamp_ntz, x {kind}")
    return build
