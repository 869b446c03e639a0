import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", 4, **{"spark.checkpoint.dir": str(folder / "shared"), "spark.sql.warehouse.dir": str(folder / "wh")}
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])

    return collect
