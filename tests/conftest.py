import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, memory="8g", partitions=4, work=str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


def rows(df, *order):
    """Collected tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
