import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(app="martforge-tests", cores=4, shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martforge-test-ckpt-"))
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
