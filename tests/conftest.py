import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    # managed tables (e.g. history) go to a fresh scratch warehouse, not the repo
    s = build_session("local[*]", app="tidemark-tests", shuffle_partitions=8,
                      **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-wh-")})
    yield s
    s.stop()


def explain_text(df) -> str:
    """The formatted plan, as ``df.explain("formatted")`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
