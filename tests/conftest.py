import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from secflow.session import build_session
    # A folder of this run: stream checkpoints of earlier runs must not be found.
    s = build_session("local[4]", shuffle_partitions=8, app_name="secflow-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="secflow-tests-")})
    yield s
    from secflow.session import release_materialized
    release_materialized(s)
    s.stop()
