import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import ensure_checkpoint_dir, local_session
    s = local_session(app="riskframe-tests")
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a checkpoint folder when the environment names none
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="rf-ckpt-"))
    yield s


@pytest.fixture()
def jobs(spark):
    """Count Spark jobs run inside a block: ``with jobs() as n: ...; n()``."""
    import contextlib
    import uuid

    @contextlib.contextmanager
    def _count():
        sc = spark.sparkContext
        group = f"g-{uuid.uuid4().hex}"
        sc.setJobGroup(group, "count", interruptOnCancel=False)
        box = {}
        try:
            yield lambda: box.get("n")
        finally:
            box["n"] = len(sc.statusTracker().getJobIdsForGroup(group))
            sc.setLocalProperty("spark.jobGroup.id", None)
    return _count
