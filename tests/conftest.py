import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from curatio.session import checkpoint_dir, get_spark, ship_package

    s = get_spark("local[4]", app="curatio-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # only set because tests have no cluster-provided spark.checkpoint.dir
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="curatio-ckpt-"))
    ship_package(s)
    yield s
    s.stop()
