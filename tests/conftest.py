import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from statline.session import get_spark

    scratch = tempfile.mkdtemp(prefix="statline-tests-")
    s = get_spark(master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                         "spark.sql.warehouse.dir": f"{scratch}/wh",
                         "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import oracle
    return oracle.duck(SMALL)
