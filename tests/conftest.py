import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import get_spark
    s = get_spark(master="local[*]", app="tillroll-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh folder under the session's checkpoint directory."""
    import uuid
    from tillroll.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex[:8]}"
