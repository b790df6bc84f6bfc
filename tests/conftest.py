import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from loomgraph.session import local_session

    return local_session(cores=4, memory="4g", partitions=4)
