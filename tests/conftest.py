import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from taxaweave.session import local_session

    ckpt = tempfile.mkdtemp(prefix="taxaweave-test-ckpt-")
    s = local_session(cores="*", shuffle_partitions=8, app="taxaweave-tests", checkpoint_dir=ckpt)
    yield s
