import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def folder():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no tables")
    return path
