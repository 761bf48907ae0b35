import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import fixtures


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Tables with every awkward case."""
    return fixtures.folder(spark, tmp_path_factory.mktemp("tables") / "odd")


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return fixtures.folder(spark, tmp_path_factory.mktemp("tables") / "empty", [], [], [], [])
