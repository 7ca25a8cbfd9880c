"""Session for the tests of this folder: small batches, so that operators meet their edges."""

from pathlib import Path

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def tokenizer_folder():
    return Path("/opt/tokenizers")
