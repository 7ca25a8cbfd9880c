"""The queries of the lake do not depend on the training-data operators or their libraries."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["comptoir.llm", "corpus_pipeline", "ahocorasick", "tokenizers"])
def test_entry_without(missing):
    program = (f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {str(ROOT)!r}); import __spark_entry__ as e; "
               "assert 'revenue_by_city' in e.queries()") if missing == 'tokenizers' else (
               f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {str(ROOT)!r}); import __spark_entry__ as e; "
               "assert set(e.queries()) == set(e.oracle_sql()) and 'revenue_by_city' in e.queries() and 'pipeline' not in e.queries()")
    subprocess.run([sys.executable, "-W", "ignore", "-c", program], check=True)
