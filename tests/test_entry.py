"""The entry module without its optional part, or without a package that this needs."""

import os
import subprocess
import sys

import pytest

from tradeflow.plans.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tradeflow.llm", "public_tokenizers", "regex"])
def test_missing_modules_leave_the_trade_queries(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(QUERIES))] * 2, run.stderr
