"""The entry module stands without the text operators, their pipeline or any of their libraries."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT
from workload.queries import REGISTRY

HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError("hidden", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), entry.entry is not None)
"""


@pytest.mark.parametrize("name", ["ahocorasick", "sentencepiece", "xxhash", "public_tokenizers", "pyarrow", "tickloom.llm", "corpus_pipeline"])
def test_market_queries_without(name):
    run = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, sql, _ = run.stdout.split()
    assert int(queries) >= len(REGISTRY) <= int(sql)
