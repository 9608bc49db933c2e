"""The driver's entry with and without the optional part."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT

from culvert.plans.queries import QUERIES

BLOCK = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(*e.queries())
assert e.oracle_sql().keys() <= e.queries().keys()
"""


@pytest.mark.parametrize("name", ["culvert.llm.tokens", "culvert.llm", "corpus_pipeline", "xxhash"])
def test_the_other_queries_work_without_the_optional_part(name):
    done = subprocess.run(
        [sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True,
        env={**os.environ, "PYTHONPATH": ROOT}, timeout=120, check=True,
    )
    assert set(done.stdout.split()) == QUERIES.keys()
