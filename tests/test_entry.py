"""The driver contract holds with and without the removable text operators."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:{depth}] == {parts}:
            raise ModuleNotFoundError("No module named " + name, name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
own = entry.warehouse()
assert sorted(entry.queries()) == sorted(own), "more than the library's own queries"
assert entry.oracle_sql() == {{key: query.sql for key, query in own.items() if query.sql}}
"""


@pytest.mark.parametrize("absent", ["playmart.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_entry_without_text_operators(absent):
    parts = absent.split(".")
    code = WITHOUT.format(depth=len(parts), parts=parts)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_every_own_query_has_sql():
    own = entry.warehouse()
    assert all(query.sql for query in own.values())
    assert own.keys() <= entry.queries().keys() and own.keys() <= entry.oracle_sql().keys()
