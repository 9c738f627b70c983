"""The entry point without the optional part, or without a library that only it needs."""

import subprocess
import sys

import pytest

BLOCK = """
import importlib.abc, sys
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = set(e.queries())
assert "q_mean_amount" in names and set(e.oracle_sql()) <= names, names
assert not any(n.startswith("op") for n in names) and "pipeline" not in names
"""


@pytest.mark.parametrize("name", ["rowmill.llm", "ahocorasick", "public_tokenizers"])
def test_rest_works_without(name):
    subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], check=True, timeout=60)
