"""The registry with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), 'pipeline' in q)"


@pytest.mark.parametrize("gone", [["auctide/llm", "tests/llm"], ["auctide/llm", "tests/llm", "corpus_pipeline.py"]])
def test_registry_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns(".git", "__pycache__", "*.json", *[os.path.basename(g) for g in gone])
    shutil.copytree(ROOT, copy, ignore=skip)
    from auctide.plans.queries import QUERIES
    got = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, check=True).stdout
    n, with_sql, pipeline = got.split()[-3:]
    assert int(n) == len(QUERIES) and 0 < int(with_sql) <= int(n) and pipeline == "False"
