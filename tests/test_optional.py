"""The library without its optional parts."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import sys
for name in {hidden}:
    sys.modules[name] = None  # as if it were not there
import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names
print(len(names), sum(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names)
"""


def counts(*hidden: str) -> tuple[int, int, bool]:
    out = subprocess.run([sys.executable, "-c", COUNT.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, check=True)
    n, operators, pipeline = out.stdout.split()
    return int(n), int(operators), pipeline == "True"


@pytest.mark.parametrize("hidden", [("opinara.llm",), ("opinara.llm", "corpus_pipeline"), ("public_tokenizers",)])
def test_queries_without_the_corpus_operators(hidden):
    n, operators, pipeline = counts(*hidden)
    assert n > 100 and operators == 0 and not pipeline


def test_operators_without_the_pipeline():
    assert not counts("corpus_pipeline")[2]
