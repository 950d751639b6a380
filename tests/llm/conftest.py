from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import documents  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
