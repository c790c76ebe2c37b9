"""Small tables for the text operators."""

import pytest

from tidemark.llm.registry import table  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
