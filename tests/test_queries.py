"""Every registered query against its SQL, on the smallest tables."""

import re
from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from tidemark.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_no_forced_plans_in_the_library():
    """No nested loops, cross joins or machine-local lineage cuts are asked for."""
    for path in Path(entry.__file__).parent.glob("tidemark/**/*.py"):
        assert not re.search(r"crossJoin|localCheckpoint|\.rdd\b", path.read_text()), path
