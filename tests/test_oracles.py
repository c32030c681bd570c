"""Every registered query against its SQL on the smallest tables."""

import os
import re

import pytest

from compare import check, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"
# Numbered operators have tests of their own.
NAMES = [n for n in sorted(oracle_sql()) if not re.match(r"op\d+_", n)]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, name):
    result = check(spark, connect(SF_DIR), name, queries()[name], oracle_sql()[name], SF_DIR)
    if result == "no rows":
        # On the smallest tables a strict filter may leave nothing.
        result = check(spark, connect(LARGER), name, queries()[name], oracle_sql()[name], LARGER)
    assert result == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names_match():
    assert set(oracle_sql()) <= set(queries())
