"""Every named query with a SQL statement equals it, on the smallest data folder."""

import pytest

from check_oracle import compare, duck
from stayline.contract import ALL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql is not None])
def test_equals_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_names():
    assert not any("pipeline" in n or n.startswith("op") and n[2:3].isdigit() for n in ALL)
