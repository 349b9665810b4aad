from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck
from wattspindle.llm.oracle import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(llm, sf_dir, name):
    assert differences(llm, duck(sf_dir), sf_dir, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
