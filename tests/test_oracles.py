"""Every catalogue query with an oracle equals its DuckDB SQL at sf0.01
(streaming replays are checked in test_streaming at a smaller scale)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare

from conftest import SF_CHECK

ORACLES = E.oracle_sql()
QUERIES = E.queries()
BATCH = [n for n in QUERIES if n in ORACLES and not n.startswith("stream_")
         and n != "late_rows_dropped"]


def test_every_query_has_a_callable():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, duck_check, name):
    problems, _, _ = compare(spark, duck_check, name, QUERIES[name], ORACLES[name], SF_CHECK)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["token", "n"] and 0 < len(rows) <= 10
