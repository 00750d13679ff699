"""The registered llm queries: all there, and equal to their SQL where they have one."""

from __future__ import annotations

import duckdb
import pytest

from tidemark.llm.queries import ORACLES, QUERIES
from tools.oracle_check import TABLES, digest

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    from __spark_entry__ import oracle_sql, queries

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(columns, want.fetchall())[0]
