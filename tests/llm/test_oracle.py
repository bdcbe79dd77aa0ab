"""The operators that SQL can express against their DuckDB SQL."""

import pytest

from oracle_harness import compare, duck
from starloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duck(SF)
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    r = compare(spark, QUERIES[name], ORACLE[name], SF, con)
    assert r["cols_equal"] and r["values_equal"], r
