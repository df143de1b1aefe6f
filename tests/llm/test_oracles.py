"""The operators that SQL can express, against their DuckDB SQL."""

import duckdb
import pytest

from strata.llm.oracles import ORACLES
from strata.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in res.description)
    place = [[d[0] for d in res.description].index(c) for c in columns]
    want = sorted(repr([row[k] for k in place]) for row in res.fetchall())
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == columns
    assert sorted(repr(list(r)) for r in df.select(columns).collect()) == want
