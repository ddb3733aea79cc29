import datetime
import math

import duckdb
import pytest

from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.001"


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.mark.parametrize("name", sorted(Q.oracles()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    done = db.execute(Q.oracles()[name])
    columns = [c[0] for c in done.description]
    want = sorted(repr([canon(dict(zip(columns, r))[c]) for c in sorted(columns)]) for r in done.fetchall())
    df = Q.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr([canon(r[c]) for c in sorted(columns)]) for r in df.collect()) == want
