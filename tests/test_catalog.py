"""Every query of the catalog gives the rows of its oracle."""

import math

import duckdb
import pytest

from plumbline.operators.catalog import ORACLES, QUERIES, TABLES

AT = "/root/testdata/sf0.001"


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 4)) if isinstance(v, float) else float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{AT}/{t}.parquet'")
    df = QUERIES[name](spark, AT)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    r = db.execute(ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(x[names.index(c)]) for c in columns) for x in r.fetchall()), key=str)
