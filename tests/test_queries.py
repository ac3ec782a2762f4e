"""Each registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from siftspark.plans.catalogue import COVERS, ORACLES, QUERIES, by_part

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def ordered(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object:
            df[c] = df[c].map(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLES:
        pd.testing.assert_frame_equal(ordered(got), ordered(duck.sql(ORACLES[name]).df()), check_dtype=False, rtol=1e-9)
    else:
        assert len(got)


def test_every_query_says_what_it_covers():
    assert all(COVERS[name] for name in QUERIES)
    assert {"S1", "K1", "P1", "J1", "A1", "W1", "O1", "U1", "F1", "C1", "M1", "T1", "G1", "E1"} <= set(by_part())
