"""Every registered query of the reference's operators against its SQL on DuckDB."""

import duckdb
import pandas as pd
import pytest

from landseries.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for c in sorted(frame):
        s = frame[c]
        if len(s) and type(s.iloc[0]).__name__ in ("date", "Timestamp"):
            out[c] = pd.to_datetime(s).dt.strftime("%Y-%m-%d")
        else:
            n = pd.to_numeric(s, errors="coerce") if s.dtype != bool else s.astype(float)
            out[c] = n.astype(float).round(6) if n.notna().sum() == s.notna().sum() else s.astype(str)
    return pd.DataFrame(out).sort_values(sorted(out), ignore_index=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLES:
        pd.testing.assert_frame_equal(plain(got), plain(duck.execute(ORACLES[name]).df()), check_dtype=False, atol=1e-6)
    else:
        assert len(got)
