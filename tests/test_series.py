"""Series of events against their SQL where some have no valid date."""

import duckdb
import pytest

from landseries.plans.registry import ORACLES, QUERIES


def test_masked_series_counts(spark, tmp_path):
    """A pixel whose purchases are all masked is counted, with null values; one without clicks isn't."""
    con = duckdb.connect()
    rows = [(4, 1, "purchase", 2), (1, 1, "click", 3), (2, 2, "purchase", 5), (3, 2, "click", 1), (5, 2, "click", 4), (6, 3, "purchase", 1)]
    days = [2, 1, 1, 1, 9, 3]
    values = ", ".join(f"({e}, TIMESTAMP '2024-01-0{d} 10:00:00', {u}, '{b}', {v}.5::DOUBLE)" for (e, u, b, v), d in zip(rows, days, strict=True))
    con.execute(f"CREATE TABLE events AS SELECT * FROM (VALUES {values}) t(event_id, ts, user_id, event_type, value)")
    con.execute("CREATE TABLE customer AS SELECT unnest([1, 2, 3]) AS c_custkey, 'BUILDING' AS c_mktsegment")
    for t in ("events", "customer"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    (got,) = QUERIES["flagship_seasonal_by_segment"](spark, str(tmp_path)).collect()
    cursor = con.execute(ORACLES["flagship_seasonal_by_segment"])
    expected = dict(zip((c[0] for c in cursor.description), cursor.fetchone(), strict=True))
    assert got.pixels == 2 and got.asDict() == pytest.approx(expected)
