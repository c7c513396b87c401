"""Registered queries exercise the whole job of their operator."""

import duckdb

from newsloom.operators import rollups
from newsloom.plans import registry

SF = "/root/testdata/sf0.001"


def test_known_upsert_into_existing_keys(spark, monkeypatch):
    calls, upsert = [], rollups.upsert_known
    monkeypatch.setattr(rollups, "upsert_known", lambda state, new: calls.append((state, new)) or upsert(state, new))
    got = registry.QUERIES["known_upsert"](spark, SF).collect()
    state, new = calls[-1]
    assert state.join(new, "normalized_name", "left_semi").count() > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    want = con.execute(f"SELECT normalized_name, status, added_at_utc, seq FROM ({registry.SQL['known_upsert']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
