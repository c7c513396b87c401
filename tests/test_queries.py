"""Registered queries of sinks, streams and compositions give the rows of their SQL at sf0.001."""

import glob
import os

import duckdb
import pytest

from newsloom.plans import composed, registry, runs, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


QUERIES = composed.QUERIES | runs.QUERIES | stages.QUERIES | {k: registry.QUERIES[k] for k in ("confirmed_domains", "verdict_fold", "person_rollup", "similar_names")}
SQL = registry.SQL | composed.SQL | runs.SQL | stages.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    out = QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    want = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, out.select(columns).collect()))) == sorted(map(repr, want))


def test_every_verdict_occurs(spark):
    """The gated verdicts reach all six outcomes."""
    found = {r["gate4b_status"] for r in runs.QUERIES["verdicts_gated"](spark, "/root/testdata/sf0.01").select("gate4b_status").distinct().collect()}
    assert found >= {"SKIPPED_HAS_PAGE", "SKIPPED", "LIKELY_NOTABLE", "POSSIBLY_NOTABLE", "UNCERTAIN", "NOT_NOTABLE"}
