"""Driver contract: entry() runs, every query runs, oracle SQL parity at sf0.001."""

import datetime as dt
import decimal
import math

import pytest
from plant_support import SF

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "urgency_tier" in df.columns


def test_every_query_has_oracle_or_is_text_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in set(q) - set(o) if k != "pipeline" and not k.startswith("op")}
    assert own == set()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["oee_daily", "machine_health", "maintenance_queue", "similar_failures",
                                  "cooldown_events", "derive_downtime", "recommendations", "dq_report",
                                  "production_summary", "coverage_gaps"])
def test_oracle_parity_small(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == digest(ocols, cur.fetchall())
