"""Property tests against brute force: ids, cosine top-k with ties."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantmetrics.operators.ids import assign_ids
from plantmetrics.operators.retrieval import similar_failures

FAST = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FAST
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 10**6)), min_size=1, max_size=200, unique_by=lambda x: x[1]),
       st.integers(1, 9))
def test_assign_ids_matches_sorted_enumeration(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b long").repartition(parts)
    got = {(r.a, r.b): r.id for r in assign_ids(df, ["a", "b"], "id", start=5).collect()}
    exp = {k: i + 5 for i, k in enumerate(sorted(rows))}
    assert got == exp


@FAST
@given(st.integers(1, 6), st.integers(1, 40), st.integers(1, 4), st.integers(0, 10_000))
def test_topk_with_heavy_ties_matches_brute_force(spark, nq, n_distinct, k, seed):
    import datetime as dt
    rng = np.random.default_rng(seed)
    base = rng.integers(-2, 3, size=(n_distinct, 4)).astype(float)     # small integers: exact ties
    pats = [(i + 1, [float(x) for x in base[i % n_distinct]], "T", dt.date(2024, 1, 1), "R", None)
            for i in range(3 * n_distinct)]
    p = spark.createDataFrame(pats, "pattern_id long, embedding array<double>, machine_type string, "
                                    "event_date date, reason_code string, downtime_hrs decimal(8,3)").repartition(3)
    qv = rng.integers(-2, 3, size=(nq, 4)).astype(float)
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(qv)], "machine_id int, embedding array<double>")
    got = sorted((r.machine_id, r.rank, r.pattern_id) for r in similar_failures(q, p, k=k).collect())
    exp = []
    for i, v in enumerate(qv):
        sc = []
        for pid, e, *_ in pats:
            e = np.asarray(e)
            nv, ne = np.linalg.norm(v), np.linalg.norm(e)
            s = float(v @ e / (nv * ne)) if nv > 0 and ne > 0 else 0.0
            sc.append((-round(s, 9), pid))
        for r, (_, pid) in enumerate(sorted(sc)[:k], start=1):
            exp.append((i, r, pid))
    assert got == sorted(exp)
