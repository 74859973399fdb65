"""Cosine top-k: exactness against the expression form, ties, zero vectors, chunking."""

import numpy as np
from plant_support import SF
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantmetrics.functions.vectors import cosine_expr
from plantmetrics.operators import retrieval

PAY = "machine_type string, event_date date, reason_code string, downtime_hrs decimal(8,3)"


def patterns(spark, vecs):
    import datetime as dt
    return spark.createDataFrame([(i + 1, [float(x) for x in v], "T", dt.date(2024, 1, 1), "R", None)
                                  for i, v in enumerate(vecs)],
                                 f"pattern_id long, embedding array<double>, {PAY}")


def queries(spark, vecs):
    return spark.createDataFrame([(i + 1, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                 "machine_id int, embedding array<double>")


def brute(spark, q, p, k):
    j = q.alias("q").crossJoin(p.alias("p")).select(
        F.col("q.machine_id"), F.col("p.pattern_id"),
        cosine_expr(F.col("q.embedding"), F.col("p.embedding")).alias("s"))
    w = Window.partitionBy("machine_id").orderBy(F.desc(F.round("s", 9)), "pattern_id")
    return sorted((r.machine_id, r.rank, r.pattern_id) for r in
                  j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).collect())


def top(df):
    return sorted((r.machine_id, r.rank, r.pattern_id) for r in df.collect())


def test_topk_matches_bruteforce_with_repeated_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 8))
    p = patterns(spark, [base[i % 20] for i in range(90)]).repartition(5)
    q = queries(spark, rng.normal(size=(7, 8)))
    got = retrieval.similar_failures(q, p, k=3)
    assert top(got) == brute(spark, q, p, 3)


def test_zero_vectors_score_zero(spark):
    p = patterns(spark, [[0, 0, 0], [1, 0, 0]])
    q = queries(spark, [[0, 0, 0], [1, 1, 0]])
    got = {(r.machine_id, r.pattern_id): r.similarity for r in retrieval.similar_failures(q, p, k=2).collect()}
    assert got[(1, 1)] == 0.0 and got[(1, 2)] == 0.0
    assert abs(got[(2, 2)] - 1 / np.sqrt(2)) < 1e-12 and got[(2, 1)] == 0.0


def test_many_chunks_equal_one(spark):
    rng = np.random.default_rng(5)
    p = patterns(spark, rng.normal(size=(60, 6))).repartition(3)
    q = queries(spark, rng.normal(size=(9, 6)))
    one = top(retrieval.similar_failures(q, p, k=3))
    many = top(retrieval.similar_failures(q, p, k=3, query_bytes=100))
    assert one == many


def test_no_queries_gives_empty(spark):
    p = patterns(spark, [[1, 0]])
    q = queries(spark, [[1, 0]]).where("false")
    assert retrieval.similar_failures(q, p).count() == 0


def test_driver_tables_similarity_in_range(spark):
    from query_registry import model
    s = model(spark, SF).similar_failures
    r = s.agg(F.min("similarity"), F.max("similarity"), F.max("rank")).first()
    assert -1.0 <= r[0] <= r[1] <= 1.0 + 1e-12 and r[2] <= 3


def test_best_keeps_the_k_nearest_with_ties_and_zero_vectors():
    import numpy as np
    import pyarrow as pa

    from plantmetrics.operators.vector_index import Best
    r = np.random.default_rng(4)
    base = r.standard_normal((700, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x = np.vstack([base, base, base + 1e-8, np.zeros((3, 16))])
    q = np.vstack([base[:40], r.standard_normal((60, 16)), np.zeros((2, 16))])
    q[40:100] /= np.linalg.norm(q[40:100], axis=1, keepdims=True)
    pids = r.permutation(len(x))
    best = Best(q, 3)
    for s in range(0, len(x), 500):
        refs = best.extend(pa.table({"pattern_id": pids[s:s + 500]}))
        best.offer(x[s:s + 500], pids[s:s + 500], refs, np.arange(len(q)))
        best.trim()
    keys = np.rint(np.einsum("qd,pd->qp", q, x) * 1e9).astype(np.int64)
    for i in range(len(q)):
        order = np.lexsort((pids, -keys[i]))[:3]
        assert best.ids[i].tolist() == pids[order].tolist() and best.keys[i].tolist() == keys[i][order].tolist()
    got = best.table(np.arange(len(q)))
    assert got.column("pattern_id").to_numpy().reshape(-1, 3).tolist() == best.ids.tolist()


def test_matches_are_scored_once_for_all_that_reads_them(spark):
    """What is made from the matches reads them stored; the plan of an upsert scores nothing either."""
    from plant_support import SF

    import __spark_entry__ as entry
    for name in ("similar_failures", "recommendations", "upsert_recommendations"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan, name
