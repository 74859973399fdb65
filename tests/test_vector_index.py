"""Vector index: the rows of brute force, with ties, zero vectors, chunks; lists skipped; versions."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from plant_support import SF
from pyspark.sql import functions as F

from plantmetrics.operators import retrieval, vector_index
from plantmetrics.plans import versions

PAY = "machine_type string, event_date date, reason_code string, downtime_hrs decimal(8,3)"


def patterns(spark, vecs):
    return spark.createDataFrame([(i + 1, None if v is None else [float(x) for x in v], "T", dt.date(2024, 1, 1), "R", None)
                                  for i, v in enumerate(vecs)], f"pattern_id long, embedding array<double>, {PAY}")


def queries(spark, vecs):
    return spark.createDataFrame([(i + 1, [float(x) for x in v]) for i, v in enumerate(vecs)], "machine_id int, embedding array<double>")


def brute(qs, ps, k):
    out = set()
    for m, q in enumerate(qs, 1):
        scored = []
        for i, p in enumerate(ps, 1):
            if p is not None:
                norm = np.linalg.norm(q) * np.linalg.norm(p)
                scored.append((-round(float(np.dot(q, p)) / norm * 1e9) if norm else 0, i))
        out |= {(m, r, i) for r, (_, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def clustered(seed, n, dims=12, groups=9):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dims))
    vecs = [centres[i % groups] * r.uniform(0.1, 4) + r.normal(size=dims) * 0.02 for i in range(n)]
    vecs[10] = np.zeros(dims)
    vecs[11], vecs[12], vecs[13] = vecs[30], vecs[30] * 2, None
    return centres, vecs


def built(spark, vecs, lists=9):
    path = tempfile.mkdtemp(prefix="pm-index-")
    vector_index.build(patterns(spark, vecs).repartition(3), path, lists, list_rows=20)
    return path


def told(found):
    return {(r.machine_id, r.rank, r.pattern_id) for r in found.rows.collect()}


@pytest.mark.parametrize("query_bytes", [1 << 20, 400])
def test_equals_brute_force_and_skips_lists(spark, query_bytes):
    centres, vecs = clustered(1, 700)
    qs = [centres[0], centres[4] * 3, vecs[30], np.zeros(12), -centres[2], centres[1] + centres[5]]
    index = vector_index.Index(spark, built(spark, vecs))
    found = vector_index.search(queries(spark, qs), index, 3, query_bytes)
    assert told(found) == brute(qs, vecs, 3)
    sims = [r.similarity for r in found.rows.where("machine_id = 4").collect()]
    assert sims == [0.0, 0.0, 0.0]
    assert found.pairs == 6 * 699 and found.compared < found.pairs
    near = vector_index.search(queries(spark, qs[:3]), index, 3)
    assert near.skipped > 0.6


def test_random_directions_and_large_k_lose_nothing(spark):
    r = np.random.default_rng(3)
    vecs, qs = list(r.normal(size=(300, 5))), list(r.normal(size=(8, 5)))
    index = vector_index.Index(spark, built(spark, vecs, 6))
    assert told(vector_index.search(queries(spark, qs), index, 40)) == brute(qs, vecs, 40)


def test_equals_the_scan_on_the_driver_tables(spark):
    from query_registry import model
    m = model(spark, SF)
    path = tempfile.mkdtemp(prefix="pm-index-")
    vector_index.build(m.failure_patterns, path)
    got = vector_index.search(m.query_vectors, vector_index.Index(spark, path), m.params.top_k).rows
    want = m.similar_failures
    cols = ["machine_id", "rank", "pattern_id", "reason_code", "downtime_hrs"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_empty_sides(spark):
    index = vector_index.Index(spark, built(spark, [[1.0, 2.0]]))
    assert vector_index.search(queries(spark, [[1, 0]]).where("false"), index).rows.count() == 0
    none = vector_index.Index(spark, built(spark, [None, None]))
    assert vector_index.search(queries(spark, [[1, 0]]), none).rows.count() == 0
    zeros = vector_index.Index(spark, built(spark, [[0.0, 0.0], [0.0, 0.0]]))
    assert told(vector_index.search(queries(spark, [[1, 0]]), zeros, 1)) == {(1, 1, 1)}


def test_last_window_reads_k_times_groups_rows_a_machine(spark):
    rows = spark.range(4000).select((F.col("id") % 2).cast("int").alias("machine_id"), F.col("id").alias("pattern_id"),
                                    F.lit(0.5).alias("sim"), (F.col("id") % 97).alias("sim_key")).repartition(40)
    got = vector_index.merge_levels(rows, 3, groups=4)
    want = {(m, r + 1, p) for m in (0, 1) for r, (_, p) in enumerate(sorted((-(i % 97), i) for i in range(m, 4000, 2))[:3])}
    assert {(r.machine_id, r.rank, r.pattern_id) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number") >= 2 and "_group" in plan


def test_patterns_added_later_are_found_and_written_alone(spark):
    centres, vecs = clustered(7, 300)
    vecs = [v for v in vecs if v is not None]
    both = patterns(spark, vecs)
    path = tempfile.mkdtemp(prefix="pm-index-")
    vector_index.build(both.where("pattern_id <= 200"), path, 9, list_rows=20)
    first = versions.folders(spark, path)
    vector_index.add(both.where("pattern_id > 200"), path)
    assert versions.folders(spark, path)[:1] == first
    assert spark.read.parquet(f"{versions.folders(spark, path)[-1]}/kind=rows").count() == len(vecs) - 200
    qs = [*centres, -centres[0]]
    assert told(vector_index.search(queries(spark, qs), vector_index.Index(spark, path), 5)) == brute(qs, vecs, 5)
    none = built(spark, [[0.0] * 12])
    vector_index.add(both.where("pattern_id between 2 and 100"), none)
    only = [np.zeros(12), *vecs[1:100]]
    assert told(vector_index.search(queries(spark, qs), vector_index.Index(spark, none), 2)) == brute(qs, only, 2)


def test_a_write_that_breaks_off_leaves_the_old_version(spark):
    path = tempfile.mkdtemp(prefix="pm-version-") + "/t"
    with pytest.raises(FileNotFoundError):
        versions.folders(spark, path)
    versions.write_version(spark, path, lambda p: spark.range(5).write.parquet(p))

    def breaks(p):
        spark.range(9).write.parquet(p)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.write_version(spark, path, breaks)
    assert versions.read(spark, path).count() == 5
    held = versions.read(spark, path)
    versions.write_version(spark, path, lambda p: spark.range(7).write.parquet(p))
    assert held.count() == 5                                # a reader goes on with the version it began with
    versions.write_version(spark, path, lambda p: spark.range(3).write.parquet(p), append=True)
    assert versions.read(spark, path).count() == 10
    versions.write_version(spark, path, lambda p: spark.range(2).write.parquet(p))
    assert versions.read(spark, path).count() == 2


def test_days_are_replaced_one_by_one(spark):
    path = tempfile.mkdtemp(prefix="pm-days-") + "/t"
    def rows(*r):
        return spark.createDataFrame([(dt.date(2024, 1, d) if d else None, x) for d, x in r], "day date, x int")
    def held(wanted=None):
        got = versions.read_days(spark, path, rows().schema, "day", wanted)
        return sorted((r.day.day if r.day else 0, r.x) for r in got.collect())
    versions.write_days(rows((1, 1), (2, 2), (2, 3), (None, 4)), path, "day")
    versions.write_days(rows((2, 5), (3, 6)), path, "day")
    assert held() == [(0, 4), (1, 1), (2, 5), (3, 6)]
    assert held(F.col("day") >= dt.date(2024, 1, 3)) == [(3, 6)]
    versions.write_days(rows((None, 7)), path, "day")
    assert held() == [(0, 7), (1, 1), (2, 5), (3, 6)]
    versions.write_days(rows((1, 8)), path, "day", replace_all=True)
    assert held() == [(1, 8)]


def test_chunks_of_the_scan_are_held_one_at_a_time(spark):
    centres, vecs = clustered(5, 90)
    p, q = patterns(spark, vecs), queries(spark, list(centres))
    one, many = (retrieval.similar_failures(q, p, 3, b) for b in (1 << 20, 200))
    assert {tuple(r)[:3] for r in one.collect()} == {tuple(r)[:3] for r in many.collect()} == brute(centres, vecs, 3)
