"""Windows of scores against brute force: ties, repeats, nulls, hot labels, short and huge vectors."""

import math

import numpy as np
import pytest
from llm_support import defaultdict, random
from pyspark.sql import functions as F

from plantmetrics.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, v string, row string, window int, low int, kind int, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, c, "x", "y", 1, 2, 3, 4) for i, e, c in rows], SCHEMA)


def brute(rows, k_pos=5, k_neg=10):
    least = {}
    for i, e, c in rows:
        if i is None or c is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = (c, [max(hn.LEAST, min(hn.MOST, math.floor(256 * float(np.float32(x))))) for x in e])
        least[i] = min(least.get(i, row), row)
    dot = lambda a, b: max(hn.LEAST, min(hn.MOST, sum(x * y for x, y in zip(a, b))))  # noqa: B905, E731
    out = set()
    for a, (label, v) in least.items():
        if a % 10:
            continue
        scored = [(-dot(v, w), i, c == label) for i, (c, w) in least.items() if i != a]
        for ps, p in sorted((s, i) for s, i, same in scored if same)[:k_pos]:
            fits = sorted((s, i) for s, i, same in scored if not same and 30 * -ps <= 100 * -s <= 90 * -ps)[:k_neg]
            out |= {(a, p, r, i, -ps, -s) for r, (s, i) in enumerate(fits, 1)}
    return out


def mined(spark, rows, **more):
    got = hn.hard_negatives(hn.integer_vectors(frame(spark, rows)), F.col("vec_id") % 10 == 0, **more).collect()
    assert len(got) == len(set(got))
    return {tuple(x) for x in got}


def vectors(seed, n, dims=20):
    """A hot label, groups of equal vectors, vectors around centres, zeros."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims))
    rows = []
    for i in range(n):
        v = centres[r.integers(5)] * r.uniform(0.2, 2) + r.normal(size=dims) * r.choice([0.0, 0.05, 0.8])
        rows.append((i, [float(x) for x in (v if r.random() > 0.05 else v * 0)], int(r.choice([1, 1, 1, 2, 3, 9]))))
    return rows


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "row_block": 7}])
def test_equals_brute_force(spark, blocks):
    rows = vectors(1, 240)
    rows += [rows[3], (4, [0.5] * 20, 0), (None, [1.0] * 20, 1), (1000, None, 1), (1001, [1.0] * 20, None), (1010, [None] + [1.0] * 19, 1),
             (1020, [float("nan")] * 20, 1), (1030, [float("-inf")] * 20, 1), (1040, [], 2), (1050, [3.0, 1.0], 1), (-10, [0.3] * 23, 9)]
    random.Random(2).shuffle(rows)
    expected = brute(rows)
    assert len(expected) > 100
    assert mined(spark, rows, **blocks) == expected


def test_ties_by_id(spark):
    rows = [(i, [1.0, 0.5 * (i % 3)], i % 2) for i in range(60)] + [(100, [1.0, 1.0], 0), (110, [2.0, 2.0], 0)]
    assert mined(spark, rows) == brute(rows)


def test_huge_components_are_exact_and_held_at_the_ends(spark):
    rows = [(i, [3e15 * (i % 7 + 1), -2e15 * (i % 4), 1e36 if i == 50 else 0.5], i % 3) for i in range(40)] + [(50, [1.0, 2.0, 1e36], 1)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table_and_single_label(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(i, [1.0, float(i)], 5) for i in range(20)]) == set()
    assert mined(spark, [(0, [1.0], 5), (1, [1.0], 6)]) == set()


def test_index_leaves_out_covered_dimensions_and_loses_nothing():
    """Pairs found through posting lists are those of the full product, at any threshold."""
    r = np.random.default_rng(5)
    scale = np.r_[np.full(8, 200.0), np.full(56, 8.0)]
    x, q = (np.floor(r.normal(size=(n, 64)) * scale) for n in (700, 40))
    full = q @ x.T
    rows = hn.Rows(x)
    for share in (0.0, 0.5, 0.9, 0.999):
        least = np.quantile(full, share, axis=1).round()
        at, of, score = hn.reaching(rows, q, least)
        got = defaultdict(set)
        for a, o, s in zip(at, of, score, strict=True):
            assert full[a, o] == s
            got[a].add(o)
        assert all(got[i] == set(np.flatnonzero(full[i] >= least[i])) for i in range(40))
