import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchline.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, score string, anchor string"  # extra columns clash


def brute(rows, every, n_pos=5, n_neg=3):
    good = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        good.add((i, label, tuple(math.floor(x * 256) for x in v)))
    out = []
    for i, label, v in good:
        if i % every:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, lb) for j, lb, w in good if j != i and len(w) == len(v))
        for p, j, _ in [x for x in near if x[2] == label][:n_pos]:
            fits = [(s, k) for s, k, lb in near if lb != label and 50 * -p <= 100 * -s <= 95 * -p][:n_neg]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fits, 1)]
    return sorted(out)


def check(spark, rows, every=5, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in hn.mine(df, F.col("label"), every, **more).collect())
    want = brute(rows, every)
    assert got == want
    return got


@pytest.mark.parametrize("grid", [{}, {"anchors_at_once": 4, "rows_at_once": 30}])
def test_all_pairs(spark, grid):
    r = np.random.default_rng(2)
    rows = [(int(i), int(r.integers(0, 3)), (r.integers(-4, 9, 6) / 8).tolist()) for i in r.permutation(240)]  # many ties
    rows += [(300 + i, 1, [0.5] * 6) for i in range(40)] + [rows[0], rows[0], (5, 2, [0.25] * 6)]
    rows += [(400, None, [0.1] * 6), (401, 1, None), (402, 1, [math.nan] * 6), (403, 1, [None] + [0.1] * 5),
             (404, 1, [math.inf] * 6), (None, 1, [0.1] * 6), (405, 0, [0.3] * 4), (406, 1, [0.3] * 4), (410, 0, [0.9] * 4),
             (415, 0, []), (416, 1, []), (417, 0, []), (420, 1, [1e306] * 6)]
    assert check(spark, rows, **grid)


def test_large_components_are_exact(spark):
    r = np.random.default_rng(4)
    rows = [(i, i % 2, (r.integers(1, 1 << 20, 3) + 0.5).tolist()) for i in range(40)]
    assert check(spark, rows)


def test_negative_and_zero_positives(spark):
    assert check(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.7]), (3, 2, [0.0])]) == []
    assert len(check(spark, [(0, 1, [1.0]), (1, 1, [0.0]), (2, 2, [-0.7]), (3, 2, [0.0])])) == 1


def test_no_rows(spark):
    assert check(spark, []) == []


def test_batches_of_rows(monkeypatch):
    import pyarrow as pa

    r = np.random.default_rng(7)
    scores, same = r.integers(-50, 200, (6, 90)), r.random((6, 90)) < 0.3
    ids = r.permutation(90)
    positives = pa.table({"positives": [[190, 150, 150], [100], [0], [-20, 180], [60, 61, 62], [199]]})
    whole, parts = (hn.Slots(positives, 3) for _ in range(2))
    everything = np.ones((6, 90), bool)
    whole.add(scores, same, everything, ids)
    for a in range(0, 90, 7):
        parts.add(scores[:, a:a + 7], same[:, a:a + 7], everything[:, a:a + 7], ids[a:a + 7])
    for x, y in zip((*whole.found(), whole.best.id), (*parts.found(), parts.best.id)):
        assert x.tolist() == y.tolist()
