import itertools
import math

import numpy as np
import pytest

from pitchline.llm import hilbert_neighbours as hn

SCHEMA = "vec_id long, embedding array<float>, score string"  # the extra column clashes with a result's name


def brute(rows, top, every):
    size = max({len(v) for _, v in rows if v is not None} or {0}, key=lambda n: sum(v is not None and len(v) == n for _, v in rows))
    good = sorted({(i, tuple(np.float32(v).tolist())) for i, v in rows
                   if i is not None and v is not None and len(v) == size and None not in v
                   and all(map(math.isfinite, v)) and any(v)})
    out = []
    for i, q in good:
        if i % every == 0:
            near = sorted((-float((np.array(q) * np.array(v)).sum()), j) for j, v in good if j != i)[:top]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(near, 1)]
    return out


def check(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in hn.neighbours(df, **more).collect())
    want = sorted(brute(rows, more.get("top", hn.TOP), more.get("every", hn.EVERY)))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_few_vectors_are_searched_exactly(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), r.standard_normal(8).tolist()) for i in r.permutation(150)]
    hot = r.standard_normal(8).tolist()
    rows += [(i, hot) for i in range(200, 260)] + [(200, hot), (7, rows[0][1])]
    rows += [(300, None), (301, [0.0] * 8), (302, [1.0] * 7), (303, [math.nan] + [1.0] * 7), (304, [math.inf] * 8),
             (None, hot), (305, [None] + [1.0] * 7), (320, [5.0] * 8), (340, [-0.1] * 8)]
    check(spark, rows)


def test_fewer_candidates_than_asked(spark):
    check(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 2.0])])
    check(spark, [(0, [1.0, 0.0])])


def test_empty_table(spark):
    assert hn.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


def test_recall_in_small_runs(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in hn.neighbours(df, run_rows=64).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = {}
    for i, _, j, _ in brute(rows, hn.TOP, hn.EVERY):
        want.setdefault(i, set()).add(j)
    assert got.keys() == want.keys()
    assert sum(len(got[i] & want[i]) for i in want) >= 0.9 * sum(map(len, want.values()))


def test_runs_grow_until_the_recall_holds(spark):
    """Windows of short runs on few curves cover under a tenth of the table at
    first; the measured recall makes them as long as it takes."""
    r = np.random.default_rng(8)
    rows = [(i, v) for i, v in enumerate(r.standard_normal((4000, 16)).round(3).tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)

    def share(**more):
        got = {}
        for x in hn.neighbours(df, top=5, every=80, curves=3, run_rows=16, **more).collect():
            got.setdefault(x["query_id"], set()).add(x["vec_id"])
        want = {}
        for i, _, j, _ in brute(rows, 5, 80):
            want.setdefault(i, set()).add(j)
        return sum(len(got.get(i, set()) & want[i]) for i in want) / sum(map(len, want.values()))

    assert share(recall=0) < 0.6 and share(recall=0.9) >= 0.9


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbouring_cells(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = hn.hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
