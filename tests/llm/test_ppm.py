import math
import zlib
from collections import Counter

import pytest

from pitchline.llm import ppm

SCHEMA = "doc_id long, text string, score string"  # the extra column clashes with a result's name


def brute(rows, order):
    held = {d: zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d, _ in rows}
    low = [(d, (t or "").encode().lower()) for d, t in rows]
    counts, model = Counter(), ppm.Adaptive(order)
    for d, t in low:
        if not held[d]:
            counts.update([*t.split(), b"\n"])
            model.cost(t)
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in low:
        words = [*t.split(), b"\n"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((d, held[d], len(words), sum(counts[w] > 0 for w in words), n, base,
                    -model.cost(t, learn=False) * math.log10(2)))
    return out


def check(spark, rows, order=4):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    got = [tuple(r) for r in ppm.score(df, order).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    want = brute(rows, order)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-5)


def test_scores_match_a_plain_trie(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()
    check(spark, [(r[0], r[1][:800]) for r in docs])


@pytest.mark.parametrize("order", [1, 2, 3])
def test_orders_and_odd_texts(spark, order):
    rows = [(1, "Aa\x0b bB\x0c\n\t c"), (2, None), (3, ""), (None, "null id"), (4, "aaaa" * 50), (4, "aaaa" * 50),
            (5, "é中\U0001f44d  x"), (6, "never seen zq"), (7, "Aa bB c"), (24, "x" * 3000)]
    check(spark, rows, order)


def test_empty_table(spark):
    assert ppm.score(spark.createDataFrame([], SCHEMA)).collect() == []


def test_probabilities_add_up_to_one():
    model = ppm.Adaptive(2)
    model.cost(b"abracadabra")
    history = (ord("b"), ord("r"))
    assert sum(model.probability(history, s) for s in range(256) if s != ppm.START) == pytest.approx(1)


def test_parts_are_summed_whatever_their_sizes():
    import numpy as np

    r = np.random.default_rng(3)
    parts = [(np.unique(r.integers(0, 500, r.integers(0, 80))).astype(np.uint64),) for _ in range(30)]
    parts = [(k, r.integers(0, 9, len(k)).astype(np.uint32)) for k, in parts]
    want = {}
    for keys, n in parts:
        for k, c in zip(keys.tolist(), n.tolist()):
            want[k] = want.get(k, 0) + c
    for at_once in (1, 100, 1 << 20):
        keys, n = ppm.combined(parts, at_once)
        assert dict(zip(keys.tolist(), n.tolist())) == want and keys.tolist() == sorted(want)
    assert [len(x) for x in ppm.combined([])] == [0, 0]
