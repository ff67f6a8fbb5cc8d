import random

import pytest
import xxhash

from pitchline.llm import simhash_join as sj
from pitchline.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint string, fp long"  # extra columns clash with the result's


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for space in "\t\n\x0b\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values, low):
    """Smallest ``low`` that each value reaches by steps of two bits at most."""
    up = {v: v for v in values}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                up[find(a)] = find(b)
    out = {}
    for v in values:
        known = [x for x in (out.get(find(v)), low[v]) if x is not None]
        out[find(v)] = min(known, default=None)
    return {v: out[find(v)] for v in values}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA).repartition(3)
    low = {}
    for i, t in rows:
        f = plain_fingerprint(t)
        known = [x for x in (low.get(f), i) if x is not None]
        low[f] = min(known, default=None)
    ids = reach(sorted(low), low)
    want = [(i, f"{plain_fingerprint(t):016x}", ids[plain_fingerprint(t)]) for i, t in rows]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, sj.near_duplicates(df).collect()), key=key) == sorted(want, key=key)


def test_texts(spark):
    r = random.Random(3)
    words = ["Ähre", "BLUE", "car", "dog", "eel", "fox", "gnu", "hen", "ibis", "jay"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(1, 400)))) for i in range(60)]
    for i in range(60, 90):  # near copies
        some = rows[i - 60][1].split()
        some[r.randrange(len(some))] = "new"
        rows.append((i, "\n ".join(some)))
    rows += [(i, "the same words for all of them") for i in range(100, 140)]
    rows += [(200, None), (201, ""), (202, " \t\x0b"), (203, "One"), (204, "one two"), (205, "A B c"), (None, "one"),
             (None, "alone here"), (7, rows[3][1]), (206, rows[3][1].upper()), (207, "x " * 3000)]
    check(spark, rows)


def test_no_rows(spark):
    assert sj.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pieces_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = sj.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    runs = sj._runs
    monkeypatch.setattr(sj, "_runs", lambda t: runs(t, 7))
    assert sj.fingerprint(text.encode()) == whole


def clusters(seed, n=250):
    """Fingerprints in crowds of one to many bits apart, and scattered ones."""
    r = random.Random(seed)
    out = {0, (1 << 64) - 1}
    for size, distance in ((120, 3), (60, 5), (30, 1)):
        centre = r.getrandbits(64)
        for _ in range(size):
            out.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, distance))))
    mask = r.getrandbits(64) & r.getrandbits(64)  # bits that are mostly alike
    while len(out) < n:
        out.add(r.getrandbits(64) & mask)
    return sorted(out)


@pytest.mark.parametrize("layout,points", [(0, 1e9), (1, 1e9), (0, 8), (1, 40)])
def test_links_against_all_pairs(spark, layout, points):
    values = clusters(layout + int(points))
    signed = [v - (v >> 63 << 64) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(2)
    found = sj.links(df, (sj.LAYOUTS[layout],), points)
    got = {r["node"]: r["comp"] for r in components(found).collect()}
    of = dict(zip(values, signed))
    want = reach(values, of)
    assert {v: got.get(of[v], of[v]) for v in values} == want


def test_thresholds_add_up():
    import numpy as np

    r = np.random.default_rng(5)
    counts = r.integers(0, 50, (sj.CELLS, 1 << sj.WIDTH)).astype(float)
    groups = [list(range(16 * c, 16 * c + 16)) for c in range(4)]
    cells = sj.cell_values(r.integers(0, 1 << 63, 200).astype("<u8"), groups)
    for layout in sj.LAYOUTS:
        way = sj.Allocation(groups, counts, layout)
        thresholds, cost = way.best(cells)
        assert (thresholds.sum(axis=0) == sj.TAU - len(layout) + 1).all() and (thresholds >= -1).all()
        costs = way.costs(cells)
        spent = sum(costs[p, thresholds[p] + 1, np.arange(200)] for p in range(len(layout)))
        assert np.allclose(spent, cost)
