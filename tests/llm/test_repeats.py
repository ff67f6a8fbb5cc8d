import hashlib
import random

import pytest

from pitchline.llm import repeats

SCHEMA = "doc_id long, text string, kept string"  # the extra column clashes with a result's name


def brute(rows):
    n = repeats.LENGTH
    rows = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    low = lambda d: -(1 << 63) if d is None else d
    for d, t in rows:
        for i in range(len(t) - n + 1):
            s = t[i:i + n]
            least[s] = min(least.get(s, low(d)), low(d))
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if least[t[i:i + n]] < low(d):
                gone[i:i + n] = b"\1" * n
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, hot):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA).repartition(3)
    got = [(r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
            hashlib.sha256(r["kept"]).hexdigest()) for r in repeats.remove_repeats(df, hot).collect()]
    assert sorted(got, key=repr) == brute(rows)


def passages(seed, n, alphabet):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice(alphabet) for _ in range(k))
    shared = [text(r.choice([30, 49, 50, 51, 60, 75, 76, 77, 100, 400])) for _ in range(12)]
    rows = []
    for d in range(n):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(shared)
            a, b = r.randint(0, 20), len(p) - r.randint(0, 20)
            parts += [text(r.randint(0, 60)), p[a:b]]
        rows.append((r.randint(0, n), "".join(parts)))
    return rows


@pytest.mark.parametrize("hot", [1000, 4, 2])
def test_random_passages(spark, hot):
    check(spark, passages(hot, 80, "abcdefgh "), hot)


@pytest.mark.parametrize("hot", [1000, 3])
def test_repetitive_and_odd_texts(spark, hot):
    words = "the quick brown fox jumps over the lazy dog and runs far away " * 3
    rows = [(5, words), (3, words), (3, words), (7, None), (8, ""), (None, words + "x"), (9, "a" * 500), (10, "a" * 70 + "b" * 70),
            (11, "ab" * 100), (12, "b" + "ab" * 60), (13, "short"), (14, "é" * 40 + words[10:80]), (15, "\0" * 120),
            (16, "\0" * 60 + "q" * 55), (2, "z" * 49), (1, "z" * 50), (4, words[:50]), (6, words[1:51] + "\0" * 55)]
    check(spark, rows, hot)
    check(spark, [(d, t) for d, t in rows if d != None], hot)  # noqa: E711


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r[0], r[1]) for r in docs], 1000)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_interval_tree_yields_all_groups():
    # suffixes a, aa, ab, b with common prefixes 1, 1, 0
    assert list(repeats.interval_tree([0, 1, 1, 0], 1)) == [(0, 3, 1, 0)]
    assert list(repeats.interval_tree([0, 2, 1, 3], 1)) == [(0, 2, 2, 1), (2, 4, 3, 1), (0, 4, 1, 0)]
