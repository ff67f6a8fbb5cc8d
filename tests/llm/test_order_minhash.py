import random

import pytest

from pitchline.llm import order_minhash as om

SCHEMA = "doc_id long, text string, key string, node long"  # extra columns clash with inner names


def brute(rows, threshold=om.THRESHOLD):
    """Classes of all pairs by the plain dynamic programme."""
    texts = [om.kmers(b" ".join((t or "").encode().lower().split())) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = texts[i], texts[j]
            line = [0] * (len(b) + 1)
            for x in a:
                before, line = line, [0] * (len(b) + 1)
                for k, y in enumerate(b):
                    line[k + 1] = before[k] + 1 if x == y else max(before[k + 1], line[k])
            n = line[-1]
            if not a and not b or n >= threshold * (len(a) + len(b) - n) and n:
                up[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], SCHEMA).repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in om.classes(df).collect()}
    roots = brute(rows)
    least = {}
    for (d, _), r in zip(rows, roots):
        least[r] = min(least.get(r, d), d)
    assert got == {d: least[r] for (d, _), r in zip(rows, roots)}
    kept = om.deduplicate(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(least.values()))
    assert all(set(r.asDict()) == {"doc_id", "text", "key", "node"} for r in kept)


def test_copies_of_copies(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    passage = " ".join(word() for _ in range(50))
    rows, d = [], 100
    for base in range(6):
        words = [word() for _ in range(r.choice([60, 90, 150]))]
        rows.append((r.randint(0, 10**6), " ".join(words)))
        for _ in range(12):  # one or two words changed: near the text, not always near each other
            copy = list(words)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(len(copy))] = word()
            rows.append((r.randint(0, 10**6), " ".join(copy)))
    for _ in range(15):  # a shared passage makes no near duplicates
        rows.append((r.randint(0, 10**6), " ".join(word() for _ in range(60)) + " " + passage))
    rows = list({d: (d, t) for d, t in rows}.values())
    check(spark, rows)


def test_odd_texts(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    check(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One\x0btwo"), (6, "one"), (7, "a b c d e"),
                  (8, "a b c d e f"), (9, long), (10, long + " end"), (11, "x " * 300), (12, "x " * 290), (13, "x " * 100)])


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "", 0), (5, "q r s t u v", "", 0), (5, "q r s t u v", "", 0),
                                (5, "other words than before here", "", 0), (None, None, None, None)], SCHEMA)
    got = sorted(((r["doc_id"], r["class_id"]) for r in om.classes(df).collect()), key=repr)
    assert got == [(5, 5), (5, 5), (5, 5), (None, None), (None, None)]
    assert om.deduplicate(df).count() == 4
    assert om.classes(df.limit(0)).collect() == [] and om.deduplicate(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_alignment_is_the_plain_one(seed):
    r = random.Random(seed)
    for _ in range(200):
        a = [r.choice("ab" if seed % 2 else "abcdefghij") for _ in range(r.randint(0, 40))]
        b = list(a)
        for _ in range(r.randint(0, 6)):
            if b:
                i = r.randrange(len(b))
                b[i:i + r.randint(0, 1)] = r.choice(["", "a", "xy"])
        line = [0] * (len(b) + 1)
        for x in a:
            before, line = line, [0] * (len(b) + 1)
            for k, y in enumerate(b):
                line[k + 1] = before[k] + 1 if x == y else max(before[k + 1], line[k])
        n, both = line[-1], len(a) + len(b)
        assert om.similar(a, b, 0.8) == (5 * n >= 4 * (both - n))


def test_pairs_of_a_large_bucket(spark):
    # pages on one template have 50 of 57 k-mers in common, a similarity of
    # 0.78; near copies one more, 0.81, which few buckets can show
    template = " ".join(f"t{i}" for i in range(54))
    page = lambda first, rest: f"{template} {first} " + " ".join(f"u{rest}x{j}" for j in range(6))
    pages = {i: page(f"f{i}", i) for i in range(800)}
    copies = {1000 + i: page(f"f{i}", 1000 + i) for i in range(30, 800, 50)}
    rows = [(d, t, "k", 1) for d, t in (pages | copies).items()]
    got = {r["doc_id"]: r["class_id"] for r in om.classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == {d: d % 1000 for d, *_ in rows}


def test_short_texts_with_a_word_more_or_less(spark):
    rows = []
    for n in range(5, 22):  # words; the pairs of 8 and 9 and of 9 and 10 are near duplicates
        words = [f"a{n}x{i}" for i in range(n)]
        rows += [(10 * n, " ".join(words)), (10 * n + 1, " ".join([*words, "end"])), (10 * n + 2, " ".join(words[2:]))]
    check(spark, rows)


@pytest.mark.parametrize("n", range(1, 15))
def test_similar_short_texts_share_a_key(n):
    r = random.Random(n)
    for _ in range(60):
        a = [f"w{i}" for i in range(n + om.SHINGLE - 1)]
        b = list(a)
        for _ in range(r.randint(0, 3)):
            i = r.choice([0, len(b), r.randrange(len(b) + 1)])
            b[i:i + r.randint(0, 1)] = r.choice([[], ["y"]])
        x, y = (" ".join(w).encode() for w in (a, b))
        if len(om.kmers(y)) <= om.SHORT and om.similar(om.kmers(x), om.kmers(y)):
            keys = [set(om.keys_of(om.word_hashes(t), om.THRESHOLD).tolist()) for t in (x, y)]
            assert keys[0] & keys[1]
