import random
import re

import pytest

from pitchline.llm import host_quality as hq

SCHEMA = "doc_id long, text string, source string, host string, kept string, at long"  # extra columns clash


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(three) if three.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def documents():
    r = random.Random(5)
    rows = [(1, None, "a"), (2, "", None), (3, " \n\x0b\t", ""), (4, "one two", "a"), (5, "x\ny\nx\n x", "a"),
            (6, "a b c a b c a b", "a"), (7, "z " * 300, "b"), (8, "q#* " * 60, "c"), (None, "\U0001f600 \x1c é\xa0ü", None)]
    for i in range(10, 60):  # host spam fails the symbol rule as a rule, host good by chance
        text = " ".join(r.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]) + str(r.randint(0, 99)) for _ in range(80))
        spam = i % 2 == 0
        rows.append((i, text + (" ### $$$ %%% ***" if spam and i != 20 or i == 11 else ""), "spam" if spam else "good"))
    return rows + rows[9:11]


def test_measures(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "h", "k", 1) for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r)[:6] for r in hq.judge(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t, _ in rows), key=repr)


def test_verdicts(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "h", "k", 1) for r in rows], SCHEMA).repartition(3)
    kept = {r["doc_id"]: r["kept"] for r in hq.judge(df).collect()}
    assert not any(kept[i] for i in (1, 2, 3, 4, 5, 6, 7, None))  # base rules
    assert kept[20] and kept[11]  # clean on a bad host; one failure on a good host
    assert not kept[12] and not kept[58]
    out = hq.filter_documents(df).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(
        [d for d, k in kept.items() if k and d not in (10, 11)] + [d for d in (10, 11) if kept[d]] * 2)
    assert all(r["host"] == "h" and r["at"] == 1 for r in out)


def test_prior_shrinks_small_hosts(spark):
    rows = [(i, ("### " if i % 10 == 0 else "") + "word " * 5 + "#" * (i % 10 == 0), f"h{i % 20}") for i in range(400)]
    rows.append((999, "### ### ###", "tiny"))
    df = spark.createDataFrame([(*r, "h", "k", 1) for r in rows], SCHEMA)
    v = {r["host"]: r for r in hq.host_verdicts(hq.measures(df)).collect()}
    assert v["tiny"]["n_symbols"] == 1 and v["tiny"]["rate_symbols"] < 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hq.judge(df).collect() == [] and hq.filter_documents(df).collect() == []


@pytest.mark.parametrize("n", [2, 3, 4000])
def test_long_repeats(spark, n):
    df = spark.createDataFrame([(1, "one two three " * n, "a", "h", "k", 1)], SCHEMA)
    assert hq.judge(df).first()["n_repeat_words"] == 3 * n
