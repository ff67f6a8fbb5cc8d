import random

import pytest

from pitchline.llm import pfair

SCHEMA = "doc_id long, source string, text string, position string, _row string"  # extra columns clash


@pytest.mark.parametrize("seed", range(12))
def test_less_than_a_block_off(seed):
    r = random.Random(seed)
    shares = pfair.whole_shares({f"s{i}": r.random() + 1e-3 for i in range(r.randint(1, 25))}, 500)
    got = dict.fromkeys(shares, 0)
    order = pfair.edf(shares)
    for t, s in enumerate(order, 1):
        got[s] += 1
        assert all(abs(got[x] - n * t / len(order)) < 1 for x, n in shares.items())
    assert got == shares


def simulate(blocks, weights, resolution):
    """Slot by slot: of the released blocks that with the earliest deadline."""
    left, out, slot0 = dict(blocks), [], 0
    while any(left.values()):
        live = {s: weights[s] for s, n in left.items() if n}
        shares = pfair.whole_shares(live, resolution)
        period, done, slot = sum(shares.values()), dict.fromkeys(live, 0), 0
        while all(left[s] for s in live):
            ready = [(-(-(done[s] + 1) * period // shares[s]), s) for s in live if done[s] * period // shares[s] <= slot]
            s = min(ready)[1]
            done[s] += 1
            left[s] -= 1
            out.append(s)
            slot += 1
        slot0 += slot
    return out


@pytest.mark.parametrize("seed", range(8))
def test_schedule_is_the_simulation(seed):
    r = random.Random(seed)
    blocks = {f"s{i}": r.randint(1, 60) for i in range(r.randint(1, 6))}
    weights = {s: r.random() + 0.05 for s in blocks}
    plan = pfair.schedule(blocks, weights, 40)
    slots = {pfair.slot_of(plan[s], b): s for s, n in blocks.items() for b in range(n)}
    assert [slots[i] for i in range(len(slots))] == simulate(blocks, weights, 40)


def test_rows(spark):
    r = random.Random(1)
    rows = [(i, "big" if i % 3 == 0 else r.choice(["a", "b", None, ""]), "t", "p", "r") for i in range(400)]
    rows += [(5, "a", "other text", "p", "r"), (6, "b", None, "p", "r"), (7, "a", "t", "p", "r"), (7, "a", "t", "p", "r"),
             (None, "a", None, "p", "r")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    weights = {"big": 0.5, "a": 0.3, "b": 0.1, "": 0.1}
    placed = pfair.positions(df.select("doc_id", "source"), weights, block=4, resolution=100).collect()
    assert sorted(x["position"] for x in placed) == list(range(len(rows)))
    counts = {}
    for x in placed:
        counts[x["source"] or ""] = counts.get(x["source"] or "", 0) + 1
    order = simulate({s: -(-n // 4) for s, n in counts.items()}, weights, 100)
    assert all(order[x["slot"]] == (x["source"] or "") for x in placed)
    mixed = pfair.mix(df, weights, block=4, resolution=100)
    assert mixed.columns == df.columns
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, df.collect()))


def test_empty_one_source_and_bad_weights(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pfair.positions(df.select("doc_id", "source")).collect() == [] and pfair.mix(df).collect() == []
    one = spark.createDataFrame([(i, None, None, None, None) for i in range(9)], SCHEMA)
    assert sorted(x["position"] for x in pfair.positions(one.select("doc_id", "source")).collect()) == list(range(9))
    with pytest.raises(ValueError):
        pfair.positions(one.select("doc_id", "source"), {"": 0.0})


@pytest.mark.parametrize("weights", [
    {"hot": 1.0} | {f"s{i}": 0.002 + i * 1e-5 for i in range(199)}, {"big": 0.9997, "small": 0.0003},
    {f"s{i}": 0.3 if not i else 0.7 / 19 for i in range(20)}])
def test_given_weights_hold_to_a_block(weights):
    total, got = sum(weights.values()), dict.fromkeys(weights, 0)
    for t, (s, block, slot, position) in enumerate(pfair.dealt(dict.fromkeys(weights, 10**9), weights)):
        if t == 12_500:
            break
        assert (block, slot, position) == (got[s], t, 8 * t)
        got[s] += 1
        assert all(abs(n - weights[x] / total * (t + 1)) < 1 + 1e-9 for x, n in got.items())


def test_rows_by_exact_weights(spark):
    rows = [(i, "small" if i % 5 == 0 else "big", "t", "p", "r") for i in range(403)]
    weights = {"big": 0.9997, "small": 0.0003}
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "source").repartition(4)
    placed = pfair.positions(df, weights, block=4).collect()
    assert sorted(x["position"] for x in placed) == list(range(len(rows)))
    plan = {p: (s, slot) for s, _, slot, p in pfair.dealt({"big": 322, "small": 81}, weights, 4)}
    assert all(plan[x["position"]] == (x["source"], x["slot"]) for x in placed if x["position"] in plan)
