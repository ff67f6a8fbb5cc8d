import hashlib
import random
import zlib

import pytest

from pitchline.llm import prefix_tree as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id string"  # extra columns clash


def ordered(rows):
    of = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())} {role}{text}".encode()).hexdigest()
            of.setdefault(c, []).append(((turn is not None, turn or 0), role, digest, (role, text)))
    return {c: [t[-1] for t in sorted(x)] for c, x in of.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        inside = [p for p in nodes if p[:len(prefix)] == prefix]
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(prefix))
        children = [p for p in inside if len(p) == len(prefix) + 1]
        leaves = [p for p in inside if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in inside)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in inside if p)
        out.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(seed):
    r = random.Random(seed)
    texts = [None, "", "a", "bb", "ccc", "é", "dddd"]
    rows = [(c, t, r.choice(["user", "assistant", None]) if r.random() < 0.2 else "user", r.choice(texts[:r.choice([3, 7])]))
            for c in range(60) for t in range(r.randint(1, 9))]
    rows += [(c, t, "user", "same") for c in range(100, 130) for t in range(4)]  # one common conversation
    rows += [(200 + c, t, "user", str(t)) for c in range(3) for t in range(23 + 4 * (c > 1))]  # long copies
    rows += [(300, t, "user", str(t % 7)) for t in range(40)] + [(301, None, "user", "first"), (301, 2, None, None), (301, 2, "user", "x"),
             (301, 2, "user", "y"), (301, 2, "user", "y"), (302, 1, "user", "long " * 5000), (None, 1, "user", "lost")]
    r.shuffle(rows)
    return rows


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 7}, {"band": 3, "shard_rows": 5}, {"band": 1, "shard_turns": 6}])
def test_against_all_prefixes(spark, sizes):
    rows = rows_of(len(sizes))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    if sizes.get("band") == 1:  # as many rounds as shared turns: shorter ones
        df = df.where("conv_id < 60 and turn < 4")
        rows = [r for r in rows if r[0] is not None and r[0] < 60 and (r[1] or 0) < 4]
    got = pt.prefix_tree(*pt.rebuild(pt.encode(df)), **sizes)
    assert got.columns == list(pt.RESULT)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rebuilt(ordered(rows))), key=key)


def test_no_rows(spark):
    assert pt.prefix_tree(*pt.rebuild(pt.encode(spark.createDataFrame([], SCHEMA)))).collect() == []


def merged(pieces):
    """Sums of the nodes of all pieces by their whole prefix."""
    out = {}
    for held, before, after in pieces:
        made = pt.shard_nodes(held, before, after)
        for i, (low, depth) in enumerate(zip(made["conv_id"], made["depth"])):
            prefix = next(tuple(r.ids[:depth]) for r in held if r.conv_id == low)
            sums = out.setdefault(prefix, [0] * 4)
            for j, c in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens")):
                sums[j] += made[c][i]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_shards_add_up(seed):
    r = random.Random(seed)
    found = sorted(([r.randint(0, 2) for _ in range(r.randint(0, 5))], c) for c in range(40))
    rows = [pt.Row("k", ids, [t + 1 for t in ids], c, False, (None, None, None), None) for ids, c in found]
    whole = merged([(rows, None, None)])
    one = [(0, 0, x) for x in rows]
    assert merged(pt.shards_of(iter(one), r.randint(1, 30))) == whole
    # shards of three rows, with their neighbours
    cut = [(i // 3, 0, x) for i, x in enumerate(rows)]
    cut += [(i // 3 - 1, 1, rows[i]) for i in range(3, 40, 3)] + [(i // 3 + 1, -1, rows[i]) for i in range(2, 39, 3)]
    order = sorted(range(len(cut)), key=lambda i: (cut[i][0], cut[i][1]))
    assert merged(pt.shards_of((cut[i] for i in order), 1000)) == whole


def test_tree_is_balanced_and_complete():
    assert sorted(pt.medians(100)) == list(range(100))
    tree = pt.TernaryTree()
    ends = {i: tree.insert([5, i], [1, 1]) for i in pt.medians(1000)}
    assert len(tree.turn) == 1002 and len(set(ends.values())) == 1000

    def height(at):
        return 1 + max(height(tree.less[at]), height(tree.more[at])) if at else 0

    assert height(tree.first[tree.first[0]]) == 10
    assert tree.insert([5, 17], [1, 1]) == ends[17] and tree.path(ends[17])[0] == 0
