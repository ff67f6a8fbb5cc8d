"""Operator 13, conversation prefix trie from ternary search trees.

Distinct turns (role and text) get dense ids in a dictionary, so that a
conversation is a sequence of numbers. The sequences are sorted in Spark and
cut into shards of ``SHARD_ROWS`` rows. In a shard the sequences are inserted
into a ternary search tree, the median first and then the medians of both
halves, which balances the trees of siblings; an iterative traversal, from
the nodes made last to the root, accumulates members, leaves and savings.
Nodes that also stand in a neighbouring shard (the common prefixes of the
rows at both ends) are merged afterwards.

The sums of shards simply add up, because each shard knows the row before
and the row after it: a shared node's text and its place among its siblings
are counted by the first shard that holds it, a missing child by the last.

Defined results: null role or text is empty; turns are ordered by ``turn``
(null first), then by role, then by the SHA-256 of role and text; repeated
rows are turns of their own; rows without conv_id take no part; very long
texts count as their hash and length; a conversation without turns ends at
the root; without conversations there is no node; other columns are not
read. Turns are equal if the SHA-256 of role and text are.

At scale: texts are never shuffled. Conversations longer than ``BAND`` turns
are cut into bands: the next band's sequences have the hash of all earlier
turns as their key, and its trees hang below that node. What one
conversation has for itself from some band on is a chain and takes no tree,
so a single conversation of any length is spread over tasks. One task holds
one shard, cut again at ``SHARD_TURNS`` turns. There are as many rounds as
bands that conversations share. The ids of a node's conversations go through
one hash in order, which SHA-256 asks for; they come as strings of shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import buckets
from pitchline.operators.ranking import global_row_number, materialize, rank_within

BAND = 4096
SHARD_ROWS, SHARD_TURNS = 2000, 200_000
NOTHING = hashlib.sha256().hexdigest()


def encode(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size): each conversation's turns in order, with the
    id of role and text in the dictionary and the text's UTF-8 bytes."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text)
    turns = materialize(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.sha2(both, 256)).alias("key"), F.octet_length(text).cast("long").alias("size")), "turns")
    dictionary = global_row_number(turns.select("key").distinct(), ["key"], "id")
    encoded = turns.join(dictionary, "key").select("conv_id", "turn", "role", "id", "size")
    ranked = rank_within(encoded, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "id"], "pos")
    return materialize(ranked.select("conv_id", "pos", "id", "size"), "encoded")


# ------------------------------------------------------------------- a shard


class Row(NamedTuple):
    key: str
    ids: list
    sizes: list
    conv_id: int
    goes_on: bool  # the conversation has turns in the next band
    below: tuple  # children, leaves and savings that hang below such a row
    root_low: int | None


class TernaryTree:
    """Nodes by number; 0 is the root, and no node where a link is 0."""

    def __init__(self):
        self.turn, self.size, self.up, self.depth = [0], [0], [0], [0]
        self.less, self.more, self.first = [0], [0], [0]

    def _new(self, turn: int, size: int, up: int) -> int:
        for column, value in ((self.turn, turn), (self.size, size), (self.up, up), (self.depth, self.depth[up] + 1),
                              (self.less, 0), (self.more, 0), (self.first, 0)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list, sizes: list) -> int:
        """The node of the whole sequence."""
        node = 0
        for turn, size in zip(ids, sizes):
            at = self.first[node]
            if not at:
                at = self.first[node] = self._new(turn, size, node)
            while self.turn[at] != turn:
                side = self.less if turn < self.turn[at] else self.more
                if not side[at]:
                    side[at] = self._new(turn, size, node)
                at = side[at]
            node = at
        return node

    def path(self, node: int) -> list[int]:
        """From the root to the node."""
        out = [node]
        while node:
            node = self.up[node]
            out.append(node)
        return out[::-1]


def medians(n: int) -> Iterator[int]:
    """0 to n-1, the median first, then the medians of both halves."""
    spans = [(0, n)]
    while spans:
        a, b = spans.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            spans += [(middle + 1, b), (a, middle)]


def common(a: Row | None, b: Row) -> int:
    """How many turns both begin with; -1 if they have not even the root in common."""
    if a is None or a.key != b.key:
        return -1
    n = 0
    for x, y in zip(a.ids, b.ids):
        if x != y:
            break
        n += 1
    return n


def shard_nodes(rows: list[Row], before: Row | None, after: Row | None) -> dict[str, list]:
    """All nodes of one shard (rows of one key, in order), as columns."""
    starts = [i for i, r in enumerate(rows) if not i or r.ids != rows[i - 1].ids]
    tree, ends = TernaryTree(), [0] * len(starts)
    for k in medians(len(starts)):
        ends[k] = tree.insert(rows[starts[k]].ids, rows[starts[k]].sizes)

    n = len(tree.turn)
    members, low = [0] * n, [None] * n
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    names = {}
    left, right = tree.path(ends[0]), tree.path(ends[-1])
    earlier = set(left[:common(before, rows[0]) + 1])  # nodes that an earlier shard holds too
    later = set(right[:common(after, rows[-1]) + 1])
    for k, node in enumerate(ends):
        mine = rows[starts[k]:starts[k + 1] if k + 1 < len(starts) else len(rows)]
        members[node], low[node] = len(mine), min(r.conv_id for r in mine)
        names[node] = [r.conv_id for r in mine if not r.goes_on]
        if mine[-1].goes_on and node not in later:
            children[node], leaves[node], saved[node] = mine[-1].below
    goes_on = {node for k, node in enumerate(ends) if rows[(starts + [len(rows)])[k + 1] - 1].goes_on}

    # a node is made after those above it, so this order meets the nodes below first
    for v in range(n - 1, -1, -1):
        if not tree.first[v] and v not in later and v not in goes_on:
            leaves[v] = 1
        saved[v] += (members[v] - (v not in earlier)) * tree.size[v]
        if v:
            u = tree.up[v]
            members[u] += members[v]
            low[u] = low[v] if low[u] is None else min(low[u], low[v])
            children[u] += v not in earlier
            leaves[u] += leaves[v]
            saved[u] += saved[v]

    keys = {}
    for path in (left, right):
        digest = hashlib.sha256(rows[0].key.encode())
        for v in path:
            if v:
                digest.update(tree.turn[v].to_bytes(8, "little"))
            if v not in earlier and v not in later:
                break
            keys[v] = digest.hexdigest()
    top = rows[0].root_low  # the root's smallest conversation, if it belongs to an earlier band
    given = [top if top is not None and tree.depth[v] == 1 else None for v in range(n)]
    text = [",".join(map(str, names.get(v, ()))) for v in range(n)]
    return {
        "key": [rows[0].key] * n, "conv_id": low, "depth": tree.depth,
        "parent_conv_id": [None if not v else low[tree.up[v]] if given[v] is None else given[v] for v in range(n)],
        "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "ends": [t if v in keys else hashlib.sha256(t.encode()).hexdigest() for v, t in enumerate(text)],
        "ends_from": [names[v][0] if names.get(v) else None for v in range(n)],
        "node_key": [keys.get(v) for v in range(n)],
        "parent_key": [keys.get(tree.up[v]) if v and given[v] is None else None for v in range(n)]}


NODE = ("key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends string, ends_from long, node_key string, parent_key string")
_ARROW = pa.schema([(name, pa.string() if kind == "string" else pa.int64())
                    for name, kind in (c.split() for c in NODE.split(", "))])


def shards_of(rows: Iterator[tuple[int, int, Row]], turns: int) -> Iterator[tuple[list[Row], Row | None, Row | None]]:
    """Cut (shard, side, row) into pieces of one key and about ``turns``
    turns, each with the row before and the row after it. Side 0 is a row of
    the shard, -1 and 1 are its neighbours."""
    now, before, held, size = None, None, [], 0
    for shard, side, row in rows:
        other = shard != now
        if held and (other or side or row.key != held[0].key or size >= turns):
            yield held, before, None if other else row
            before, held, size = held[-1], [], 0
        if other:
            now, before = shard, None
        if side < 0:
            before = row
        elif not side:
            held.append(row)
            size += len(row.ids) + 1
    if held:
        yield held, before, None


# --------------------------------------------------------------------- Spark


def level(rows: DataFrame, shard_rows: int, shard_turns: int) -> DataFrame:
    """The nodes of all trees of one band; depth 0 are the roots. ``rows``:
    key, ids, sizes, conv_id, goes_on, children, leaves, saved, root_low."""
    spark = rows.sparkSession
    numbered = global_row_number(rows, ["key", "ids", "goes_on", "conv_id"], "pos")
    shards = max(1, -(-numbered.count() // shard_rows))
    shard, inside = F.expr(f"(pos - 1) div {shard_rows}"), (F.col("pos") - 1) % shard_rows
    side = lambda to, n: F.struct(to.alias("shard"), F.lit(n).alias("side"))
    copies = F.array_compact(F.array(
        side(shard, 0), F.when((inside == 0) & (shard > 0), side(shard - 1, 1)),
        F.when((inside == shard_rows - 1) & (shard < shards - 1), side(shard + 1, -1))))
    names = ["key", "ids", "sizes", "conv_id", "goes_on", "children", "leaves", "saved", "root_low"]
    dealt = numbered.select("pos", *names, F.explode(copies).alias("c")).select("c.shard", "c.side", "pos", *names)
    dealt = dealt.repartitionById(min(shards, buckets(spark)), F.col("shard").cast("int")).sortWithinPartitions("shard", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[int, int, Row]]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("shard", "side", *names)]
                for s, d, key, ids, sizes, conv, goes_on, children, leaves, saved, low in zip(*columns):
                    yield s, d, Row(key, ids, sizes, conv, goes_on, (children, leaves, saved), low)

        for held, before, after in shards_of(each(), shard_turns):
            yield pa.RecordBatch.from_pydict(shard_nodes(held, before, after), _ARROW)

    nodes = materialize(dealt.mapInArrow(run, NODE), "nodes")
    shared = nodes.where(F.col("node_key").isNotNull())
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = materialize(shared.groupBy("node_key").agg(
        *(F.min(c).alias(c) for c in ("key", "conv_id", "depth", "parent_conv_id", "parent_key")),
        *(F.sum(c).alias(c) for c in sums)), "merged")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = digest = None
        for batch in batches:
            for key, text in zip(batch.column("node_key").to_pylist(), batch.column("ends").to_pylist()):
                if key == now:
                    digest.update(b"," + text.encode())
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_pydict({"node_key": [now], "ends": [digest.hexdigest()]})
                now, digest = key, hashlib.sha256(text.encode())
        if now is not None:
            yield pa.RecordBatch.from_pydict({"node_key": [now], "ends": [digest.hexdigest()]})

    pieces = shared.where(F.col("ends_from").isNotNull()).select("node_key", "ends_from", "ends")
    ends = pieces.repartition("node_key").sortWithinPartitions("node_key", "ends_from").mapInArrow(
        hashed, "node_key string, ends string")
    columns = ["key", "conv_id", "depth", "parent_conv_id", *sums, "ends", "parent_key"]
    whole = merged.join(ends, "node_key", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))
    known = nodes.where(F.col("node_key").isNull()).select(*columns).unionByName(whole.select(*columns))
    lows = merged.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent_low"))
    below = known.where(F.col("parent_key").isNotNull()).join(lows, "parent_key").withColumn("parent_conv_id", F.col("parent_low"))
    return known.where(F.col("parent_key").isNull()).select(*columns[:-1]).unionByName(below.select(*columns[:-1]))


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_tree(turns: DataFrame, lengths: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS,
                shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row a node of the trie. ``turns``: conv_id, depth (from 1 without
    gaps), id, size; ``lengths``: conv_id, length, of all conversations."""
    cut = turns.groupBy("conv_id", F.expr(f"(depth - 1) div {band}").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "id", "size"))).alias("t"))  # ``band`` turns at most
    cut = cut.select("conv_id", "band", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))
    none = F.array().cast("array<bigint>")
    parts = lengths.join(cut, "conv_id", "left").select(
        "conv_id", "length", F.coalesce("band", F.lit(0)).cast("long").alias("band"),
        F.coalesce("ids", none).alias("ids"), F.coalesce("sizes", none).alias("sizes"))
    longest = lengths.agg(F.max("length").alias("n")).first()["n"]
    if (longest or 0) <= band:
        first = parts.select(F.lit("").alias("key"), "ids", "sizes", "conv_id", F.lit(False).alias("goes_on"), *(
            F.lit(None).cast("long").alias(c) for c in ("children", "leaves", "saved", "root_low")))
        return level(first, shard_rows, shard_turns).withColumnRenamed("ends", "ends_sha256").select(*RESULT)

    # hashes of all turns before each band and up to its end: a few a conversation
    piece = F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), ","), 256)
    order = Window.partitionBy("conv_id").orderBy("band")
    up_to = lambda last: F.sha2(F.array_join(F.collect_list("piece").over(
        order.rowsBetween(Window.unboundedPreceding, last)), ","), 256)
    parts = materialize(parts.withColumn("piece", piece).select(
        "*", up_to(-1).alias("key"), up_to(0).alias("after")).drop("piece"), "bands")
    roots = parts.groupBy((F.col("band") + 1).alias("band"), F.col("after").alias("key")).agg(F.min("conv_id").alias("root_low"))
    sizes = parts.where("band > 0").groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.join(roots, ["band", "key"]), "roots")
    last = sizes.where("n > 1").agg(F.max("band").alias("k")).first()["k"] or 0

    # what a conversation has for itself from some band on
    alone = parts.where("band > 0").join(sizes.where("n = 1"), ["band", "key"]).groupBy("conv_id").agg(
        F.min_by(F.struct((F.col("band") * band).alias("at"), "root_low"), "band").alias("c"))
    own = turns.join(alone, "conv_id").where("depth > c.at").join(lengths, "conv_id")
    over = F.col("depth") == F.col("length")
    result = own.select(
        "conv_id", "depth", F.when(F.expr("depth = c.at + 1"), F.col("c.root_low")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), (~over).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(over, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"))

    below = None  # totals of the trees of the band below, by key
    for k in range(last, -1, -1):
        rows = parts.where(F.col("band") == k).withColumn("goes_on", F.col("length") > (k + 1) * band)
        if k:
            rows = rows.join(sizes.where((F.col("band") == k) & (F.col("n") > 1)).select("key", "root_low"), "key")
        else:
            rows = rows.withColumn("root_low", F.lit(None).cast("long"))
        if below is None:
            rows = rows.select("*", *(F.lit(None).cast("long").alias(c) for c in ("t_children", "t_leaves", "t_saved")))
        else:
            rows = rows.join(below, "after", "left")
        # a band below without a tree is one chain
        rows = rows.select("key", "ids", "sizes", "conv_id", "goes_on", "root_low", *(
            F.when(F.col("goes_on"), F.coalesce(f"t_{c}", F.lit(n).cast("long"))).alias(c)
            for c, n in (("children", 1), ("leaves", 1), ("saved", 0))))
        nodes = level(rows, shard_rows, shard_turns)
        if k:
            below = materialize(nodes.where("depth = 0").select(
                F.col("key").alias("after"), F.col("n_children").alias("t_children"), F.col("n_leaves").alias("t_leaves"),
                F.col("saved_tokens").alias("t_saved")), "below")
            nodes = nodes.where("depth > 0")
        result = result.unionByName(nodes.withColumn("depth", F.col("depth") + k * band).withColumnRenamed(
            "ends", "ends_sha256").select(*RESULT))
    return result


def rebuild(encoded: DataFrame, spread: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of the rebuilt conversations: c gets the first h
    turns of c - c % ``spread``, then its own after its first h; h is
    crc32(c as text) modulo ``heads``."""
    convs = encoded.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % spread).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = materialize(convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "convs")
    first = encoded.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    lead = convs.select("conv_id", "base", "taken").join(first, "base").where("pos <= taken")
    own = encoded.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h")
    turns = lead.select("conv_id", F.col("pos").alias("depth"), "id", "size").unionByName(
        own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "id", "size"))
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return turns, lengths


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree(*rebuild(encode(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
