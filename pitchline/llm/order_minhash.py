"""Operator 3, near-duplicate detection by Order MinHash.

Words are runs without white space, ASCII letters lowered; k-mers are runs
of ``SHINGLE`` words, each labelled with its number among equal ones in the
text. For each of ``BANDS`` hash functions the ``SAMPLED`` k-mers with the
smallest hashes are kept in the order of the text, and this sequence is a
bucket key: it agrees for texts that share most k-mers in the same order.
Texts of up to ``SHORT`` k-mers also have a key for each sequence that is
left when as many k-mers are taken out as the threshold allows, so that
similar ones share a key for certain; texts of up to ``MEDIUM`` k-mers get
``MORE`` hash functions.
Candidates are verified by banded alignment of the k-mer sequences: with a
longest common subsequence L of two texts of m and n k-mers, they are near
duplicates if L / (m + n - L) is at least ``THRESHOLD``.

Texts with equal words are one text from the start. In rounds, each bucket
that holds several components is led by one member that has not led it,
which is compared with the members of other components: n comparisons for n
texts, not n^2/2. In the first round the text leads whose buckets hold the
most texts, which an original's do; copies that resemble only it, not each
other, meet through it. Later, texts that have found a link lead before
others, different ones in different buckets. The rounds end after ``IDLE``
ones in a row without a new link. What is open then, two members of a bucket
that have not led it and belong to different components, is searched whole:
similar texts share one of their rarest k-mers (see ``open_pairs``), so that
not all pairs of a large bucket need an alignment, and none is left out.
Classes are the connected components.

Defined results: null text is empty; texts without words are equal; texts of
fewer words than a k-mer are one k-mer; the class is named by its smallest
doc_id (null only if all are null); repeated rows are copies; extra columns
do not matter; very long texts are compared whole; an empty table gives an
empty result. At the threshold a pair of m and n > ``SHORT`` k-mers, m <= n, shares
no bucket with probability (1 - C(m, SAMPLED) / C(n, SAMPLED))^bands at most,
about 5 in a million for medium texts and for long ones, up to 9 for texts
little longer than ``MEDIUM``; k-mers are hashed to 64 bits for buckets but
compared as they are in the alignment.

At scale: one pass sketches the texts; copies are joined before anything
else, by partial aggregation; buckets are counted and led by partial
aggregates and joined back by an equi-join that AQE splits; only texts that
share a bucket are moved, compressed, to be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.bytehash import PrefixHash, mix
from pitchline.llm.common import LOWER, SPACE_RUN, SPACES, UPPER, read_documents, text_of
from pitchline.llm.components import components
from pitchline.operators.ranking import materialize

SHINGLE, THRESHOLD = 5, 0.8
BANDS, SAMPLED, SEED = 40, 6, 29
SHORT, MEDIUM, MORE = 14, 100, 60
IDLE = 2  # rounds in a row without a new link, before what is open is searched whole
CELLS = 1 << 21  # hashes worked out at a time


def normalised(text: Column) -> Column:
    """The lowered words with single spaces between them."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.btrim(F.regexp_replace(lowered, SPACE_RUN, " "), F.lit(SPACES))


def key_of(text: Column) -> Column:
    return F.md5(normalised(text))


def plain(text: bytes) -> bytes:
    """What :func:`normalised` gives, inside a task."""
    return b" ".join(text.lower().split())


# ---------------------------------------------------------------- sketches


def shingle_hashes(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-mers of a text, from the hashes of its words."""
    if 0 < len(words) < k:
        words = np.concatenate([words, np.zeros(k - len(words), np.uint64)])
    n = max(len(words) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + words[i:i + n])
    return out


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Each k-mer's hash together with its number among equal ones."""
    order = np.argsort(shingles, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = shingles[order[1:]] == shingles[order[:-1]]
    if not same.any():
        return mix(shingles)
    at = np.arange(len(order))
    number = np.empty(len(order), np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    return mix(shingles + mix(number))


def left_out(shingles: np.ndarray, threshold: float) -> np.ndarray:
    """Keys of what is left of a text when up to n * (1 - threshold) of its
    n k-mers are taken out.

    A partner of m <= n k-mers has at most n and at least n * threshold of
    them, and L = threshold / (1 + threshold) * (m + n) in common at least:
    the longer text lacks partners for n * (1 - threshold) at most, the
    shorter one for fewer than m * (1 - threshold)."""
    n, out = len(shingles), []
    for gone in range(int(n * (1 - threshold) + 1e-9) + 1):
        stay = np.array(list(combinations(range(n), n - gone)), np.int64)
        key = np.full(len(stay), mix(np.array([SEED], np.uint64))[0])
        for c in range(stay.shape[1]):
            key = mix(key + shingles[stay[:, c]])
        out.append(key)
    return np.unique(np.concatenate(out)).view(np.int64)


def keys_of(words: np.ndarray, threshold: float, bands: int = BANDS, sampled: int = SAMPLED) -> np.ndarray:
    """All bucket keys of a text."""
    shingles = shingle_hashes(words)
    n = len(shingles)
    if not 0 < n <= SHORT:
        return sketch(words, max(bands, MORE) if n <= MEDIUM else bands, sampled)
    exact = left_out(shingles, threshold)
    # all partners may be short themselves
    return exact if n <= SHORT * threshold else np.concatenate([sketch(words, max(bands, MORE), sampled), exact])


def sketch(words: np.ndarray, bands: int = BANDS, sampled: int = SAMPLED, k: int = SHINGLE) -> np.ndarray:
    """The bucket keys of a text, one for each hash function."""
    shingles = shingle_hashes(words, k)
    names = labelled(shingles)
    if not len(names):
        return np.zeros(0, np.int64)
    seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) + np.uint64(SEED))
    out = seeds.copy()
    step = max(1, CELLS // len(names))
    for a in range(0, bands, step):
        hashes = mix(names[None, :] ^ seeds[a:a + step, None])
        if len(names) > sampled:
            places = np.sort(np.argpartition(hashes, sampled - 1, axis=1)[:, :sampled], axis=1)
        else:
            places = np.broadcast_to(np.arange(len(names)), hashes.shape)
        for c in range(places.shape[1]):
            out[a:a + step] = mix(out[a:a + step] + shingles[places[:, c]])
    return out.view(np.int64)


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text with single spaces."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    return PrefixHash(data).of(starts, ends)


def sketches(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, sampled: int = SAMPLED) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text in batch.column("text").cast(pa.binary()):
                words = plain(text.as_py())
                keys.append(hashlib.md5(words).hexdigest())
                found.append(keys_of(word_hashes(words), threshold, bands, sampled))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["doc_id", "key", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, key string, bands array<long>")


# --------------------------------------------------------------- alignment


def kmers(text: bytes, k: int = SHINGLE) -> list[tuple[bytes, ...]]:
    words = text.split(b" ") if text else []
    return [tuple(words)] if 0 < len(words) < k else list(zip(*(words[i:] for i in range(k))))


def similar(a: list, b: list, threshold: float = THRESHOLD) -> bool:
    """Whether L / (len(a) + len(b) - L) reaches the threshold, for the
    longest common subsequence L of ``a`` and ``b``.

    An alignment that reaches it leaves out few elements, so that partners
    stand at most that far apart; matches outside this band are ignored."""
    both = len(a) + len(b)
    if not both:
        return True
    spare = int(both * (1 - threshold) / (1 + threshold) + 1e-9)  # elements that may stay without partner
    if abs(len(a) - len(b)) > spare:
        return False
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if len(a) + len(b) <= spare:
        return True
    # no subsequence is longer than what the texts have in common in any order
    places: dict = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    left = {x: len(p) for x, p in places.items()}
    common = 0
    for x in b:
        if left.get(x):
            left[x] -= 1
            common += 1
    if len(a) + len(b) - 2 * common > spare:
        return False
    masks = {x: sum(1 << i for i in p) for x, p in places.items()}
    ones = (1 << len(a)) - 1
    row = ones  # zero bits mark where the common subsequence grows
    for j, x in enumerate(b):
        match = masks.get(x, 0)
        if match:
            low = max(0, j - spare)
            match = (match >> low & ((1 << (j + spare + 1 - low)) - 1)) << low
            hit = row & match
            row = ((row + hit) | (row - hit)) & ones
    return len(a) + len(b) - 2 * (len(a) - row.bit_count()) <= spare


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are near duplicates, with the
    labels (ca, cb) that come with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in batches:
            out = []
            for i, (a, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "x", "y")))):
                if a != last:
                    last, parts = a, kmers(unpack(x))
                if similar(parts, kmers(unpack(y)), threshold):
                    out.append(i)
            yield batch.select(["a", "b", "ca", "cb"]).take(pa.array(out, pa.int64()))

    left = texts.select(F.col("node").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("packed").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ca", "cb", "x", "y").mapInArrow(
        run, "a long, b long, ca long, cb long")


def unpack(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def packed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed text) of ``nodes`` (key, doc_id, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [plain(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            keys = [hashlib.md5(w).hexdigest() for w in words]
            data = [len(w).to_bytes(8, "little") + (pa.compress(w, "zstd", asbytes=True) if w else b"") for w in words]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.string()), pa.array(data, pa.binary())],
                                             ["doc_id", "key", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, key string, packed binary")
    wanted = nodes.select(F.col("key").alias("_key"), F.col("doc_id").alias("_doc"), "node")
    found = rows.join(wanted, (rows["key"] == wanted["_key"]) & rows["doc_id"].eqNullSafe(wanted["_doc"]))
    return found.groupBy("_key", "_doc").agg(F.first("node").alias("node"), F.first("packed").alias("packed")).select(
        "node", "packed")


# ------------------------------------------------------------------ classes


def spread(links: DataFrame, steps: int = 3) -> DataFrame:
    """(comp, to) of the labels in ``links`` (a, b): the least label within
    ``steps`` + 1 links."""
    around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
    for _ in range(steps):
        least = around.join(least.select(F.col("a").alias("b"), "to"), "b").groupBy("a").agg(
            F.least(F.min("to"), F.col("a")).alias("to"))
    return least.select(F.col("a").alias("comp"), "to")


def open_pairs(rest: DataFrame, packed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of the pairs of ``rest`` (band, node, comp) that share a bucket but no
    component, those (a, b, ca, cb) that can reach the threshold.

    Similar texts of m and n k-mers have c = threshold / (1 + threshold) *
    (m + n) labelled k-mers in common. Sorted from the rarest on, the first
    common one then has at most m - c others before it in one text and n - c
    in the other; pairs without such a k-mer are not similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("packed").to_pylist()):
                names = labelled(shingle_hashes(word_hashes(unpack(data)))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), node, np.int64)), pa.array(names)], ["node", "name"])

    members = materialize(rest.groupBy("node").agg(F.first("comp").alias("comp"), F.collect_list("band").alias("bands")), "open")
    names = materialize(packed.join(members.select("node"), "node").select("node", "packed").mapInArrow(
        run, "node long, name long"), "names")
    # a k-mer of one text only joins nothing, but counts as a place
    held = names.groupBy("name").agg(F.count(F.lit(1)).alias("df"))
    ordered = names.join(held, "name").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "name"))).alias("names"))
    m = F.size("names")
    # no partner has fewer than threshold * m
    prefix = F.slice("names", F.lit(1), (m - F.ceil(m * threshold - 1e-9) + 1).cast("int"))
    keyed = ordered.select("node", m.alias("m"), F.posexplode(prefix).alias("at", "k")).where("k.df > 1").select(
        "node", "m", "at", F.col("k.name").alias("name"))
    keyed = materialize(keyed.join(members.select("node", "comp"), "node"), "prefixes")
    left = keyed.select("name", *(F.col(c).alias(f"{c}_a") for c in ("node", "m", "at", "comp")))
    right = keyed.select("name", *(F.col(c).alias(f"{c}_b") for c in ("node", "m", "at", "comp")))
    common = (F.col("m_a") + F.col("m_b")) * (threshold / (1 + threshold)) - 1e-6
    met = left.join(right, (left["name"] == right["name"]) & (F.col("node_a") < F.col("node_b")) & (
        F.col("comp_a") != F.col("comp_b")) & (F.least(F.col("m_a") - F.col("at_a"), F.col("m_b") - F.col("at_b")) >= common))
    met = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("comp_a").alias("ca"), F.col("comp_b").alias("cb")).distinct()
    bands = members.select("node", "bands")
    met = met.join(bands.select(F.col("node").alias("a"), F.col("bands").alias("x")), "a").join(
        bands.select(F.col("node").alias("b"), F.col("bands").alias("y")), "b")
    return met.where(F.arrays_overlap("x", "y")).select("a", "b", "ca", "cb")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, sampled: int = SAMPLED) -> DataFrame:
    """(doc_id, key, first, class_id, class_key) of each row: ``key`` names
    its words and ``first`` is the least doc_id that has them; the class is
    named by its least doc_id and the key of that."""
    rows, named = named_texts(docs, threshold, bands, sampled)
    return rows.select("doc_id", "key").join(named, "key").select("doc_id", "key", "first", "class_id", "class_key")


def named_texts(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, sampled: int = SAMPLED) -> tuple[DataFrame, DataFrame]:
    """The rows with their keys, and the class of each key once."""
    rows = materialize(sketches(docs, threshold, bands, sampled), "sketches")
    texts = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    texts = materialize(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    sent = texts.select("node", F.explode("bands").alias("band"))
    counted = materialize(sent.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bands")
    members = materialize(sent.join(counted, "band"), "members")
    # the more texts share a text's buckets, the more likely they are its copies
    central = members.groupBy("node").agg(F.sum("n").alias("central"))
    nodes = texts.join(members.select("node").distinct(), "node").select("key", F.col("first").alias("doc_id"), "node")
    packed = materialize(packed_texts(docs, nodes), "packed")

    # within the rounds a component is known by the least label that has
    # reached it so far: that only spares comparisons
    state = materialize(members.select("band", "node").join(central, "node").select(
        "band", "node", "central", F.col("node").alias("comp"), F.lit(False).alias("linked")), "state")
    links = led = None
    idle = 0
    ended = False
    while idle < IDLE:
        if led is None:  # originals lead as many buckets as possible
            free, first = state, F.struct(-F.col("central"), "node")
        else:  # texts that have not led the bucket, linked ones first, others in each bucket
            free, first = state.join(led, ["band", "node"], "left_anti"), F.struct(F.xxhash64("node", "band"), "node")
        several = state.groupBy("band").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").select("band")
        leaders = free.groupBy("band").agg(F.min(F.struct(
            (~F.col("linked")).alias("alone"), first.alias("h"), F.col("node").alias("a"), F.col("comp").alias("ca"))).alias("lead"))
        leaders = materialize(leaders.join(several, "band").select("band", "lead.a", "lead.ca"), "leaders")
        pairs = state.join(leaders, "band").where(F.col("comp") != F.col("ca")).groupBy("a", F.col("node").alias("b")).agg(
            F.first("ca").alias("ca"), F.first("comp").alias("cb"))
        new = materialize(verified(materialize(pairs, "pairs"), packed, threshold), "verified")
        done = leaders.select("band", F.col("a").alias("node"))
        led = done if led is None else led.unionByName(done)
        if leaders.isEmpty():
            ended = True
            break
        if new.isEmpty():
            idle += 1
            continue
        idle = 0
        links = new if links is None else links.unionByName(new)
        moves = spread(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        hit = new.select(F.col("a").alias("node")).unionByName(new.select(F.col("b").alias("node"))).distinct()
        state = materialize(state.join(moves, "comp", "left").join(hit.withColumn("hit", F.lit(True)), "node", "left").select(
            "band", "node", "central", F.least("comp", "to").alias("comp"),
            (F.col("linked") | F.col("hit").isNotNull()).alias("linked")), "state")

    if not ended:  # what no leader has met
        free = state.join(led, ["band", "node"], "left_anti").select("band", "node", "comp")
        several = free.groupBy("band").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").select("band")
        rest = materialize(free.join(several, "band"), "rest")
        if not rest.isEmpty():
            new = materialize(verified(materialize(open_pairs(rest, packed, threshold), "pairs"), packed, threshold), "verified")
            links = new if links is None else links.unionByName(new)

    comps = None if links is None else materialize(components(links), "components")
    named = texts.select("key", "first", "node")
    if comps is None:
        named = named.withColumn("class_id", F.col("first")).withColumn("class_key", F.col("key"))
    else:
        least = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key"))
        whole = materialize(named.join(comps, "node").groupBy("comp").agg(least.alias("m")).select("comp", "m"), "classes")
        found = materialize(comps.join(whole, "comp").select("node", "m"), "found")
        named = named.join(found, "node", "left").select(
            "key", "first", F.coalesce("m.first", "first").alias("class_id"), F.coalesce("m.key", "key").alias("class_key"))
    return rows, materialize(named.select("key", "first", "class_id", "class_key"), "named")


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that of the
    class's least doc_id."""
    _, named = named_texts(docs, threshold)
    kept = named.where(F.col("key") == F.col("class_key")).select(F.col("key").alias("_key"), F.col("class_id").alias("_doc"))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", key_of(text_of()).alias("key"))
    rows = rows.join(kept, (rows["key"] == kept["_key"]) & rows["doc_id"].eqNullSafe(kept["_doc"]))
    # repeated rows have their keys in common: one of them stays
    return rows.groupBy("_key", "_doc").agg(F.first("_row").alias("_row")).select("_row.*")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read_documents(spark, sf_dir)).select("doc_id", "class_id")
