"""Operator 1, secret scan with a password guess-cost model.

Base spans come from three fixed patterns. The method looks at the values
that stand in a credential context (``pwd: value``, ``login = value``, a
URL's ``user:value@``) and estimates how many guesses an attacker needs for
each: the cheapest segmentation into dictionary words, dates, repeats,
keyboard walks and brute-force spans, found by dynamic programming over the
end positions. Values that cost at least 10^``MIN_LOG10`` guesses are
reported as ``guess`` spans; base spans always stay.

Defined results: null text is empty (no spans); ties between spans that
start together go by the order of the kinds; repeated rows are scanned one
by one; very long texts and values are scanned whole (the segmentation is
linear in the value's length); an empty table gives an empty result; other
columns are not read by the scan, and left as they are by the redaction.

At scale: one pass in the scan's own tasks, no shuffle; a text is in memory
with its batch only.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import read_documents, text_of

KINDS = ("assign", "access", "hex", "guess")
#: The base patterns with the least length that counts.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Where a credential's value may stand: after one of these names, or as the password of a URL.
CONTEXT = re.compile(
    r"""(?ai:passphrase|password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential|bearer|login|auth)"""
    r"""["']?\x20*[:=]\x20*["']?([!-~]+)|://[!-.0-9;-~]*:([!-.0-?A-~]+)@""")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "login", "auth", "://")
CLOSERS = "\"'`,;)]}>"
MIN_VALUE, MIN_LOG10 = 8, 9.0

#: Words that passwords are made of, by falling frequency.
WORDS = (
    "password admin letmein welcome login user master hello monkey dragon qwerty abc shadow test secret root "
    "love sunshine princess football baseball iloveyou trustno starwars superman batman freedom whatever "
    "michael jordan hunter summer winter spring autumn flower cheese computer internet server office company "
    "access account change default demo example guest home house house key manager my new old open pass people "
    "private public service site system temp time token top toor value web work world the and for you not are "
    "this that with have from they will your all can had her was one our out day get has him how man now see two "
    "way who boy did its let put say she too use").split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LONGEST_WORD = max(map(len, RANK))
LEET = str.maketrans("430157@$!", "aeoistasi")
#: The rows of a keyboard.
KEYS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_AT = {c: (y, x) for y, row in enumerate(KEYS) for x, c in enumerate(row)}
DATES = [re.compile(p, re.ASCII) for p in (
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])",
    r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d",
    r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1\d\d", r"(?:19|20)\d\d")]


def _class_size(c: str) -> int:
    if c in "0123456789":
        return 10
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return 26
    return 33 if c < "\x7f" else 100


def _adjacent(a: str, b: str) -> bool:
    p, q = _AT.get(a), _AT.get(b)
    return bool(p and q and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)


def guess_cost(value: str, enough: float = math.inf) -> float:
    """log10 of the guesses for the cheapest segmentation of ``value``, or
    something from ``enough`` on, if that is not less.

    Costs of the segments, in guesses: a dictionary word its rank (times 2
    with capitals, times 2 with look-alike digits), a date the days of 200
    years, a keyboard walk of three keys or more 50 starts times 3 per step,
    a repeat (three characters or more) the cost of its unit by brute force
    times the repetitions, anything else the size of its character class per
    character. Each further segment doubles the guesses.

    A unit of ``u`` characters costs 10^u guesses at least, so units longer
    than ``enough`` need no look, and the time is linear in the value.
    """
    n = len(value)
    lower = "".join(c.lower() if c.isascii() else c for c in value)
    plain = lower.translate(LEET)
    found: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: start and cost
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = RANK.get(lower[i:j]) or 2 * RANK.get(plain[i:j], 0)
            if rank:
                found[j].append((i, math.log10(rank * (1 + (value[i:j] != lower[i:j])))))
        for pattern in DATES:
            m = pattern.match(value, i)
            if m:
                found[m.end()].append((i, math.log10(200 * (366 if m.end() - i > 4 else 1))))
    again, step = math.log10(2), math.log10(3)
    longest = n // 2 if enough == math.inf else min(n // 2, int(enough))
    sizes = [0.0]  # brute-force cost of the first characters
    for c in value:
        sizes.append(sizes[-1] + math.log10(_class_size(c)))
    best = [0.0] + [math.inf] * n  # the cheapest way to each end
    brute = walk = math.inf  # the cheapest ways that end in an open brute-force span, or walk of three
    one = two = math.inf  # those in a walk of one and of two keys
    repeats = [Repeats(u) for u in range(1, longest + 1)]
    for j in range(1, n + 1):
        start = best[j - 1] + (again if j > 1 else 0)
        brute = min(brute, start) + sizes[j] - sizes[j - 1]
        if j > 1 and _adjacent(lower[j - 2], lower[j - 1]):
            walk, two = min(walk, two) + step, one + step
        else:
            walk = two = math.inf
        one = start + math.log10(50)
        cheapest = min(brute, walk)
        for i, c in found[j]:
            cheapest = min(cheapest, best[i] + c + (again if i else 0))
        for r in repeats:
            if r.extend(value, j):
                cheapest = min(cheapest, r.cheapest(best, j, again) + sizes[j] - sizes[j - r.unit])
        best[j] = cheapest
    return best[n]


class Repeats:
    """Where repeats of units of one length may have begun."""

    def __init__(self, unit: int):
        self.unit, self.alike = unit, 0
        self.least = 2 * unit if unit > 1 else 3  # characters of the shortest repeat
        self.starts: dict[int, list[int]] = {}  # by place modulo the unit

    def extend(self, value: str, j: int) -> bool:
        """Take the character before ``j``; whether a repeat may end there."""
        if j > self.unit and value[j - 1] == value[j - 1 - self.unit]:
            self.alike += 1
        else:
            self.alike = 0
            self.starts.clear()
        return self.alike + self.unit >= self.least

    def cheapest(self, best: list[float], j: int, again: float) -> float:
        """Without the cost of the unit. A later start is kept only if it is
        cheaper at its first end: the lead of an earlier one never shrinks."""
        def cost(i: int) -> float:
            return best[i] + (again if i else 0) + math.log10((j - i) // self.unit)

        starts = self.starts.setdefault(j % self.unit, [])
        here = min(map(cost, starts), default=math.inf)
        new = cost(j - self.least)
        if new < here:
            starts.append(j - self.least)
            here = new
        return here


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base patterns, in order."""
    out = []
    folded = text.lower()
    if any(h in folded for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def guess_spans(text: str, taken: list[tuple[int, int, int]], min_log10: float = MIN_LOG10) -> list[tuple[int, int, int]]:
    """Credential values outside the base spans that are hard to guess."""
    folded = text.lower()
    if not any(h in folded for h in CONTEXT_HINTS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        g = 1 if m.group(1) is not None else 2
        start, end = m.span(g)
        while end > start and text[end - 1] in CLOSERS:
            end -= 1
        if end - start < MIN_VALUE or any(s < end and start < e for s, _, e in taken):
            continue
        if guess_cost(text[start:end], min_log10) >= min_log10:
            out.append((start, 3, end))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, min_log10: float = MIN_LOG10) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all
    spans as text, for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                spans = sorted(base + guess_spans(text, base, min_log10))
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, min_log10: float = MIN_LOG10) -> str:
    """``text`` with ``[kind]`` in place of each span; of overlapping spans
    the first names the kind."""
    base = base_spans(text)
    parts, at = [], 0
    for s, k, e in sorted(base + guess_spans(text, base, min_log10)):
        if s >= at:
            parts += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, min_log10: float = MIN_LOG10) -> DataFrame:
    """``docs`` with the secrets taken out of ``text``; ``n_chars``, if there,
    follows the new text. Other columns, and null texts, stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t if t is None else redacted(t, min_log10) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(texts, batch.schema.field(at).type), *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_documents(spark, sf_dir))
