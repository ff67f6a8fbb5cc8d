"""Operator 8, host-level quality rules, in DataFrame functions only.

Every document is measured against a few rules. The failures of each rule
are added up by host (``documents.source``), the host's rate is shrunk to
an empirical beta prior (fitted to all hosts by their moments), and the
verdict is joined back: a document is dropped if it fails a base rule, or
if it fails a rule that its host fails as a rule, that is with a shrunk
rate above ``max_rate``. A document that passes every rule is always kept,
whatever its host.

Defined results: null text is empty (no words, base rules fail); null and
empty hosts are one host; repeated rows are judged one by one; extra
columns stay untouched in :func:`filter_documents`; an empty table gives an
empty result.

At scale: the measures need one pass over the text and no shuffle; they are
written (a few numbers a document) to the checkpoint folder. Hosts are
aggregated with partial sums, so a hot host sends one row a task; the join
back is a plain equi-join, whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import SPACE_RUN, SPACES, read_documents, text_of
from pitchline.operators.ranking import materialize

SYMBOLS = "#*$%&|<>"
MAX_RATE = 0.5


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def measures(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Per row: doc_id, host and the counts that the rules need; with
    ``carry`` also the whole row, as the struct ``row``."""
    spaces = F.lit(SPACES)
    row = [F.struct("*").alias("row")] if carry else []
    keep = ["row"] if carry else []
    df = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("host"),
                     text_of().alias("text"), *row)
    df = df.withColumn("trimmed", F.btrim("text", spaces))
    df = df.select(
        "doc_id", "host", *keep,
        F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("trimmed", SPACE_RUN)).alias("words"),
        _length_without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.length("text") - _length_without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, spaces) != "").alias("lines"))
    df = df.select(
        "*", F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows")).drop("lines", "words")
    # only texts in which some window repeats go on; sorted by window, equal ones stand together
    df = df.withColumn("order", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def beside(e: Column, j: Column) -> Column:
        return F.coalesce(F.get("order", j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(
            F.get("order", j + 1)["h"] == e["h"], F.lit(False))

    df = df.withColumn("starts", F.sort_array(F.transform(F.filter("order", beside), lambda e: e["i"])))
    # a repeated window covers three words, fewer if the next one starts before its end
    covered = F.aggregate(
        F.zip_with(F.slice("starts", 1, F.size("starts") - 1), F.slice("starts", 2, F.size("starts") - 1),
                   lambda a, b: F.least(b - a, F.lit(3))), F.lit(3), lambda s, x: s + x)
    return df.select(*keep, "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                     F.coalesce(F.when(F.size("starts") > 0, covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Rules that count only where the host fails them as a rule."""
    return {
        "symbols": F.col("n_symbols") * 10 > F.col("n_words"),
        "lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        "word_length": (F.col("word_chars") < F.col("n_words") * 3) | (F.col("word_chars") > F.col("n_words") * 10),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row a host: its documents and, for each rule, failures, shrunk
    rate and verdict.

    The prior of a rule is the beta distribution with the mean m and the
    variance v of the hosts' rates, less what sampling adds to v; its weight
    is m(1-m)/v - 1 documents, from 1 to 1,000,000.
    """
    names = list(rules())
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.sum(c.cast("long")).alias(f"n_{k}") for k, c in rules().items()))
    # one row of moments: the driver holds three numbers a rule
    rate = {k: F.col(f"n_{k}") / F.col("n_docs") for k in names}
    row = hosts.agg(F.avg(1 / F.col("n_docs")).alias("inverse"),
                    *(F.avg(rate[k]).alias(f"m_{k}") for k in names),
                    *(F.var_pop(rate[k]).alias(f"v_{k}") for k in names)).first()
    for k in names:
        m = row[f"m_{k}"] or 0.0
        spread = m * (1 - m)
        v = max((row[f"v_{k}"] or 0.0) - spread * (row["inverse"] or 0.0), 0.0)
        weight = min(max(spread / v - 1 if v else 1e6, 1.0), 1e6)
        shrunk = (F.col(f"n_{k}") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
        hosts = hosts.withColumn(f"rate_{k}", shrunk).withColumn(f"bad_{k}", shrunk > max_rate)
    return hosts


def _dropped() -> Column:
    out = base_failed()
    for k, c in rules().items():
        out = out | (c & F.col(f"bad_{k}"))
    return out


def judge(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """Measures, base verdict and final verdict of every row of ``docs``."""
    measured = materialize(measures(docs), "quality")
    verdicts = host_verdicts(measured, max_rate).select("host", *(f"bad_{k}" for k in rules()))
    return (measured.join(verdicts, "host")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), (~_dropped()).alias("kept"), "host"))


def filter_documents(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and no
    others. Rows that fail no rule need no verdict of their host, so only
    the doubtful ones, which fail a host rule, meet the table of hosts."""
    verdicts = host_verdicts(materialize(measures(docs), "quality"), max_rate)
    verdicts = verdicts.select("host", *(f"bad_{k}" for k in rules()))
    doubtful = F.lit(False)
    for c in rules().values():
        doubtful = doubtful | c
    # the id keeps the filters behind the measures, which would otherwise be
    # worked out anew inside each of their own loops
    rows = measures(docs, carry=True).withColumn("at", F.monotonically_increasing_id())
    rows = rows.where(~base_failed() & (F.col("at") >= 0))
    doubtful = doubtful & (F.col("at") >= 0)
    clean = rows.where(~doubtful).select("row.*")
    return clean.unionByName(rows.where(doubtful).join(verdicts, "host").where(~_dropped()).select("row.*"))


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_documents(spark, sf_dir))
