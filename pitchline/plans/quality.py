"""Data-quality suites as Spark aggregates (J: Q1-Q12, E6).

A suite is a list of expectations. :func:`run_suite` evaluates **all
expectations of a suite in ONE aggregate pass** over the data (each
contributes a few conditional counts, taken per key first where uniqueness
is asked for; the map-side partial counts reduce a hot key where it sits)
and turns the single result row into one row per expectation with
``inline``. :func:`write_checked` takes the same counts while a table is
written, and sets failing rows apart.

Result schema (one row per expectation)::

    suite, expectation_type, column, success, observed, unexpected_count,
    element_count, details
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = ("suite string, expectation_type string, column string, success boolean, observed double, "
          "unexpected_count bigint, element_count bigint, details string")

# Expectation type names of the validation suites.
ROW_COUNT_BETWEEN = "expect_table_row_count_to_be_between"
COLUMN_EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
COMPLETENESS = "expect_column_values_completeness_at_least"
IN_RANGE = "expect_column_values_to_be_between"
MATCHES_FORMAT = "expect_column_values_to_match_format"
MATCHES_REGEX = "expect_column_values_to_match_regex"
UNIQUE = "expect_compound_columns_to_be_unique"


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    kwargs: dict = field(default_factory=dict)

    @property
    def details(self) -> str:
        return ",".join(f"{k}={v}" for k, v in self.kwargs.items())


def row_count_between(lo: int, hi: int) -> Expectation:
    return Expectation(ROW_COUNT_BETWEEN, None, {"min_value": lo, "max_value": hi})


def column_exists(path: str) -> Expectation:
    return Expectation(COLUMN_EXISTS, path)


def not_null(col: str) -> Expectation:
    return Expectation(NOT_NULL, col)


def completeness(col: str, threshold: float = 0.95) -> Expectation:
    return Expectation(COMPLETENESS, col, {"threshold": threshold})


def in_range(col: str, lo: float | None = None, hi: float | None = None) -> Expectation:
    return Expectation(IN_RANGE, col, {"min_value": lo, "max_value": hi})


def matches_format(col: str, fmt: str) -> Expectation:
    """A datetime pattern (Spark ``to_timestamp`` syntax)."""
    return Expectation(MATCHES_FORMAT, col, {"format": fmt})


def matches_regex(col: str, regex: str) -> Expectation:
    return Expectation(MATCHES_REGEX, col, {"regex": regex})


def unique(*cols: str) -> Expectation:
    return Expectation(UNIQUE, ",".join(cols))


def has_path(schema: T.StructType, path: str) -> bool:
    """Does a dotted path exist in the schema (structs only)? No job runs."""
    node: T.DataType = schema
    for part in path.split("."):
        if isinstance(node, T.StructType) and part in node.fieldNames():
            node = node[part].dataType
        else:
            return False
    return True


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _result(e: Expectation, suite: str, success: Column, observed: Column,
            unexpected: Column, elements: Column) -> Column:
    return F.struct(F.lit(suite).alias("suite"), F.lit(e.kind).alias("expectation_type"),
                    F.lit(e.column).cast("string").alias("column"),
                    success.cast("boolean").alias("success"),
                    observed.cast("double").alias("observed"),
                    unexpected.cast("bigint").alias("unexpected_count"),
                    elements.cast("bigint").alias("element_count"),
                    F.lit(e.details).alias("details"))


def _bad_row(e: Expectation) -> Column | None:
    """Whether a row breaks the expectation; None for those on whole tables."""
    c = F.col(e.column) if e.column else None
    if e.kind == NOT_NULL:
        return c.isNull()
    if e.kind == IN_RANGE:
        lo, hi = e.kwargs["min_value"], e.kwargs["max_value"]
        out = F.lit(False)
        if lo is not None:
            out = out | (c < lo)
        if hi is not None:
            out = out | (c > hi)
        return c.isNotNull() & out
    if e.kind == MATCHES_FORMAT:
        text = c.cast("string")
        return text.isNotNull() & F.try_to_timestamp(text, F.lit(e.kwargs["format"])).isNull()
    if e.kind == MATCHES_REGEX:
        text = c.cast("string")
        return text.isNotNull() & ~text.rlike(e.kwargs["regex"])
    return None


def measures(expectations: Sequence[Expectation]) -> list[Column]:
    """The counts that a suite needs, of any part of the rows; counts of
    parts add up."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(expectations):
        bad = _bad_row(e)
        if bad is not None:
            aggs.append(_count_if(bad).alias(f"_a{i}"))
        if e.kind in (COMPLETENESS, IN_RANGE, MATCHES_FORMAT, MATCHES_REGEX):
            aggs.append(F.count(F.col(e.column)).alias(f"_a{i}n"))
    return aggs


def report(counts: DataFrame, schema: T.StructType, suite: str, expectations: Sequence[Expectation],
           duplicates: dict[str, Column]) -> DataFrame:
    """One row per expectation from the one row of :func:`measures`;
    ``duplicates``: the rows that share each key of a uniqueness check."""
    results = []
    n = F.col("_n")
    for i, e in enumerate(expectations):
        bad, known = F.col(f"_a{i}"), F.col(f"_a{i}n")
        if e.kind == ROW_COUNT_BETWEEN:
            lo, hi = e.kwargs["min_value"], e.kwargs["max_value"]
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (n >= lo)
            if hi is not None:
                ok = ok & (n <= hi)
            results.append(_result(e, suite, ok, n, F.lit(None), n))
        elif e.kind == COLUMN_EXISTS:
            ok = has_path(schema, e.column)
            results.append(_result(e, suite, F.lit(ok), F.lit(None), F.lit(None), F.lit(None)))
        elif e.kind == NOT_NULL:
            results.append(_result(e, suite, bad == 0, F.when(n > 0, bad / n), bad, n))
        elif e.kind == COMPLETENESS:
            frac = F.when(n > 0, known / n)
            ok = F.coalesce(frac >= F.lit(e.kwargs["threshold"]), F.lit(False))
            results.append(_result(e, suite, ok, frac, n - known, n))
        elif e.kind in (IN_RANGE, MATCHES_FORMAT, MATCHES_REGEX):
            results.append(_result(e, suite, bad == 0, F.when(known > 0, bad / known), bad, n))
        elif e.kind == UNIQUE:
            dup = duplicates[e.column]
            results.append(_result(e, suite, dup == 0, F.when(n > 0, dup / n), dup, n))
        else:
            raise ValueError(f"unknown expectation {e.kind}")
    if not results:
        return counts.sparkSession.createDataFrame([], RESULT)
    return counts.select(F.inline(F.array(*results)))


def _duplicates(df: DataFrame, key: str) -> Column:
    """Rows that share their key with another, as a scalar subquery."""
    return (df.groupBy(*key.split(",")).agg(F.count(F.lit(1)).alias("_c"))
            .where(F.col("_c") > 1).select(F.coalesce(F.sum("_c"), F.lit(0))).scalar())


def run_suite(df: DataFrame, suite: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Evaluate a suite; returns one row per expectation (see module doc).

    All counts come from one pass. With a uniqueness check they are taken
    for each key first (the partial counts of the keys add up to those of the
    table), so that check needs no pass of its own; further uniqueness checks
    take one each."""
    aggs = measures(expectations)
    keys = list(dict.fromkeys(e.column for e in expectations if e.kind == UNIQUE))
    if not keys:
        return report(df.agg(*aggs), df.schema, suite, expectations, {})
    names = [f"_a{i}{x}" for i, e in enumerate(expectations) for x in ("", "n")]
    per_key = df.groupBy(*keys[0].split(",")).agg(*aggs)
    names = ["_n", *(x for x in names if x in per_key.columns)]
    one = per_key.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("_dup"),
                      *(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names))
    return report(one, df.schema, suite, expectations, {keys[0]: F.col("_dup")} | {k: _duplicates(df, k) for k in keys[1:]})


# Where the rows of a checked table lie, and what they broke.
STATE, PASSED, QUARANTINED, BROKEN = "quality_state", "passed", "quarantined", "broken_rules"


def marked(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[DataFrame, Observation]:
    """The rows with what they broke and their state, and the counts of the
    suite, taken while the rows pass by."""
    seen = Observation()
    rules = [(f"{e.kind}({e.column})", bad) for e in expectations if (bad := _bad_row(e)) is not None]
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules))) if rules else F.array().cast("array<string>")
    rows = df.observe(seen, *measures(expectations)).withColumn(BROKEN, broken)
    return rows.withColumn(STATE, F.when(F.size(BROKEN) > 0, F.lit(QUARANTINED)).otherwise(F.lit(PASSED))), seen


def write_checked(df: DataFrame, path: str, suite: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Write a table and evaluate its suite in the same pass (Q4, Q12).

    The counts are taken by ``observe`` while the rows are written; rows that
    break an expectation on rows go to the partition ``quarantined`` of the
    table, with the names of what they broke, all others to ``passed``
    (:func:`passed` reads those alone). Uniqueness is checked on the key
    columns of what was written. Returns the report; the counts are those of
    all rows, as :func:`run_suite` gives them."""
    spark = df.sparkSession
    rows, seen = marked(df, expectations)
    rows.write.mode("overwrite").option("compression", "snappy").partitionBy(STATE).parquet(path)
    counts = spark.createDataFrame([seen.get])
    schema = T.StructType([*df.schema.fields, T.StructField(BROKEN, T.ArrayType(T.StringType())), T.StructField(STATE, T.StringType())])
    written = spark.read.schema(schema).parquet(path)
    keys = {e.column: _duplicates(written, e.column) for e in expectations if e.kind == UNIQUE}
    return report(counts, df.schema, suite, expectations, keys)


def passed(table: DataFrame) -> DataFrame:
    """The rows of a checked table that broke nothing (all, if it was written
    without a check)."""
    return table.where(F.col(STATE) == PASSED).drop(STATE, BROKEN) if STATE in table.columns else table


def suite_summary(results: DataFrame) -> DataFrame:
    """Suite statistics: success, evaluated, successful, failed, percent."""
    ok = F.col("success")
    return results.groupBy("suite").agg(
        F.bool_and(F.coalesce(ok, F.lit(False))).alias("success"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count(F.when(ok, 1)).alias("successful_expectations"),
        F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias("unsuccessful_expectations"),
        (F.count(F.when(ok, 1)) * 100.0 / F.count(F.lit(1))).alias("success_percent"))


# The suites of the validation service (row-count bounds and
# required fields per entity), keyed by entity name.
SUITES: dict[str, list[Expectation]] = {
    "standings": [row_count_between(1, 100), column_exists("group_id"),
                  column_exists("group_name"), not_null("group_id")],
    "teams": [row_count_between(1, 50), column_exists("team_id"), column_exists("team_name"),
              not_null("team_id"), not_null("team_name")],
    "athletes": [row_count_between(1, 1000), column_exists("athlete_id"), not_null("athlete_id")],
}

# Rules of the quality configuration.
COMPLETENESS_THRESHOLD = 0.95


def validate(df: DataFrame, entity: str) -> DataFrame:
    """Pick the suite by entity (Q5). An unknown entity yields one failed
    result row instead of an exception."""
    if entity not in SUITES:
        return df.sparkSession.createDataFrame([(entity, "unknown_entity", None, False, None, None, None,
                                                 "Unknown data type")], RESULT)
    return run_suite(df, entity, SUITES[entity])


def ddl_violations(df: DataFrame, table: str, not_null_cols: Sequence[str],
                   varchar: dict[str, int], decimals: dict[str, tuple[int, int]]) -> DataFrame:
    """Q11: rows breaking the warehouse DDL contract, per column and rule,
    in one aggregate pass: NOT NULL, VARCHAR(n) length, DECIMAL(p,s) range
    (a value that does not fit becomes NULL under ``try_cast``)."""
    cols = set(df.columns)
    checks: list[tuple[str, str, Column]] = []
    for c in not_null_cols:
        if c in cols:
            checks.append((c, "not_null", F.col(c).isNull()))
    for c, n in varchar.items():
        if c in cols:
            checks.append((c, f"varchar({n})", F.octet_length(F.col(c).cast("string")) > n))
    for c, (p, s) in decimals.items():
        if c in cols:
            checks.append((c, f"decimal({p},{s})",
                           F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()))
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        _count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(checks)]
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column"),
                     F.lit(rule).alias("rule"), F.col(f"_v{i}").cast("bigint").alias("violations"),
                     F.col("_n").cast("bigint").alias("element_count"))
            for i, (c, rule, _) in enumerate(checks)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
