"""Quality suites (FIXTURES A10): empty table, duplicates, range, format;
one aggregate pass per suite."""

from pitchline.plans import quality as Q


def results(df):
    return {(r.expectation_type, r.column): r for r in df.collect()}


def test_suite_on_fixture(spark):
    df = spark.createDataFrame(
        [("1", 5, "2024-01-02"), ("2", None, "2024-13-40"), ("2", 120, None), ("4", 7, "bad")],
        "id string, score int, date string")
    suite = [Q.row_count_between(1, 3), Q.column_exists("id"), Q.column_exists("data.id"),
             Q.not_null("score"), Q.completeness("score", 0.7), Q.in_range("score", 0, 100),
             Q.matches_format("date", "yyyy-MM-dd"), Q.unique("id")]
    r = results(Q.run_suite(df, "s", suite))
    assert r[(Q.ROW_COUNT_BETWEEN, None)].success is False
    assert r[(Q.ROW_COUNT_BETWEEN, None)].observed == 4.0
    assert r[(Q.COLUMN_EXISTS, "id")].success and not r[(Q.COLUMN_EXISTS, "data.id")].success
    assert r[(Q.NOT_NULL, "score")].unexpected_count == 1
    assert r[(Q.COMPLETENESS, "score")].observed == 0.75 and r[(Q.COMPLETENESS, "score")].success
    assert r[(Q.IN_RANGE, "score")].unexpected_count == 1
    assert r[(Q.MATCHES_FORMAT, "date")].unexpected_count == 2
    assert r[(Q.UNIQUE, "id")].unexpected_count == 2 and not r[(Q.UNIQUE, "id")].success
    summary = Q.suite_summary(Q.run_suite(df, "s", suite)).first()
    assert (summary.evaluated_expectations, summary.successful_expectations) == (8, 2)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string, score int")
    r = results(Q.run_suite(df, "s", [Q.row_count_between(1, 100), Q.completeness("score"),
                                      Q.not_null("id")]))
    assert r[(Q.ROW_COUNT_BETWEEN, None)].success is False
    assert r[(Q.COMPLETENESS, "score")].success is False
    assert r[(Q.COMPLETENESS, "score")].observed is None
    assert r[(Q.NOT_NULL, "id")].success is True


def test_one_aggregate_pass(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as a", "cast(id as string) as s")
    suite = [Q.row_count_between(1, 10_000), Q.not_null("a"), Q.completeness("s"),
             Q.in_range("a", 0, 5), Q.matches_regex("s", "^[0-9]+$")]
    plan = Q.run_suite(df, "s", suite)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_validate_unknown_entity(spark):
    df = spark.createDataFrame([("1",)], "x string")
    r = Q.validate(df, "team_info").first()
    assert r.success is False and r.expectation_type == "unknown_entity"


def test_ddl_violations(spark):
    df = spark.createDataFrame([("a" * 25, "ok", 1234.5), (None, "x" * 101, 12.345)],
                               "player_id string, player_name string, bmi double")
    v = {(r.column, r.rule): r.violations for r in Q.ddl_violations(
        df, "dim_players", ["player_id", "player_name"], {"player_id": 20, "player_name": 100},
        {"bmi": (5, 2)}).collect()}
    assert v == {("player_id", "not_null"): 1, ("player_name", "not_null"): 0,
                 ("player_id", "varchar(20)"): 1, ("player_name", "varchar(100)"): 1,
                 ("bmi", "decimal(5,2)"): 1}
