"""Athlete fixtures (FIXTURES A3): bad numbers, nulls, age-group bounds."""

from pyspark.sql import types as T

from pitchline.functions import exprs as X
from pitchline.plans import gold

TEAM = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                     T.StructField("abbreviation", T.StringType())])
SCHEMA = T.StructType([
    T.StructField("athlete_id", T.StringType()), T.StructField("athlete_full_name", T.StringType()),
    T.StructField("athlete_age", T.StringType()), T.StructField("athlete_weight", T.StringType()),
    T.StructField("athlete_height", T.StringType()),
    T.StructField("athlete_nationality", T.StringType()),
    T.StructField("athlete_position", T.StringType()), T.StructField("athlete_team", TEAM)])

A = ("1", "Ann", "FC A")
ROWS = [
    ("1", "p21", "21", "70", "180", "ES", "G", A), ("2", "p22", "22", "180 lbs", "180", "FR", "D", A),
    ("3", "p25", "25", "80", "0", "ES", "D", A), ("4", "p26", "26", "75", "175", None, "M", A),
    ("5", "p29", "29", "70", None, "DE", "F", A), ("6", "p30", "30", "70", "170", "DE", "F", A),
    ("7", "p33", "33", "70", "170", "IT", "F", None), ("8", "p34", "34", "70", "170", "IT", "F", None),
    ("9", "pnull", None, "70", "170", "IT", "F", A), ("10", "pbad", "abc", "70", "170", "IT", "F", A),
    ("11", None, "27", "70", "170", "IT", "F", A),
]


def test_player_analytics(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    p = {r.athlete_id: r for r in gold.player_analytics(df).collect()}
    # name NULL, age NULL and age 'abc' are dropped (try_cast, no ANSI error)
    assert set(p) == {str(i) for i in range(1, 9)}
    assert [p[str(i)].age_group for i in range(1, 9)] == [
        "Youth (≤21)", "Young (22-25)", "Young (22-25)", "Prime (26-29)", "Prime (26-29)",
        "Experienced (30-33)", "Experienced (30-33)", "Veteran (34+)"]
    assert p["2"].bmi is None and p["3"].bmi is None and p["5"].bmi is None
    assert abs(p["1"].bmi - 70 / 1.8 / 1.8) < 1e-9
    assert p["7"].team_id is None and p["1"].team_name == "Ann"


def test_roster_numeric_min_max(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    r = gold.team_roster_summary(df).collect()
    assert len(r) == 1                        # the NULL-team group is filtered
    r = r[0]
    assert (r.total_players, r.min_age, r.max_age, r.age_diversity) == (9, 21, 30, 9)
    assert r.nationalities == ["DE", "ES", "FR", "IT"] and r.nationality_count == 4
    c = gold.team_roster_summary(df, sets="count").first()
    assert (c.nationality_count, c.position_count) == (4, 4)


def test_expressions(spark):
    df = spark.createDataFrame([(3, 1, None), (1, 1, 3), (0, 2, 4), (None, 0, None)],
                               "h int, a int, rank int")
    out = df.select(X.outcome("h", "a").alias("o"), X.expected_points(X.to_int("h")).alias("e"),
                    X.qualification("rank").alias("q"),
                    X.safe_ratio("h", "a").alias("r"), X.competitiveness("a").alias("c")).collect()
    assert [r.o for r in out] == ["Win", "Draw", "Loss", None]
    assert [r.q for r in out] == ["Eliminated", "Europa League", "Eliminated", "Eliminated"]
    assert [r.r for r in out] == [3.0, 1.0, 0.0, 0.0]
    assert [r.c for r in out] == [100.0, 100.0, 50.0, 100.0]
