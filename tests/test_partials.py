"""Partial states: batches in any order, replays, retraction of extremes."""

import random

from pyspark.sql import functions as F

from pitchline.plans import gold
from pitchline.sinks import versions
from pitchline.streaming import partials

STATS = ("gamesPlayed", "goalsFor", "points", "goalDifferential")


def standings(spark, rows):
    return spark.createDataFrame(rows, "season string, group_id string, group_name string, team_id string, "
                                 "ingestion_timestamp string, " + ", ".join(f"{s} double" for s in STATS))


def random_rows(seed, n):
    r = random.Random(seed)
    return [(r.choice(["2023", "2024"]), g := r.choice("AB"), f"Group {g}", str(r.randint(1, 8)), f"2024-09-{r.randint(1, 9):02d}",
             *[None if r.random() < 0.1 else float(r.randint(-5, 30)) for _ in STATS]) for _ in range(n)]


def distinct_times(rows):
    """One row for each key and time, so that the newest is unique."""
    return list({(*r[:2], r[3], r[4]): r for r in rows}.values())


def full(spark, rows):
    return sorted(map(str, gold.group_analysis(standings(spark, rows)).select(sorted(COLUMNS)).collect()))


COLUMNS = ("season", "group_id", "group_name", "teams_in_group", "total_games_played", "total_goals_scored", "avg_points_per_team",
           "group_leader_points", "group_lowest_points", "best_goal_differential", "worst_goal_differential", "competitiveness_rank")


def test_batches_equal_the_rebuild(spark, workdir):
    rows = distinct_times(random_rows(1, 60))
    for i in range(4):
        partials.apply_batch(spark, workdir, standings(spark, rows[i::4]), f"batch-{i}")
        # the same batch again, as after a failure
        partials.apply_batch(spark, workdir, standings(spark, rows[i::4]), f"batch-{i}")
    got = partials.group_analysis(partials.counts(spark, workdir)).select(sorted(COLUMNS)).collect()
    assert sorted(map(str, got)) == full(spark, rows)


def test_failure_between_the_two_tables(spark, workdir, monkeypatch):
    rows = distinct_times(random_rows(2, 40))
    partials.apply_batch(spark, workdir, standings(spark, rows[:20]), "batch-0")
    write = versions.write_version

    def dies(df, root, name, load, base, *more):
        if name == partials.ROWS:
            raise RuntimeError("lost")
        return write(df, root, name, load, base, *more)

    monkeypatch.setattr(versions, "write_version", dies)
    try:
        partials.apply_batch(spark, workdir, standings(spark, rows[20:]), "batch-1")
        raise AssertionError("it should have died")
    except RuntimeError:
        pass
    monkeypatch.undo()
    partials.apply_batch(spark, workdir, standings(spark, rows[20:]), "batch-1")
    got = partials.group_analysis(partials.counts(spark, workdir)).select(sorted(COLUMNS)).collect()
    assert sorted(map(str, got)) == full(spark, rows)


def test_counts_without_rest(spark, workdir):
    one = [("2024", "A", "Group A", "1", "2024-09-01", 3.0, 4.0, 9.0, 2.0)]
    two = [("2024", "A", "Group A", "1", "2024-09-02", 4.0, 4.0, 1.0, -2.0)]
    partials.apply_batch(spark, workdir, standings(spark, one), "a")
    partials.apply_batch(spark, workdir, standings(spark, two), "b")
    assert partials.counts(spark, workdir).where("n <> 1").count() == 0
    g = partials.group_analysis(partials.counts(spark, workdir)).first()
    assert (g.group_leader_points, g.best_goal_differential, g.teams_in_group) == (1, -2, 1)  # the old extremes are gone


def test_a_batch_reads_new_files_only(spark, workdir):
    from pitchline.sinks import files

    team = lambda i: {"id": str(i), "name": f"T{i}", "abbreviation": "T"}
    for i in range(3):
        doc = [([{"id": "A", "name": "A", "abbreviation": "A", "standings": {"entries": [
            {"team": team(10 * i + k), "stats": [{"name": "points", "value": float(i)}]} for k in range(2)]}}],)]
        df = spark.createDataFrame(doc, "children array<struct<id:string,name:string,abbreviation:string,standings:struct<entries:array<struct<"
                                   "team:struct<id:string,name:string,abbreviation:string>,stats:array<struct<name:string,value:double>>>>>>>")
        files.land_bronze(df.withColumn("season", F.lit("2024")), f"{workdir}/bronze", "standings", "api", partition_by=["season"],
                          ts=f"2024-09-0{i + 1}T00:00:00")
        q = partials.stream_gold(spark, f"{workdir}/bronze", f"{workdir}/state", f"{workdir}/ckpt")
        q.awaitTermination()
        assert sum(p["numInputRows"] for p in q.recentProgress) == 1  # one document, whatever landed before
        assert partials.rows(spark, f"{workdir}/state").count() == 2 * (i + 1)
