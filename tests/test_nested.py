"""Bronze → silver → gold on hand-made documents (FIXTURES A1-A4)."""

import json
import os

from pyspark.sql import functions as F

from pitchline.plans import gold, silver, warehouse
from pitchline.sources.bronze import corrupt_documents, read_bronze

TS1, TS2 = "2024-09-01T00:00:00", "2024-09-08T00:00:00"


def stats(gp, w, l, t, pts, gf, ga, rank):
    vals = {"gamesPlayed": gp, "wins": w, "losses": l, "ties": t, "points": pts,
            "pointsPerGame": round(pts / gp, 4) if gp else 0.0, "goalsFor": gf,
            "goalsAgainst": ga, "goalDifferential": gf - ga, "rank": rank}
    return [{"name": k, "value": v} for k, v in vals.items()]


def entry(tid, name, st):
    return {"team": {"id": tid, "name": name, "abbreviation": name[:3].upper()}, "stats": st}


def standings_doc(ts, entries_a, entries_b):
    return {"metadata": {"ingestion_timestamp": ts, "source": "api", "version": "1.0"},
            "data": {"children": [
                {"id": "A", "name": "Group A", "abbreviation": "A",
                 "standings": {"entries": entries_a}},
                {"id": "B", "name": "Group B", "abbreviation": "B",
                 "standings": {"entries": entries_b}},
                {"id": "C", "name": "Group C", "abbreviation": "C",
                 "standings": {"entries": []}}]}}


def write_doc(root, rel, doc):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)  # multi-line, as the landing service wrote it


def bronze_tree(root):
    # snapshot 1: t1 and t2 tie on points; t3 has no stats array
    s1 = standings_doc(TS1, [entry("t1", "Alpha", stats(2, 1, 0, 1, 4, 3, 1, 1)),
                             entry("t2", "Beta", stats(2, 1, 0, 1, 4, 2, 1, 2))],
                       [{"team": {"id": "t3", "name": "Gamma", "abbreviation": "GAM"},
                         "stats": None}])
    # snapshot 2: t1 played again
    s2 = standings_doc(TS2, [entry("t1", "Alpha", stats(3, 2, 0, 1, 7, 5, 1, 1)),
                             entry("t2", "Beta", stats(3, 1, 1, 1, 4, 2, 3, 2))],
                       [entry("t3", "Gamma", stats(0, 0, 0, 0, 0, 0, 0, 1))])
    write_doc(root, "standings/2024/20240901_000000.json", s1)
    write_doc(root, "standings/2024/20240908_000000.json", s2)


def test_read_bronze_multiline_and_plain_folders(spark, workdir):
    bronze_tree(workdir)
    df = read_bronze(spark, workdir, "standings", layout="document")
    rows = df.select("metadata.ingestion_timestamp", "asset_name", "_corrupt_record").collect()
    assert sorted(r.ingestion_timestamp for r in rows) == [TS1, TS2]
    assert {r.asset_name for r in rows} == {"20240901_000000", "20240908_000000"}
    assert all(r._corrupt_record is None for r in rows)


def test_explode_drops_empty_and_null_arrays(spark, workdir):
    bronze_tree(workdir)
    long = silver.explode_standings(read_bronze(spark, workdir, "standings", layout="document"))
    # snapshot 1: 2 teams x 10 stats (t3 null stats, group C empty); snapshot 2: 3 x 10
    assert long.count() == 50
    outer = silver.explode_standings(read_bronze(spark, workdir, "standings", layout="document"), outer=True)
    keys = {(r.group_id, r.team_id) for r in outer.where(F.col("stat_name").isNull()).collect()}
    assert ("C", None) in keys and ("B", "t3") in keys


def test_silver_standings_pivot_and_audit(spark, workdir):
    bronze_tree(workdir)
    wide = silver.silver_standings(read_bronze(spark, workdir, "standings", layout="document"), ts="T")
    assert wide.count() == 5
    r = wide.where((F.col("team_id") == "t1") & (F.col("ingestion_timestamp") == TS2)).first()
    assert (r.gamesPlayed, r.points, r.goalDifferential, r.data_layer,
            r.transformation_timestamp) == (3.0, 7.0, 4.0, "silver", "T")


def test_gold_latest_snapshot_and_ties(spark, workdir):
    bronze_tree(workdir)
    wide = silver.silver_standings(read_bronze(spark, workdir, "standings", layout="document"))
    perf = gold.team_performance_summary(wide).collect()
    by = {r.team_id: r for r in perf}
    assert set(by) == {"t1", "t2", "t3"}          # newest snapshot per team only
    assert by["t1"].games_played == 3 and by["t1"].overall_rank == 1
    assert by["t3"].win_percentage == 0.0         # zero games -> 0, not NULL
    assert sorted(r.overall_rank for r in perf) == [1, 2, 3]
    everything = gold.team_performance_summary(wide, snapshot="all")
    assert everything.count() == 5               # the literal reference behaviour
    ov = gold.competition_overview(wide).first()
    assert (ov.total_teams, ov.total_groups, ov.total_games_played) == (3, 2, 6)
    ga = {r.group_id: r for r in gold.group_analysis(wide).collect()}
    assert ga["A"].points_spread == 3 and ga["B"].competitiveness_score == 100.0


def test_nothing_is_lost_on_the_way(spark, workdir):
    entries = [entry("t1", "Alpha", stats(2, 1, 0, 1, 4, 3, 1, 1) + [{"name": "deductions", "value": 3.0},
                                                                    {"name": "deductions", "value": 2.0}])]
    write_doc(workdir, "standings/season=2023/a.json", standings_doc(TS1, entries, []))
    write_doc(workdir, "standings/2024/b.json", standings_doc(TS2, entries, []))
    os.makedirs(os.path.join(workdir, "standings/2024"), exist_ok=True)
    with open(os.path.join(workdir, "standings/2024/bad.json"), "w") as f:
        f.write("{ no json")
    docs = read_bronze(spark, workdir, "standings", layout="document")
    counts = corrupt_documents(docs).first()
    assert (counts.documents, counts.corrupt) == (3, 1)
    wide = silver.silver_standings(docs)
    assert {(r.season, r.other_stats["deductions"]) for r in wide.collect()} == {("2023", 3.0), ("2024", 3.0)}
    only = read_bronze(spark, workdir, "standings", layout="document", seasons=["2024"])
    assert {r.season for r in only.collect()} == {"2024"}
    # one row per season, group and team
    assert gold.team_performance_summary(wide).count() == 2
    event = {"metadata": {"ingestion_timestamp": TS1}, "data": {"events": [
        {"id": "7", "date": "2024-13-99", "status": {"name": "F", "detail": {"clock": "90"}}, "season": {"year": 2024, "x": 1},
         "competitions": [{"competitors": [{"homeAway": "home", "teamId": "1", "score": "25.0"},
                                           {"homeAway": "away", "teamId": "2", "score": "x"}]}]}]}}
    write_doc(workdir, "events/2024/e.json", event)
    e = silver.silver_events(read_bronze(spark, workdir, "events", layout="document"))
    row = e.first()
    assert json.loads(row.event_status)["detail"] == {"clock": "90"} and json.loads(row.event_season)["x"] == 1
    match = warehouse.fact_match_results(e).first()
    assert (match.match_status, match.match_date, match.home_score, match.away_score) == ("F", None, 25, None)
    write_doc(workdir, "team_info/17/t.json", {"metadata": {"source": "api"}, "data": {"team": {"id": 17}}})
    info = read_bronze(spark, workdir, "team_info", layout="document").first()
    assert info.team_id == "17" and json.loads(info.data) == {"team": {"id": 17}}
