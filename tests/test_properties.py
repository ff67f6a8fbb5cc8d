"""Properties: pivot∘unpivot is the identity, group totals add
up to the competition totals, a layer re-run changes nothing."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from pitchline.catalog import queries as Qs
from pitchline.operators.reshape import pivot_stats, unpivot_stats
from pitchline.plans import gold
from pitchline.sources.tables import Tables

NAMES = ("a", "b", "c")

rows = st.lists(
    st.tuples(st.integers(0, 5), st.sampled_from(NAMES),
              st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
    min_size=0, max_size=30, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=8, deadline=None)
@given(rows)
def test_pivot_then_unpivot_is_identity(spark, data):
    df = spark.createDataFrame(data, "k int, stat_name string, stat_value double")
    back = unpivot_stats(pivot_stats(df, NAMES), NAMES)
    expected = sorted((k, n, v) for k, n, v in data if v is not None)
    got = sorted((r.k, r.stat_name, r.stat_value) for r in back.collect())
    assert got == expected


def test_group_totals_add_up(spark):
    s = Qs.standings(Tables(spark, SF_SMALL))
    groups = gold.group_analysis(s).collect()
    ov = gold.competition_overview(s).first()
    assert sum(g.total_games_played for g in groups) == ov.total_games_played
    assert sum(g.total_goals_scored for g in groups) == ov.total_goals_scored
    assert sum(g.teams_in_group for g in groups) == ov.total_teams
    assert sorted(g.competitiveness_rank for g in groups) == list(range(1, len(groups) + 1))


def test_layer_rerun_is_idempotent(spark, workdir):
    from pitchline.sinks.files import write_layer
    s = Qs.standings(Tables(spark, SF_SMALL))
    for _ in range(2):
        write_layer(gold.team_performance_summary(s), workdir, "tps")
    out = spark.read.parquet(f"{workdir}/tps")
    assert out.count() == s.count()
    assert out.select("team_id").distinct().count() == out.count()
