"""Scalar column expressions (C8, C11-C24). All built-in Catalyst
expressions: they stay inside whole-stage codegen, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- C8: casts that turn bad input into NULL instead of failing (ANSI) ---

def to_int(x: Column | str) -> Column:
    """``try_cast`` to int: a non-numeric string becomes NULL.
    Numeric inputs, and decimal numbers in strings ("25.0"), truncate toward
    zero like ``cast``; what does not fit becomes NULL."""
    return F.coalesce(_c(x).try_cast("int"), _c(x).try_cast("double").try_cast("int"))


def to_double(x: Column | str) -> Column:
    return _c(x).try_cast("double")


def to_bigint(x: Column | str) -> Column:
    """As :func:`to_int`, for totals that may pass 2^31."""
    return F.coalesce(_c(x).try_cast("bigint"), _c(x).try_cast("decimal(38,10)").try_cast("bigint"))


# --- C11-C14: rates and ratings ---

def safe_ratio(num: Column | str, den: Column | str, scale: float = 1.0,
               default: float = 0.0) -> Column:
    """``num / den * scale`` when ``den > 0``, else ``default`` (not NULL).
    A NULL denominator also falls to the default."""
    num, den = _c(num), _c(den)
    value = num / den if scale == 1.0 else num / den * F.lit(scale)
    return F.when(den > 0, value).otherwise(F.lit(default))


def win_pct(wins: Column | str = "wins", games: Column | str = "games_played") -> Column:
    """wins / games * 100, 0 when no games (C11)."""
    num, den = _c(wins), _c(games)
    return F.when(den > 0, num / den * 100).otherwise(F.lit(0.0))


def performance_rating(ppg: Column | str = "points_per_game",
                       goal_diff: Column | str = "goal_differential") -> Column:
    """points-per-game × 10 + goal differential (C14)."""
    return _c(ppg) * 10 + _c(goal_diff)


# --- C15, C16: player attributes ---

# Age-group labels and their inclusive upper bounds.
AGE_GROUP_BOUNDS = (21, 25, 29, 33)
AGE_GROUP_LABELS = ("Youth (≤21)", "Young (22-25)", "Prime (26-29)",
                    "Experienced (30-33)", "Veteran (34+)")


def bucketize(x: Column | str, upper_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bucket whose inclusive upper bound holds ``x``;
    the last label catches the rest, including NULL (as a chained ``when``
    with an ``otherwise`` does)."""
    if len(labels) != len(upper_bounds) + 1:
        raise ValueError("need one more label than bounds")
    x = _c(x)
    expr = None
    for bound, label in zip(upper_bounds, labels):
        expr = F.when(x <= bound, label) if expr is None else expr.when(x <= bound, label)
    return expr.otherwise(labels[-1])


def age_group(age: Column | str = "age") -> Column:
    return bucketize(age, AGE_GROUP_BOUNDS, AGE_GROUP_LABELS)


def bmi(weight_kg: Column | str = "weight_kg", height_cm: Column | str = "height_cm") -> Column:
    """kg / (cm/100)²; NULL when either is NULL or the height is not positive."""
    w, h = _c(weight_kg), _c(height_cm)
    m = h / 100
    return F.when(w.isNotNull() & h.isNotNull() & (h > 0), w / m / m)


# --- C19-C24: competition metrics ---

def competitiveness(spread: Column | str = "points_spread") -> Column:
    """100 / spread when spread > 0, else 100."""
    s = _c(spread)
    return F.when(s > 0, F.lit(100) / s).otherwise(F.lit(100.0))


def expected_points(goal_diff: Column | str = "goal_differential") -> Column:
    """3 for a positive goal difference, 1 for zero, else 0."""
    gd = _c(goal_diff)
    return F.when(gd > 0, 3).when(gd == 0, 1).otherwise(0)


# Qualification labels by group rank.
QUALIFIED, SECOND_TIER, ELIMINATED = "Qualified", "Europa League", "Eliminated"


def qualification(group_rank: Column | str = "group_rank") -> Column:
    """Rank ≤ 2 qualifies, rank 3 drops to the second tier, else out."""
    r = _c(group_rank)
    return F.when(r <= 2, QUALIFIED).when(r == 3, SECOND_TIER).otherwise(ELIMINATED)


# Match outcome labels from the home side's view.
WIN, DRAW, LOSS = "Win", "Draw", "Loss"


def outcome(home_score: Column | str = "home_score",
            away_score: Column | str = "away_score") -> Column:
    """Win / Draw / Loss for the home side; NULL when a score is missing."""
    h, a = _c(home_score), _c(away_score)
    return F.when(h > a, WIN).when(h == a, DRAW).when(h < a, LOSS)


def wdl(wins: Column | str = "wins", draws: Column | str = "ties",
        losses: Column | str = "losses") -> Column:
    """"W-D-L" record string."""
    return F.concat_ws("-", _c(wins).cast("string"), _c(draws).cast("string"),
                       _c(losses).cast("string"))


def goals_ratio_decimal(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """``ROUND(SUM(x)::DECIMAL / SUM(y), 2)`` with the 0 branch (C20):
    the numerator is cast to decimal(18,0) as the warehouse does."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, F.round(n.cast("decimal(18,0)") / d, scale)).otherwise(
        F.lit(0).cast(f"decimal(38,{scale})"))
