"""Elo-style outcome model as column expressions.

    adv = +HOST_ADVANTAGE if the home side hosts, -HOST_ADVANTAGE if the away side does, else 0
    d   = R_home + adv - R_away
    b   = 1 / (1 + 10^(-d / LOGISTIC_SCALE))
    pd  = DRAW_PEAK * exp(-(d / DRAW_SCALE)^2)
    ph  = b * (1 - pd);   pa = (1 - b) * (1 - pd)
    xg  = (goals / matches) * (R_own / R_other)      (advantage not applied)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerwise.functions.casts import _col, ColumnOrName

# Fixed values of the rating model.
DEFAULT_RATING = 1500
HOST_ADVANTAGE = 100
LOGISTIC_SCALE = 400.0
DRAW_PEAK = 0.25
DRAW_SCALE = 300.0
PROBABILITY_DIGITS = 4
GOALS_DIGITS = 2
DRAW_LABEL = "Draw"


def host_advantage(home_is_host: ColumnOrName, away_is_host: ColumnOrName) -> Column:
    return (
        F.when(_col(home_is_host) == 1, F.lit(HOST_ADVANTAGE))
        .when(_col(away_is_host) == 1, F.lit(-HOST_ADVANTAGE))
        .otherwise(F.lit(0))
    )


def win_expectancy(diff: Column) -> Column:
    """Logistic expectancy of the side that is ``diff`` points stronger."""
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), -diff / F.lit(LOGISTIC_SCALE)))


def draw_probability(diff: Column) -> Column:
    return F.lit(DRAW_PEAK) * F.exp(-F.pow(diff / F.lit(DRAW_SCALE), F.lit(2.0)))


def outcome_probabilities(diff: Column) -> tuple[Column, Column, Column]:
    """(home win, away win, draw); the three add up to 1 before rounding."""
    base = win_expectancy(diff)
    draw = draw_probability(diff)
    rest = F.lit(1.0) - draw
    return base * rest, (F.lit(1.0) - base) * rest, draw


def expected_goals(
    goals: ColumnOrName, matches: ColumnOrName, own: ColumnOrName, other: ColumnOrName
) -> Column:
    """Average goals per match scaled by the rating ratio; NULL when matches is 0."""
    return F.try_divide(_col(goals), _col(matches)) * F.try_divide(_col(own), _col(other))


def winner_label(
    p_home: Column, p_away: Column, p_draw: Column, home: ColumnOrName, away: ColumnOrName
) -> Column:
    """Home label if its probability beats both others, away likewise, else ``'Draw'``."""
    return (
        F.when((p_home > p_away) & (p_home > p_draw), _col(home).cast("string"))
        .when((p_away > p_home) & (p_away > p_draw), _col(away).cast("string"))
        .otherwise(F.lit(DRAW_LABEL))
    )
