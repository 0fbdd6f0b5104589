"""Ranks per period and the final ranking by mean rank.

Ranks are numeric (the lowest rate ranks 1), with no shared ranks: ties go
to the name in ascending order.  Regions, a handful, are ranked by a window per period; members of
any other level, and the final order, are ranked by range partitions, so that no task holds all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstat.functions.ordering import global_row_number, grouped_row_number
from tierstat.operators.matrix import national_periods, pivot_grid, rate_matrix
from tierstat.roles import DEFAULT, Roles

RANKING_COLUMN = "rank (best -> worst)"  # fixed value: the source's column title


def rank_cells(grid: DataFrame, name: str, period: str, value: str, rank: str = "rank", many: bool = True) -> DataFrame:
    """Rank ``name`` within each ``period`` by ``value`` ascending, ties by name.

    ``many``: the members of a period are spread over tasks (:func:`grouped_row_number`, which checkpoints the
    grid), whatever their number.  Without it a window holds all members of a period in one task; for levels of few members.
    """
    known = grid.where(F.col(value).isNotNull())
    order = [F.col(value).asc(), F.col(name).asc()]
    if many:
        return grouped_row_number(known, [period], order, rank)
    return known.withColumn(rank, F.row_number().over(Window.partitionBy(period).orderBy(*order)).cast("bigint"))


def rank_matrix(
    df: DataFrame,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """Per period, members ranked 1..n by rate (O38): ``name, period, rate, rank``.

    ``periods`` (the grid's columns) may be given to skip collecting them.
    """
    level = level or roles.regional
    name = roles.level_column(level)
    grid = rate_matrix(df, roles, fill, level, periods)
    return rank_cells(grid, name, roles.period, roles.rate, many=level != roles.regional)


def rank_matrix_wide(
    df: DataFrame,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """The ranks as a grid, one column per national period (O38, wide): the heat map's table."""
    level = level or roles.regional
    name = roles.level_column(level)
    periods = national_periods(df, roles) if periods is None else periods
    ranks = rank_matrix(df, roles, fill, level, periods)
    return pivot_grid(ranks, name, roles.period, "rank", periods, None, kind="bigint")


def mean_rank(
    df: DataFrame,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """Mean of each member's ranks over the periods (O39): ``name, mean_rank``."""
    level = level or roles.regional
    name = roles.level_column(level)
    ranks = rank_matrix(df, roles, fill, level, periods)
    return ranks.groupBy(name).agg(F.avg("rank").alias("mean_rank"))


def final_ranking(means: DataFrame, name: str, column: str = RANKING_COLUMN) -> DataFrame:
    """Positions 1..n by mean rank, ties by name: ``column, name, mean_rank``."""
    ranked = global_row_number(means, [F.col("mean_rank").asc(), F.col(name).asc()], column)
    return ranked.select(column, name, "mean_rank").orderBy(column)


def region_ranking(
    df: DataFrame,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """Members from best (lowest mean rank) to worst (O40): ``rank (best -> worst), name``."""
    level = level or roles.regional
    name = roles.level_column(level)
    return final_ranking(mean_rank(df, roles, fill, level, periods), name).select(RANKING_COLUMN, name)
