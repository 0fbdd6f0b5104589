"""performance of regions over time (O35-O40 together).

Returns the three results the source shows (the line-chart series with the
national rate, the rank of each member per period, the final ranking) and a
tidy frame joining rank cells to the member's mean rank and final position.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.operators.ranking import RANKING_COLUMN, final_ranking, rank_cells
from tierstat.operators.matrix import rate_matrix
from tierstat.operators.series import rate_series_with_national
from tierstat.roles import DEFAULT, Roles
from tierstat.session import checkpoint_root


class RegionPerformance:
    """The parts of F2, each built on first use (rank cells and ranking are checkpointed)."""

    def __init__(
        self, df: DataFrame, roles: Roles, fill: float | None, level: str, periods: list[str] | None = None
    ) -> None:
        self._df, self._roles, self._fill, self._level, self._periods = df, roles, fill, level, periods
        self.name = roles.level_column(level)

    @cached_property
    def series(self) -> DataFrame:
        """period, rate, name (with the national series)."""
        return rate_series_with_national(self._df, self._roles, level=self._level)

    @cached_property
    def ranks(self) -> DataFrame:
        """name, period, rate, rank, checkpointed to the shared folder.

        The grid holds one row per member and period; the ranking and the
        joined table both read it, so the input is not computed again.
        """
        checkpoint_root(self._df.sparkSession)
        grid = rate_matrix(self._df, self._roles, self._fill, self._level, self._periods)
        many = self._level != self._roles.regional
        return rank_cells(grid, self.name, self._roles.period, self._roles.rate, many=many).checkpoint(eager=True)

    @cached_property
    def ranking(self) -> DataFrame:
        """rank (best -> worst), name, mean_rank."""
        means = self.ranks.groupBy(self.name).agg(F.avg("rank").alias("mean_rank"))
        return final_ranking(means, self.name)

    @cached_property
    def table(self) -> DataFrame:
        """name, period, rate, rank, mean_rank, rank (best -> worst)."""
        # One row per member on the right: an equi-join AQE broadcasts once it sees the size.
        return self.ranks.join(self.ranking, self.name).select(
            self.name, self._roles.period, self._roles.rate, "rank", "mean_rank", RANKING_COLUMN
        )


def region_performance(
    df: DataFrame,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    level: str | None = None,
    periods: list[str] | None = None,
) -> RegionPerformance:
    """F2; ``periods`` (the grid's columns) may be given to skip collecting them."""
    return RegionPerformance(df, roles, fill, level or roles.regional, periods)
