"""Side-by-side comparison of areas in one period.

The source application runs one query per area and section and unions
them.  Here all chosen areas are answered by one scan: rows are filtered on
the area names (pushed into the Parquet scan), each row is tagged with the
side number(s) whose area it matches by a narrow ``explode`` (no join, no
shuffle), and the rows are grouped by ``side, area[, category]``.  Choosing
the same area twice gives two equal sides; an area without rows in the
period gives no row for its side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstat.roles import (
    AUTH_MEASURES,
    DEFAULT,
    ENROLMENT_MEASURES,
    SCHOOL_MEASURES,
    SESSION_MEASURES,
    SESSION_MEASURES_WIDE,
    UNAUTH_MEASURES,
    UNAUTH_MEASURES_WIDE,
    Roles,
)


def _as_list(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def compare_filter(areas: list[str], period: str, roles: Roles = DEFAULT) -> Column:
    """Rows of the chosen areas in one period, per category (not ``Total``)."""
    return (
        F.col(roles.area).isin(areas)
        & (F.col(roles.period) == period)
        & (F.col(roles.level) == roles.area_level)
        & (F.col(roles.category) != roles.total)
    )


def side_numbers(areas: list[str], roles: Roles = DEFAULT) -> Column:
    """Array of the sides (1..n, argument order) whose area is this row's area."""
    area = F.col(roles.area)
    return F.array_compact(F.array(*[F.when(area == F.lit(a), F.lit(i + 1)) for i, a in enumerate(areas)]))


def with_sides(df: DataFrame, areas: list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """The filtered rows tagged with the side(s) each belongs to: one row per side."""
    rows = df.where(compare_filter(areas, period, roles))
    return rows.select(F.explode(side_numbers(areas, roles)).alias("side"), *df.columns)


def side_sums(
    df: DataFrame, measures: list[str], areas: str | list[str], period: str, by: str | list[str] | None = None, roles: Roles = DEFAULT
) -> tuple[DataFrame, list[str]]:
    """The sums of :func:`compare_sum` in no order, and their key columns."""
    areas = _as_list(areas)
    keys = [roles.area] if by is None else _as_list(by)
    if roles.area not in keys:
        keys = [roles.area, *keys]
    # Summed in each task before the shuffle: what moves is one row per task, side and key.
    sums = with_sides(df, areas, period, roles).groupBy("side", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    return sums, ["side", *keys]


def compare_sum(
    df: DataFrame,
    measures: list[str],
    areas: str | list[str],
    period: str,
    by: str | list[str] | None = None,
    roles: Roles = DEFAULT,
) -> DataFrame:
    """Sum of ``measures`` per side and ``by`` for the chosen areas in ``period``.

    ``by`` defaults to the area column; ``school_type`` gives one row per
    category.  Output: ``side, <by...>, <measures...>`` ordered by side.
    """
    sums, keys = side_sums(df, measures, areas, period, by, roles)
    return sums.orderBy(*keys)


def compare_enrolment(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """O19."""
    return compare_sum(df, ENROLMENT_MEASURES, areas, period, roles=roles)


def compare_school_types(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Schools per category."""
    return compare_sum(df, SCHOOL_MEASURES, areas, period, by=roles.category, roles=roles)


def compare_authorised(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """O21."""
    return compare_sum(df, AUTH_MEASURES, areas, period, roles=roles)


def compare_sessions(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """O22."""
    return compare_sum(df, SESSION_MEASURES, areas, period, roles=roles)


def compare_sessions_wide(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """The seven session measures of the older interface."""
    return compare_sum(df, SESSION_MEASURES_WIDE, areas, period, roles=roles)


def compare_unauthorised(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """O24."""
    return compare_sum(df, UNAUTH_MEASURES, areas, period, roles=roles)


def compare_unauthorised_wide(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """O24 plus the overall unauthorised counts."""
    return compare_sum(df, UNAUTH_MEASURES_WIDE, areas, period, roles=roles)


def compare_union(
    df: DataFrame, measures: list[str], first: str, second: str, period: str, roles: Roles = DEFAULT
) -> DataFrame:
    """The first area's sums stacked over the second's, duplicates kept."""
    return compare_sum(df, measures, [first, second], period, roles=roles)
