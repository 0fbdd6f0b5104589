"""Series per area or region over periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.roles import DEFAULT, Roles


def _as_list(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def enrolment_series(df: DataFrame, area: str | list[str], roles: Roles = DEFAULT) -> DataFrame:
    """Enrolments per period of one area's ``Total`` row (O10): ``enrolments, time_period``."""
    return (
        df.where(
            F.col(roles.area).isin(_as_list(area))
            & (F.col(roles.level) == roles.area_level)
            & (F.col(roles.category) == roles.total)
        )
        .select("enrolments", roles.period)
        .orderBy(roles.period)
    )


def enrolment_series_multi(df: DataFrame, areas: list[str], roles: Roles = DEFAULT) -> DataFrame:
    """O10 for several areas in one query, keyed by area."""
    return (
        df.where(
            F.col(roles.area).isin(_as_list(areas))
            & (F.col(roles.level) == roles.area_level)
            & (F.col(roles.category) == roles.total)
        )
        .select(roles.area, roles.period, "enrolments")
        .orderBy(roles.area, roles.period)
    )


def rate_series(df: DataFrame, roles: Roles = DEFAULT, level: str | None = None) -> DataFrame:
    """The rate of each region's ``Total`` row per period."""
    level = level or roles.regional
    name = roles.level_column(level)
    return (
        df.where((F.col(roles.level) == level) & (F.col(roles.category) == roles.total))
        .select(roles.period, roles.rate, name)
        .orderBy(roles.period, name)
    )


NATION_LABEL = "Nation Wide"  # fixed value: label of the national series


def rate_series_with_national(
    df: DataFrame, roles: Roles = DEFAULT, label: str = NATION_LABEL, level: str | None = None
) -> DataFrame:
    """O35 plus the national rate labelled ``Nation Wide`` (O36), from one scan."""
    level = level or roles.regional
    name = roles.level_column(level)
    return (
        df.where(
            F.col(roles.level).isin(roles.national, level) & (F.col(roles.category) == roles.total)
        )
        .select(
            roles.period,
            roles.rate,
            F.when(F.col(roles.level) == roles.national, F.lit(label))
            .otherwise(F.col(name))
            .alias(name),
        )
        .orderBy(roles.period, name)
    )
