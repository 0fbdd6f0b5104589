"""Filtered totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.functions.columns import sum_columns
from tierstat.roles import AUTH_REASONS, DEFAULT, Roles

# The medical reasons and the period the source's medical feature uses.
MEDICAL_REASONS = ["sess_auth_appointments", "sess_auth_illness"]
MEDICAL_PERIOD = "2017/18"


def medical_absence_total(
    df: DataFrame,
    category: str | list[str],
    period: str = MEDICAL_PERIOD,
    roles: Roles = DEFAULT,
    reasons: list[str] = MEDICAL_REASONS,
) -> DataFrame:
    """National sums of the medical reasons for a category and period, plus ``total``.

    A global aggregate: always one row; no matching row gives nulls, and a
    null side makes ``total`` null.
    """
    cats = [category] if isinstance(category, str) else list(category)
    return (
        df.where(
            (F.col(roles.period) == period)
            & F.col(roles.category).isin(cats)
            & (F.col(roles.level) == roles.national)
        )
        .agg(*[F.sum(r).alias(r) for r in reasons])
        .withColumn("total", sum_columns(reasons))
    )


def unauthorised_by(
    df: DataFrame, period: str | list[str], level: str, roles: Roles = DEFAULT
) -> DataFrame:
    """``sess_unauthorised`` of each area (or region) ``Total`` row in a period."""
    name = roles.level_column(level)
    periods = [period] if isinstance(period, str) else list(period)
    return (
        df.where(
            F.col(roles.period).isin(periods)
            & (F.col(roles.level) == level)
            & (F.col(roles.category) == roles.total)
        )
        .select(name, "sess_unauthorised")
        .orderBy(name)
    )


def unauthorised_by_la(df: DataFrame, period: str | list[str], roles: Roles = DEFAULT) -> DataFrame:
    return unauthorised_by(df, period, roles.area_level, roles)


def unauthorised_by_region(df: DataFrame, period: str | list[str], roles: Roles = DEFAULT) -> DataFrame:
    return unauthorised_by(df, period, roles.regional, roles)


def reason_totals(
    df: DataFrame,
    reasons: list[str] = AUTH_REASONS,
    roles: Roles = DEFAULT,
    level: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Sum of each reason per period.

    By default no level or category filter is applied, as in the source
    application, so each absence is counted at every level and again under
    ``Total``; pass ``level`` / ``category`` to sum one slice only.
    """
    if level is not None:
        df = df.where(F.col(roles.level) == level)
    if category is not None:
        df = df.where(F.col(roles.category) == category)
    return df.groupBy(roles.period).agg(*[F.sum(r).alias(r) for r in reasons])
