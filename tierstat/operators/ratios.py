"""Percentages and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.functions.columns import percent
from tierstat.operators.compare import (
    compare_authorised,
    compare_enrolment,
    compare_sessions,
    compare_sessions_wide,
    compare_unauthorised,
    side_sums,
)
from tierstat.roles import AUTH_PREFIX, AUTH_TOTAL, DEFAULT, SCHOOL_MEASURES, UNAUTH_TOTAL, Roles


# The older interface's shares of possible sessions.
SESSION_SHARES = ("sess_possible_pa_10_exact", "sess_authorised")


def session_parts() -> dict[str, Column]:
    """Attended sessions, and absences of those who are not persistent absentees."""
    return {
        "sess_normal": F.col("sess_possible") - F.col("sess_overall"),
        "sess_overall_exc_pa": F.col("sess_overall") - F.col("sess_overall_pa_10_exact"),
    }


def percent_of(df: DataFrame, numer: str, denom: str, digits: int = 3) -> DataFrame:
    """Add ``<numer>_percent`` = round(numer / denom * 100, 3); null on a zero denominator."""
    return df.withColumn(f"{numer}_percent", percent(numer, denom, digits))


def percents_of(df: DataFrame, numers: list[str], denom: str, digits: int = 3) -> DataFrame:
    """:func:`percent_of` for several numerators in one projection."""
    return df.withColumns({f"{n}_percent": percent(n, denom, digits) for n in numers})


def persistent_absentee_percent(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Share of enrolments that are persistent absentees, per side."""
    return percent_of(compare_enrolment(df, areas, period, roles), "enrolments_pa_10_exact", "enrolments")


def _reason_percents(compared: DataFrame, total: str, roles: Roles) -> DataFrame:
    keys = {"side", roles.area, total}
    return percents_of(compared, [c for c in compared.columns if c not in keys], total)


def authorised_reason_percents(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Each authorised reason as a share of their total, per side."""
    return _reason_percents(compare_authorised(df, areas, period, roles), AUTH_TOTAL, roles)


def unauthorised_reason_percents(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Each unauthorised reason as a share of their total, per side."""
    return _reason_percents(compare_unauthorised(df, areas, period, roles), UNAUTH_TOTAL, roles)


def school_type_share(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Each category's share of the area's schools, per side.

    The area total is a window sum over the side's few category rows, so
    nothing goes to the driver and back.
    """
    per_type, _ = side_sums(df, SCHOOL_MEASURES, areas, period, roles.category, roles)
    area_total = F.sum("num_schools").over(Window.partitionBy("side", roles.area))
    return per_type.withColumn("num_schools_percent", percent(F.col("num_schools"), area_total)).orderBy(
        "side", roles.area, roles.category
    )


def session_split(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Attended, absent (not persistent) and persistent-absent shares of possible sessions."""
    sess = compare_sessions(df, areas, period, roles).withColumns(session_parts())
    sess = percents_of(sess, ["sess_normal", "sess_overall_exc_pa", "sess_overall_pa_10_exact"], "sess_possible")
    return percent_table(sess, roles, keep=("side", roles.area))


def session_percents_wide(df: DataFrame, areas: str | list[str], period: str, roles: Roles = DEFAULT) -> DataFrame:
    """Older interface: persistent-absentee and authorised shares of possible sessions."""
    sess = compare_sessions_wide(df, areas, period, roles)
    return percents_of(sess, list(SESSION_SHARES), "sess_possible")


def percent_name(column: str, prefix: str = AUTH_PREFIX) -> str:
    """Display name of a percent column: drop ``sess_auth_``, else ``sess`` and one more character."""
    if column.startswith(prefix):
        return column[len(prefix):]
    if column.startswith("sess"):
        return column[5:]
    return column


def percent_table(df: DataFrame, roles: Roles = DEFAULT, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Keep the key columns and every column ending in ``percent``, with short names."""
    keep = ("side", roles.area) if keep is None else keep
    cols = [c for c in df.columns if c in keep] + [
        c for c in df.columns if c.endswith("percent") and c not in keep
    ]
    return df.select(*[F.col(c).alias(c if c in keep else percent_name(c)) for c in cols])
