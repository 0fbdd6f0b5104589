"""absence by location and category in one period (O5, O41, O42 together)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.operators.matrix import rate_by_type_region, type_region_cells, type_region_matrix_wide
from tierstat.operators.members import members_school_type
from tierstat.roles import DEFAULT, Roles


class AbsenceLocation(NamedTuple):
    categories: DataFrame  # grid rows (O5)
    cells: DataFrame  # region, rate, category (O41)
    grid: DataFrame  # category, one column per region (O42, wide)
    long: DataFrame  # category, region, rate (O42, long)
    table: DataFrame  # category, region, rate, known: the long grid with the cells that the data has marked


def absence_location_school(
    df: DataFrame,
    period: str,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    regions: list[str] | None = None,
    categories: list[str] | None = None,
) -> AbsenceLocation:
    # One aggregate gives the filled grid and which of its cells the data has.
    cells = type_region_cells(df, period, roles, regions, categories)
    rate = F.col(roles.rate)
    filled = rate if fill is None else F.coalesce(rate, F.lit(float(fill)))
    table = cells.select(roles.category, roles.region, filled.alias(roles.rate), rate.isNotNull().cast("int").alias("known"))
    if fill is None:
        table = table.where("known = 1")
    return AbsenceLocation(
        members_school_type(df, roles),
        rate_by_type_region(df, period, roles),
        type_region_matrix_wide(df, period, roles, fill, regions, categories),
        table.drop("known"),
        table,
    )
