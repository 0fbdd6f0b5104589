"""Dense grids: region x period rates (O37) and category x region rates.

A grid cell missing from the data is filled (0 by default, as in the source
application).  The long form stays lazy and has no bound: the distinct row keys
meet the distinct column members, which stay a table, by an equality join on a block number,
and these marker rows and the cells meet in one aggregate.
The wide form needs its column names when the query is built: a member list
brought to the driver under the ``pivotMaxValues`` bound.  Of two cells for
one key the larger value is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.operators.members import collect_members
from tierstat.roles import DEFAULT, Roles


def pivot_grid(
    cells: DataFrame,
    row_key: str,
    col_key: str,
    value: str,
    columns: list,
    fill: float | None = 0.0,
    rows: DataFrame | None = None,
    kind: str = "double",
    ordered: bool = False,
) -> DataFrame:
    """Wide grid ``row_key, <one column per value of columns>``.

    ``rows`` (one column ``row_key``) fixes the row set: rows without cells
    are all ``fill``, cells of other rows are dropped.  Without it the rows
    are those present in ``cells``.  ``ordered`` sorts by the row key.
    """
    if not columns:  # no columns (e.g. no national period): the row keys, no cells
        return (rows if rows is not None else cells).select(row_key).distinct()
    cells = cells.select(row_key, col_key, value)
    if rows is not None:
        # The row keys join the cells as marker rows, so one aggregate yields
        # both the cells and whether the key is a row: no distinct, no join.
        types = dict(cells.dtypes)
        markers = rows.select(
            row_key,
            F.lit(None).cast(types[col_key]).alias(col_key),
            F.lit(None).cast(types[value]).alias(value),
        ).withColumn("_is_row", F.lit(1))
        cells = cells.withColumn("_is_row", F.lit(0)).unionByName(markers)
    # A pivot written as one conditional aggregate: a single map-side-combined
    # shuffle (``pivot`` with ``max`` plans two aggregates, two shuffles).
    # Columns go by position until the last step: members may be equal but for
    # their case, or named like the row key.
    places = [f"_c{i}" for i in range(len(columns))]
    found = [F.max(F.when(F.col(col_key) == F.lit(c), F.col(value))).alias(p) for p, c in zip(places, columns)]
    if rows is not None:
        wide = cells.groupBy(row_key).agg(F.max("_is_row").alias("_is_row"), *found)
        wide = wide.where(F.col("_is_row") == 1).drop("_is_row")
    else:
        wide = cells.groupBy(row_key).agg(*found)
    if ordered:
        wide = wide.orderBy(row_key)
    values = [F.col(p) if fill is None else F.coalesce(p, F.lit(fill)) for p in places]
    return wide.select(row_key, *[v.cast(kind).alias(str(n)) for v, n in zip(values, columns)])


BLOCKS = 16  # that column members are dealt over in the long grid


def grid_cells(cells: DataFrame, row_key: str, col_key: str, value: str, columns: DataFrame, rows: DataFrame) -> DataFrame:
    """``row_key, col_key, value`` for every pair of a row of ``rows`` and a member of ``columns``; null where no cell is.

    Row keys are copied to every block, a column member is in one.  Spark broadcasts the members only
    if their table is known to be small; otherwise both sides are shuffled by block, and AQE splits blocks that grow large.
    """
    kinds = dict(cells.dtypes)
    member = columns.select(F.col(columns.columns[0]).cast(kinds[col_key]).alias(col_key)).where(F.col(col_key).isNotNull()).distinct()
    member = member.withColumn("_block", F.pmod(F.xxhash64(col_key), F.lit(BLOCKS)))
    keys = rows.select(row_key).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(BLOCKS - 1).cast("bigint"))))
    marks = keys.join(member, "_block").select(row_key, col_key, F.lit(None).cast(kinds[value]).alias(value), F.lit(1).alias("_cell"))
    both = cells.select(row_key, col_key, value, F.lit(0).alias("_cell")).unionByName(marks)
    grid = both.groupBy(row_key, col_key).agg(F.max(value).cast("double").alias(value), F.max("_cell").alias("_cell"))
    return grid.where(F.col("_cell") == 1).drop("_cell")


def long_grid(
    cells: DataFrame, row_key: str, col_key: str, value: str, columns: DataFrame, fill: float | None, rows: DataFrame
) -> DataFrame:
    """:func:`grid_cells` with missing cells filled (``None``: left out)."""
    grid = grid_cells(cells, row_key, col_key, value, columns, rows)
    return grid.where(F.col(value).isNotNull()) if fill is None else grid.fillna({value: float(fill)})


def member_table(df: DataFrame, column: str, given: list | None = None) -> DataFrame:
    """The members of ``column`` (or the ``given`` ones) as a table of one column, repeats included."""
    if given is not None:
        kind = df.schema[column].dataType.simpleString()
        return df.sparkSession.createDataFrame([(m,) for m in given], f"`{column}` {kind}")
    return df.select(column)


# ---- region x period ---------------------------------------------------------


def rate_cells(df: DataFrame, roles: Roles = DEFAULT, level: str | None = None) -> DataFrame:
    """The ``Total`` rate of each member of ``level`` per period: ``name, period, rate``."""
    level = level or roles.regional
    name = roles.level_column(level)
    return df.where((F.col(roles.level) == level) & (F.col(roles.category) == roles.total)).select(
        name, roles.period, roles.rate
    )


def national_periods(df: DataFrame, roles: Roles = DEFAULT) -> list[str]:
    """The grid's columns: periods present at national level (O6), bounded."""
    return collect_members(df.where(F.col(roles.level) == roles.national), roles.period)


def rate_matrix_wide(
    df: DataFrame, roles: Roles = DEFAULT, fill: float | None = 0.0, level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """Region x period grid of the rate, one column per national period (O37, wide)."""
    level = level or roles.regional
    name = roles.level_column(level)
    periods = national_periods(df, roles) if periods is None else periods
    return pivot_grid(rate_cells(df, roles, level), name, roles.period, roles.rate, periods, fill)


def rate_matrix(
    df: DataFrame, roles: Roles = DEFAULT, fill: float | None = 0.0, level: str | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """The same grid in long form: ``name, period, rate`` for every cell.

    With ``fill=None`` missing cells are left out instead of filled.
    """
    level = level or roles.regional
    name = roles.level_column(level)
    cells = rate_cells(df, roles, level)
    columns = member_table(df.where(F.col(roles.level) == roles.national), roles.period, periods)
    return long_grid(cells, name, roles.period, roles.rate, columns, fill, cells)


# ---- category x region -------------------------------------------------------


def rate_by_type_region(df: DataFrame, period: str | list[str], roles: Roles = DEFAULT) -> DataFrame:
    """Regional rates per category in a period: ``region, rate, category``."""
    periods = [period] if isinstance(period, str) else list(period)
    return (
        df.where(
            F.col(roles.period).isin(periods)
            & (F.col(roles.level) == roles.regional)
            & (F.col(roles.category) != roles.total)
        )
        .select(roles.region, roles.rate, roles.category)
        .orderBy(roles.category, roles.region)
    )


def _type_cells(df: DataFrame, period: str, roles: Roles) -> DataFrame:
    return df.where(
        (F.col(roles.period) == period)
        & (F.col(roles.level) == roles.regional)
        & (F.col(roles.category) != roles.total)
    ).select(roles.region, roles.rate, roles.category)


def _type_rows(df: DataFrame, roles: Roles, categories: list[str] | None) -> DataFrame:
    """The unit-level categories (O5), or the given ones: then no unit row is read."""
    if categories is not None:
        return df.sparkSession.createDataFrame([(c,) for c in categories], f"`{roles.category}` string")
    return df.where((F.col(roles.category) != roles.total) & (F.col(roles.level) == roles.unit_level)).select(roles.category)


def type_region_matrix_wide(
    df: DataFrame,
    period: str,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    regions: list[str] | None = None,
    categories: list[str] | None = None,
) -> DataFrame:
    """Category x region grid of the rate in a period (O42, wide).

    Rows are the unit-level categories (O5), columns the regions of the
    period's regional rows (O8); a category found only regionally is dropped.
    ``categories`` and ``regions`` (both in ``menus`` or kept by the caller) save reading them.
    """
    cells = _type_cells(df, period, roles)
    regions = collect_members(cells, roles.region) if regions is None else regions
    rows = _type_rows(df, roles, categories)
    return pivot_grid(cells, roles.category, roles.region, roles.rate, regions, fill, rows=rows, ordered=True)


def type_region_cells(
    df: DataFrame, period: str, roles: Roles = DEFAULT, regions: list[str] | None = None, categories: list[str] | None = None
) -> DataFrame:
    """``category, region, rate`` for every cell of O42's grid, null where the data has none."""
    cells = _type_cells(df, period, roles)
    columns = member_table(cells, roles.region, regions)
    return grid_cells(cells, roles.category, roles.region, roles.rate, columns, _type_rows(df, roles, categories))


def type_region_matrix(
    df: DataFrame,
    period: str,
    roles: Roles = DEFAULT,
    fill: float | None = 0.0,
    regions: list[str] | None = None,
    categories: list[str] | None = None,
) -> DataFrame:
    """O42 in long form: ``category, region, rate`` for every cell."""
    grid = type_region_cells(df, period, roles, regions, categories)
    return grid.where(F.col(roles.rate).isNotNull()) if fill is None else grid.fillna({roles.rate: float(fill)})
