"""Members of a dimension.

Each is a distinct over one column: a partial aggregate per partition, one
shuffle of the (few) distinct values, then a sort.  Results stay DataFrames;
:func:`collect_members` is the one place a member list reaches the driver,
for pivot column lists, and it refuses lists beyond a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstat.functions.ordering import global_row_number
from tierstat.roles import DEFAULT, Roles


def members(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Distinct values of ``column`` (optionally under a filter), ascending."""
    if where is not None:
        df = df.where(where)
    return df.select(column).distinct().orderBy(column)


def members_la(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Area names at the area level (O3)."""
    return members(df, roles.area, F.col(roles.level) == roles.area_level)


def members_la_nonempty(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Area names at any level that are not empty; null is dropped too."""
    return members(df, roles.area, F.col(roles.area) != "")


def members_school_type(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Categories other than the total member, at unit level."""
    return members(
        df,
        roles.category,
        (F.col(roles.category) != roles.total) & (F.col(roles.level) == roles.unit_level),
    )


def members_period(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Periods present at national level."""
    return members(df, roles.period, F.col(roles.level) == roles.national)


def members_period_any(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Periods at any level."""
    return members(df, roles.period)


def members_region(
    df: DataFrame, period: str | list[str] | None = None, roles: Roles = DEFAULT
) -> DataFrame:
    """Regions of the regional rows.

    Without ``period``: regions of the regional ``Total`` rows.  With a
    period: regions of its regional rows per category (not ``Total``).
    """
    cond = F.col(roles.level) == roles.regional
    if period is None:
        cond = cond & (F.col(roles.category) == roles.total)
    else:
        periods = [period] if isinstance(period, str) else list(period)
        cond = cond & F.col(roles.period).isin(periods) & (F.col(roles.category) != roles.total)
    return members(df, roles.region, cond)


def column_to_list(df: DataFrame, column: str, pos: str = "pos") -> DataFrame:
    """The flattened member list of a column (O9) as rows ``(pos, value)``.

    ``pos`` counts from 0 in value order and nulls are dropped, like the
    source's flattened list.  The list stays distributed: values are
    deduplicated per partition and across one shuffle, and positions come
    from :func:`~tierstat.functions.global_row_number`, so no task and no
    driver ever holds the whole list.
    """
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return global_row_number(distinct, [column], pos).select((F.col(pos) - 1).alias(pos), column)



def collect_members(
    df: DataFrame, column: str, limit: int | None = None, spark: SparkSession | None = None
) -> list:
    """Bring a sorted member list to the driver, refusing more than ``limit`` values.

    Used for pivot column lists, the same way ``pivot`` without values does;
    the bound defaults to ``spark.sql.pivotMaxValues``.
    """
    spark = spark or df.sparkSession
    if limit is None:
        limit = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = df.select(column).distinct().where(F.col(column).isNotNull()).orderBy(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(
            f"{column} has more than {limit} members; use the long form instead of a wide grid"
        )
    return [r[0] for r in rows]


def menus(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """The three menu lists (O3 areas, O6 periods, O5 categories) from one scan.

    Output ``(menu, value)``, where ``menu`` names the column the value comes
    from.  The source application fetches the three lists with three scans.
    """
    level, cat = F.col(roles.level), F.col(roles.category)

    def entry(menu: str, column: str):
        return F.struct(F.lit(menu).alias("menu"), F.col(column).alias("value"))

    entries = F.array_compact(
        F.array(
            F.when(level == roles.area_level, entry(roles.area, roles.area)),
            F.when(level == roles.national, entry(roles.period, roles.period)),
            F.when((cat != roles.total) & (level == roles.unit_level), entry(roles.category, roles.category)),
        )
    )
    return (
        df.where(level.isin(roles.area_level, roles.national, roles.unit_level))
        .select(F.explode(entries).alias("_e"))
        .select("_e.menu", "_e.value")
        .distinct()
        .orderBy("menu", "value")
    )
