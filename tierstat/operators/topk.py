"""Top reasons per period.

Per period, reasons are ordered by their total, largest first, a null total
counting as 0, ties by reason name; the first ``k`` are kept.  The reasons
are columns of one aggregated row (a fixed set, given by the schema), so the
ranking happens inside each row: an array of ``(-total, name)`` structs is
sorted (struct order compares the fields left to right) and sliced.  The
plan is the per-period aggregate followed by a projection: no window, no
pivot, no shuffle beyond the aggregate's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstat.functions.columns import ordinal
from tierstat.operators.totals import reason_totals
from tierstat.roles import AUTH_PREFIX, AUTH_REASONS, DEFAULT, Roles


def ranked_reasons(reasons: list[str], prefix: str = AUTH_PREFIX, k: int | None = None) -> Column:
    """Array of ``(key, reason, total)`` structs in rank order, the first ``k`` kept.

    ``key`` is ``-coalesce(total, 0)``, so ascending order is the largest total
    first with ties broken by the reason name (prefix removed).
    """
    entries = [
        F.struct(
            (-F.coalesce(F.col(r), F.lit(0))).alias("key"),
            F.lit(r[len(prefix):] if r.startswith(prefix) else r).alias("reason"),
            F.col(r).alias("total"),
        )
        for r in reasons
    ]
    ordered = F.array_sort(F.array(*entries))
    return ordered if k is None else F.slice(ordered, 1, k)


def top_reasons_long(
    df: DataFrame,
    k: int = 3,
    reasons: list[str] = AUTH_REASONS,
    prefix: str = AUTH_PREFIX,
    roles: Roles = DEFAULT,
    level: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """``(period, position, reason, total)`` for the first ``k`` reasons of each period."""
    totals = reason_totals(df, reasons, roles, level, category)
    return totals.select(roles.period, F.posexplode(ranked_reasons(reasons, prefix, k)).alias("pos", "e")).select(
        roles.period,
        (F.col("pos") + 1).cast("bigint").alias("position"),
        F.col("e.reason").alias("reason"),
        F.col("e.total").alias("total"),
    )


def top_reasons(
    df: DataFrame,
    k: int = 3,
    reasons: list[str] = AUTH_REASONS,
    prefix: str = AUTH_PREFIX,
    roles: Roles = DEFAULT,
    level: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """``time_period, 1st, 2nd, 3rd, ...``: names of the top ``k`` reasons per period."""
    totals = reason_totals(df, reasons, roles, level, category)
    top = ranked_reasons(reasons, prefix, k)
    # get() is null past the end, so k may exceed the number of reasons.
    return totals.select(
        roles.period, *[F.get(top, i).getField("reason").alias(ordinal(i + 1)) for i in range(k)]
    )
