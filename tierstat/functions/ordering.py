"""Global and grouped 1..n positions without moving every row, or every row of a group, into one task.

``row_number().over(Window.orderBy(...))`` with no partition sends the whole
input to a single task.  Here the rows are range-partitioned and sorted by
the key, the sorted frame is checkpointed to the shared checkpoint folder (so
partition contents and order are fixed, even if an executor is lost and
tasks rerun), and each row's position is its partition's offset plus its
place inside the partition.  Only one row per partition (the partition sizes)
is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.session import checkpoint_root

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def _sorted_places(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, checkpointed, with partition and place inside it."""
    checkpoint_root(df.sparkSession)
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    return sorted_rows.withColumn("_ts_id", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_ts_id", _LOCAL_BITS).alias("_ts_part"),
        F.col("_ts_id").bitwiseAND((1 << _LOCAL_BITS) - 1).alias("_ts_local"),
    ).drop("_ts_id")


def global_row_number(df: DataFrame, order: list[str | Column], name: str = "pos") -> DataFrame:
    """Append ``name`` = 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (unique keys) for the result to be
    deterministic, as with any row_number.
    """
    tagged = _sorted_places(df, order)
    sizes = tagged.groupBy("_ts_part").agg(F.count(F.lit(1)).alias("_ts_n"))
    # One row per partition: the running total over them is tiny by construction.
    offsets = sizes.select(
        "_ts_part",
        F.coalesce(
            F.sum("_ts_n").over(
                Window.orderBy("_ts_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_ts_off"),
    )
    positioned = tagged.join(F.broadcast(offsets), "_ts_part")
    return positioned.withColumn(
        name, (F.col("_ts_off") + F.col("_ts_local") + F.lit(1)).cast("bigint")
    ).drop("_ts_part", "_ts_local", "_ts_off")


def grouped_row_number(df: DataFrame, groups: list[str], order: list[str | Column], name: str = "pos") -> DataFrame:
    """Append ``name`` = 1-based position of each row inside its group, in the order ``order``.

    The rows are range-partitioned by group and order together, so a group of
    any size is spread over as many tasks as its share of the rows.  A row's
    position is its place inside its partition, counted from the group's first
    row there, plus the group's rows in the partitions before: only one count
    per partition that the group reaches is gathered.  ``order`` must be a total order inside a group;
    nulls in ``groups`` are a group of their own.
    """
    tagged = _sorted_places(df, [*groups, *order])
    keys = [f"_ts_g{i}" for i in range(len(groups))]
    sizes = tagged.groupBy("_ts_part", *[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)]).agg(
        F.count(F.lit(1)).alias("_ts_n"), F.min("_ts_local").alias("_ts_start")
    )
    before = Window.partitionBy(*keys).orderBy("_ts_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_ts_part").alias("_ts_p"), *keys, (F.coalesce(F.sum("_ts_n").over(before), F.lit(0)) - F.col("_ts_start")).alias("_ts_off")
    )
    same = F.col("_ts_part") == F.col("_ts_p")
    for g, k in zip(groups, keys, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(k))
    positioned = tagged.join(offsets, same).withColumn(name, (F.col("_ts_off") + F.col("_ts_local") + F.lit(1)).cast("bigint"))
    return positioned.drop("_ts_part", "_ts_local", "_ts_p", "_ts_off", *keys)
