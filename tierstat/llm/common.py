"""Helpers shared by the operators: written tables, words, gapless ranks, components."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierstat.session import scratch_path

# A run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# A table is broadcast by hint only after its rows were counted and are at most this many
# (narrow rows of about 100 bytes, so about 20 MB).
BROADCAST_ROWS = 200_000


def ship(module: str) -> None:
    """Send the functions of ``module`` to the executors by value: the library need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; as it is (a shuffle join) if more."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: str | Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space (null: 0)."""
    return F.regexp_count(text_or_empty(c), F.lit(WORD)).cast("long")


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it (in any letter case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def gapless_rank(
    df: DataFrame, groups: list[str], spread: list[Column], order: list[Column], out: str, buckets: int
) -> DataFrame:
    """Append ``out`` = 0, 1, 2, ... inside each group, without one task per group.

    A group's rows are dealt over ``buckets`` by the MD5 of ``spread`` (nulls left out); each
    (group, bucket) is numbered by itself and shifted by the sizes of the
    buckets before it, so only counts of a group meet in one task (``buckets``
    rows).  ``groups`` must hold no nulls.  Rows equal in ``order`` and
    ``spread`` are interchangeable.
    """
    bucket = fresh([*df.columns, out], "_bucket")
    offset, n = fresh([*df.columns, out, bucket], "_offset"), fresh([*df.columns, out, bucket], "_n")
    place = F.conv(F.substr(F.md5(F.concat_ws(":", *[c.cast("string") for c in spread])), F.lit(1), F.lit(8)), 16, 10)
    dealt = df.withColumn(bucket, F.pmod(place.cast("long"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*groups, bucket)
        .agg(F.count(F.lit(1)).alias(n))
        .select(*groups, bucket, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(offset))
    )
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    return (
        dealt.withColumn(out, F.row_number().over(inside))
        .join(offsets, [*groups, bucket])
        .withColumn(out, (F.col(out) + F.col(offset) - 1).cast("long"))
        .drop(bucket, offset)
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, root)``, root the smallest node.

    Large-star and small-star steps in turn: every node points itself and its
    larger (then its smaller) neighbours to the smallest node it knows, which
    needs a number of rounds that grows with the logarithm of the longest
    path.  Each round is two aggregates and joins, written to the shared
    folder; the end is a fixed point found by comparing a count and a sum.
    """
    links = edges.select("a", "b").where(F.col("a") != F.col("b"))
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least, "a")
        links = written(
            star.where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
