"""Invariants of the derived multi-level table, also under a skewed key."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tierstat.roles import COUNT_MEASURES
from tierstat.sources import multi_level, read_tables

ADDITIVE = [m for m in COUNT_MEASURES if m != "num_schools"]


def level_sums(stats):
    """Per (period, level): sums of every measure over that level's Total rows (School: all rows)."""
    rows = stats.where(
        (F.col("school_type") == "Total") | (F.col("geographic_level") == "School")
    )
    return {
        (r["time_period"], r["geographic_level"]): r
        for r in rows.groupBy("time_period", "geographic_level")
        .agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in ADDITIVE + ["num_schools"]])
        .collect()
    }


def assert_additive(stats):
    sums = level_sums(stats)
    periods = {p for p, _ in sums}
    for p in periods:
        national = sums[(p, "National")]
        for level in ("Regional", "Local authority", "School"):
            below = sums[(p, level)]
            for m in ADDITIVE + ["num_schools"]:
                assert below[m] == national[m], (p, level, m)


@pytest.fixture(scope="module")
def tables(spark):
    return read_tables(spark, SF01)


def test_levels_add_up(tables):
    assert_additive(multi_level(tables))


def test_levels_add_up_with_a_hot_customer(spark, tables):
    """A third of all orders moved to one customer: same totals, still additive."""
    hot = tables["customer"].agg(F.min("c_custkey")).first()[0]
    skewed = dict(tables)
    skewed["orders"] = tables["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot)).otherwise(F.col("o_custkey"))
    )
    stats = multi_level(skewed)
    assert_additive(stats)
    national = stats.where((F.col("geographic_level") == "National") & (F.col("school_type") == "Total"))
    before = multi_level(tables).where(
        (F.col("geographic_level") == "National") & (F.col("school_type") == "Total")
    )
    cols = ["time_period", "enrolments", "sess_possible", "sess_overall", "sess_auth_illness"]
    assert sorted(map(tuple, national.select(cols).collect())) == sorted(map(tuple, before.select(cols).collect()))
    hot_orders = stats.where((F.col("school_id") == hot)).agg(F.sum("enrolments")).first()[0]
    moved_with_lines = (
        tables["lineitem"].where(F.col("l_orderkey") % 3 == 0).select("l_orderkey").distinct().count()
    )
    assert hot_orders >= moved_with_lines  # orders without lines are not counted, as in the oracle
