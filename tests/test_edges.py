"""Every operator on an empty table: no error, sensible (mostly empty) results."""

import pytest
from pyspark.sql import functions as F

from golden import csv_text
from tierstat import operators as op
from tierstat.plans import absence_location_school, compare_report, region_performance
from tierstat.sources import load_table

P = "2007/08"
CALLS = {
    "members_la": lambda df: op.members_la(df),
    "menus": lambda df: op.menus(df),
    "column_to_list": lambda df: op.column_to_list(df, "la_name"),
    "enrolment_series": lambda df: op.enrolment_series(df, "Leeds"),
    "unauthorised_by_la": lambda df: op.unauthorised_by_la(df, P),
    "reason_totals": lambda df: op.reason_totals(df),
    "top_reasons": lambda df: op.top_reasons(df),
    "top_reasons_long": lambda df: op.top_reasons_long(df),
    "compare_authorised": lambda df: op.compare_authorised(df, ["Leeds", "York"], P),
    "school_type_share": lambda df: op.school_type_share(df, ["Leeds"], P),
    "session_split": lambda df: op.session_split(df, ["Leeds"], P),
    "rate_series_with_national": lambda df: op.rate_series_with_national(df),
    "rate_matrix": lambda df: op.rate_matrix(df),
    "rate_matrix_wide": lambda df: op.rate_matrix_wide(df),
    "rank_matrix": lambda df: op.rank_matrix(df),
    "mean_rank": lambda df: op.mean_rank(df),
    "region_ranking": lambda df: op.region_ranking(df),
    "type_region_matrix": lambda df: op.type_region_matrix(df, P),
    "type_region_matrix_wide": lambda df: op.type_region_matrix_wide(df, P),
    "compare_report": lambda df: compare_report(df, "Leeds", "York", P),
    "region_performance": lambda df: region_performance(df).table,
    "absence_location_school": lambda df: absence_location_school(df, P).grid,
}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty") / "absence.csv"
    path.write_text(csv_text())
    return load_table(spark, str(path)).where(F.lit(False))


@pytest.mark.parametrize("name", sorted(CALLS))
def test_operator_on_empty_table(empty, name):
    assert CALLS[name](empty).count() == 0


def test_global_aggregate_on_empty_table_is_one_null_row(empty):
    assert [tuple(r) for r in op.medical_absence_total(empty, "Primary", P).collect()] == [(None, None, None)]


@pytest.fixture(scope="module")
def null_measures(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("nulls") / "absence.csv"
    path.write_text(csv_text())
    df = load_table(spark, str(path))
    dims = {"time_period", "geographic_level", "region_name", "la_name", "school_type"}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in df.dtypes if c not in dims})


@pytest.mark.parametrize("name", sorted(CALLS))
def test_operator_on_all_null_measures(null_measures, name):
    assert CALLS[name](null_measures).count() >= 0


def test_all_null_rates_rank_by_name(null_measures):
    """Every cell counts as 0, so every period is a full tie and names decide."""
    ranking = [tuple(r) for r in op.region_ranking(null_measures).collect()]
    assert ranking == [(1, "East"), (2, "North"), (3, "South")]
