"""Operators on a table with other column names and level values, through Roles."""

import pytest
from pyspark.sql import functions as F

from golden import csv_text
from tierstat import operators as op
from tierstat.functions import global_row_number
from tierstat.plans import compare_report, region_performance
from tierstat.roles import Roles
from tierstat.sources import load_table

RENAMES = {
    "time_period": "year",
    "geographic_level": "tier",
    "region_name": "zone",
    "la_name": "district",
    "school_type": "kind",
    "sess_overall_percent": "rate",
}
LEVELS = {"National": "Country", "Regional": "Zone", "Local authority": "District", "School": "Site"}
ROLES = Roles(
    period="year", level="tier", region="zone", area="district", category="kind", rate="rate",
    total="All", national="Country", regional="Zone", area_level="District", unit_level="Site",
)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("roles") / "absence.csv"
    path.write_text(csv_text())
    plain = load_table(spark, str(path))
    level_map = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    renamed = plain.withColumns(
        {
            "geographic_level": level_map[F.col("geographic_level")],
            "school_type": F.when(F.col("school_type") == "Total", "All").otherwise(F.col("school_type")),
        }
    ).withColumnsRenamed(RENAMES)
    return plain, renamed


def values(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


@pytest.mark.parametrize(
    "call",
    [
        lambda df, r: op.members_la(df, r),
        lambda df, r: op.members_school_type(df, r),
        lambda df, r: op.members_period(df, r),
        lambda df, r: op.menus(df, r).select("value"),
        lambda df, r: op.enrolment_series(df, "Leeds", r),
        lambda df, r: op.unauthorised_by_region(df, "2006/07", r),
        lambda df, r: op.top_reasons(df, 3, roles=r),
        lambda df, r: op.compare_authorised(df, ["Leeds", "York"], "2007/08", r),
        lambda df, r: op.session_split(df, ["Leeds", "York"], "2007/08", r),
        lambda df, r: op.school_type_share(df, ["Leeds"], "2007/08", r),
        lambda df, r: op.rank_matrix(df, r),
        lambda df, r: op.region_ranking(df, r),
        lambda df, r: op.type_region_matrix(df, "2007/08", r),
        lambda df, r: compare_report(df, "Leeds", "York", "2007/08", r),
        lambda df, r: region_performance(df, r).table,
    ],
)
def test_same_values_under_other_names(both, call):
    plain, renamed = both
    assert values(call(plain, Roles())) == values(call(renamed, ROLES))


def test_global_row_number_on_empty_input(spark):
    empty = spark.createDataFrame([], "v int")
    assert global_row_number(empty, ["v"]).count() == 0


def test_load_table_types_the_roles_rate_column(spark, tmp_path):
    header, *body = csv_text().splitlines()
    renamed = ",".join(RENAMES.get(c, c) for c in header.split(","))
    path = tmp_path / "renamed.csv"
    path.write_text("\n".join([renamed, *body]) + "\n")
    df = load_table(spark, str(path), roles=ROLES)
    assert dict(df.dtypes)["rate"] == "double"
    assert df.where(F.col("year") == "2006/07").count() > 0  # period relabelled under its own name
