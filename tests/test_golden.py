"""Operators on the hand-written fixture, with hand-computed expectations."""

import pytest
from pyspark.sql import functions as F

from golden import AUTH9, ROWS, csv_text
from tierstat import operators as op
from tierstat.functions import format_percent, format_thousands
from tierstat.plans import absence_location_school, compare_report, region_performance
from tierstat.sources import load_table

P1, P2 = "2006/07", "2007/08"


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("golden") / "absence.csv"
    path.write_text(csv_text())
    return load_table(spark, str(path))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_load_casts_leniently(golden):
    leeds = golden.where((F.col("la_name") == "Leeds") & (F.col("school_type") == "Total"))
    got = {r.time_period: (r.enrolments, r.sess_unauthorised) for r in leeds.collect()}
    assert got == {P1: (12, 3), P2: (15, None)}  # '12.0' -> 12, 'abc' -> null
    assert dict(golden.dtypes)["sess_overall_percent"] == "double"
    assert dict(golden.dtypes)["sess_unauthorised_percent"] == "double"  # any *percent column
    north = golden.where((F.col("region_name") == "North") & (F.col("time_period") == P1)
                         & (F.col("geographic_level") == "Regional"))
    assert north.first().sess_unauthorised_percent == 1.25
    bad = golden.where((F.col("la_name") == "Leeds") & (F.col("school_type") == "Secondary"))
    assert bad.first().enrolments_pa_10_exact is None  # 'bad' -> null


def test_ingest_round_trip(spark, golden, tmp_path):
    from tierstat.sources import ingest_table

    csv = tmp_path / "in.csv"
    csv.write_text(csv_text())
    stored = ingest_table(spark, str(csv), str(tmp_path / "table"))
    cols = golden.columns

    def canon(df):
        return sorted(tuple(repr(v) for v in r) for r in df.select(*cols).collect())

    assert canon(stored) == canon(golden)
    assert stored.dtypes == golden.dtypes  # same columns, same order, same types


def test_period_label_other_separator(spark):
    from tierstat.sources import period_label

    df = spark.createDataFrame([("201718",)], "p string")
    assert df.select(period_label("p", "-")).first()[0] == "2017-18"


def test_members(golden, spark):
    assert [r[0] for r in op.members_la(golden).collect()] == [None, "Leeds", "York"]
    assert [r[0] for r in op.members_la_nonempty(golden).collect()] == ["Leeds", "York"]
    with_empty = golden.union(golden.limit(1).withColumn("la_name", F.lit("")))
    assert [r[0] for r in op.members_la_nonempty(with_empty).collect()] == ["Leeds", "York"]
    assert [r[0] for r in op.members_school_type(golden).collect()] == ["Primary", "Secondary"]
    assert [r[0] for r in op.members_period(golden).collect()] == [P1, P2]
    assert [r[0] for r in op.members_period_any(golden).collect()] == [P1, P2, "2008/09"]
    assert [r[0] for r in op.members_region(golden).collect()] == ["East", "North", "South"]
    assert [r[0] for r in op.members_region(golden, P2).collect()] == ["East", "North", "South"]


def test_member_lists(golden):
    la_rows = golden.where(F.col("geographic_level") == "Local authority")
    assert rows(op.column_to_list(la_rows, "la_name").orderBy("pos")) == [(0, "Leeds"), (1, "York")]
    assert op.collect_members(la_rows, "la_name") == ["Leeds", "York"]
    with pytest.raises(ValueError):
        op.collect_members(la_rows, "la_name", limit=1)


def test_series(golden):
    assert rows(op.enrolment_series(golden, "Leeds")) == [(12, P1), (15, P2)]
    assert rows(op.enrolment_series(golden, "York")) == [(20, P2)]  # absent in P1
    assert rows(op.enrolment_series_multi(golden, ["York", "Leeds"])) == [
        ("Leeds", P1, 12), ("Leeds", P2, 15), ("York", P2, 20)
    ]


def test_medical_total(golden):
    assert rows(op.medical_absence_total(golden, "Primary", P2)) == [(3, 4, 7)]
    assert rows(op.medical_absence_total(golden, "Secondary", P2)) == [(6, None, None)]
    assert rows(op.medical_absence_total(golden, "Nursery", P2)) == [(None, None, None)]


def test_unauthorised(golden):
    assert rows(op.unauthorised_by_region(golden, P1)) == [("East", 9), ("North", 7), ("South", 8)]
    assert rows(op.unauthorised_by_la(golden, P2)) == [
        (None, None), (None, None), ("Leeds", None), ("York", 4)
    ]


def _brute_reason_totals():
    out = {}
    for r in ROWS:
        period = r["time_period"][:4] + "/" + r["time_period"][4:]
        acc = out.setdefault(period, {c: None for c in AUTH9})
        for c in AUTH9:
            if r[c] not in ("", None):
                acc[c] = (acc[c] or 0) + int(r[c])
    return out


def test_reason_totals_and_top3(golden):
    expected = _brute_reason_totals()
    got = {r.time_period: r.asDict() for r in op.reason_totals(golden).collect()}
    for period, sums in expected.items():
        for c, v in sums.items():
            assert got[period][c] == v, (period, c)
    # Heap rule restated: key (-total or 0, name), pop three.
    for period, sums in expected.items():
        keyed = sorted((-(v or 0), c[len("sess_auth_"):]) for c, v in sums.items())
        expected[period] = tuple(name for _, name in keyed[:3])
    got3 = {r[0]: tuple(r[1:]) for r in op.top_reasons(golden).collect()}
    assert got3 == expected
    assert got3[P1] == ("holiday", "illness", "appointments")  # tie 50/50 by name


def test_compare_sides_and_missing(golden):
    same = rows(op.compare_enrolment(golden, ["Leeds", "Leeds"], P2))
    assert same == [(1, "Leeds", 160, 10), (2, "Leeds", 160, 10)]
    missing = rows(op.compare_enrolment(golden, ["Nowhere", "Leeds"], P2))
    assert missing == [(2, "Leeds", 160, 10)]
    types = rows(op.compare_school_types(golden, ["Leeds", "York"], P2))
    assert types == [(1, "Leeds", "Primary", 3), (1, "Leeds", "Secondary", 1), (2, "York", "Primary", 2)]


def test_ratios(golden):
    pa = rows(op.persistent_absentee_percent(golden, ["Leeds", "York"], P2).select("la_name", "enrolments_pa_10_exact_percent"))
    assert pa == [("Leeds", 6.25), ("York", None)]  # York: zero enrolments
    split = op.session_split(golden, ["Leeds", "York"], P2)
    assert split.columns == ["side", "la_name", "normal_percent", "overall_exc_pa_percent", "overall_pa_10_exact_percent"]
    assert rows(split) == [(1, "Leeds", 95.0, 3.375, 1.625), (2, "York", None, None, None)]
    share = rows(op.school_type_share(golden, ["Leeds"], P2).select("school_type", "num_schools_percent"))
    assert share == [("Primary", 75.0), ("Secondary", 25.0)]
    auth = op.authorised_reason_percents(golden, ["Leeds"], P2).first()
    assert auth.sess_auth_appointments_percent == 3.704  # 2 / 54, HALF_UP at 3 places
    table = op.percent_table(op.authorised_reason_percents(golden, ["Leeds"], P2))
    assert table.columns[:3] == ["side", "la_name", "appointments_percent"]
    assert "totalreasons" not in " ".join(table.columns)
    unauth = op.unauthorised_reason_percents(golden, ["York"], P2).first()
    assert unauth.sess_unauth_late_percent is None  # zero total
    wide = op.session_percents_wide(golden, ["Leeds"], P2)
    assert "sess_possible_pa_10_exact_percent" in wide.columns and "sess_authorised_percent" in wide.columns


def test_rate_grid_and_ranking(golden):
    grid = {(r[0], r[1]): r[2] for r in op.rate_matrix(golden).collect()}
    assert grid[("South", P2)] == 0.0 and len(grid) == 6  # missing cell filled
    ranks = {(r[0], r[1]): r[3] for r in op.rank_matrix(golden).collect()}
    assert ranks == {
        ("East", P1): 1, ("South", P1): 2, ("North", P1): 3,  # 4.5 = 4.5 by name; 10.1 last
        ("South", P2): 1, ("North", P2): 2, ("East", P2): 3,
    }
    assert rows(op.region_ranking(golden)) == [(1, "South"), (2, "East"), (3, "North")]
    # Missing cells left out instead of counted as 0.
    assert rows(op.region_ranking(golden, fill=None)) == [(1, "East"), (2, "North"), (3, "South")]
    wide = op.rate_matrix_wide(golden)
    assert wide.columns == ["region_name", P1, P2]  # 2008/09 has no national row (H18)
    series = rows(op.rate_series_with_national(golden))
    assert ("2006/07", 4.5, "Nation Wide") in series and len(series) == 8
    assert ("2008/09", 1.0, "North") in series


def test_region_performance(golden):
    perf = region_performance(golden)
    table = {(r.region_name, r.time_period): (r.rank, r.mean_rank, r["rank (best -> worst)"]) for r in perf.table.collect()}
    assert table[("South", P2)] == (1, 1.5, 1)
    assert rows(perf.ranking.select("rank (best -> worst)", "region_name")) == [(1, "South"), (2, "East"), (3, "North")]


def test_type_region_grid(golden):
    loc = absence_location_school(golden, P2)
    assert loc.grid.columns == ["school_type", "East", "North", "South"]
    assert rows(loc.grid) == [("Primary", 0.0, 3.1, 4.2), ("Secondary", 5.5, 0.0, 0.0)]  # Special dropped
    assert rows(loc.cells.select("school_type").distinct().orderBy("school_type")) == [
        ("Primary",), ("Secondary",), ("Special",)
    ]
    assert loc.long.count() == 6


def test_compare_report(golden):
    rep = compare_report(golden, "Leeds", "York", P2)
    got = {(r.section, r.side, r.metric): (r.value, r.percent) for r in rep.collect()}
    assert got[("enrolment", 1, "enrolments")] == (160, None)
    assert got[("enrolment", 1, "enrolments_pa_10_exact")] == (10, 6.25)
    assert got[("school_type", 1, "Primary")] == (3, 75.0)
    assert got[("sessions", 1, "sess_normal")] == (1520, 95.0)
    assert got[("sessions", 2, "sess_normal")] == (0, None)
    assert got[("authorised", 1, "sess_auth_appointments")] == (2, 3.704)
    assert {k[0] for k in got} == {"enrolment", "school_type", "sessions", "session_shares", "authorised", "unauthorised"}


def test_formats(spark):
    df = spark.createDataFrame([(1234567.9, 6.25)], "n double, p double")
    assert rows(df.select(format_thousands("n"), format_percent("p"))) == [("1,234,567", "6.25%")]
    assert rows(op.with_formats(df, ["n"], ["p"])) == [("1,234,567", "6.25%")]
    odd = spark.createDataFrame([(float("nan"),), (1e30,), (None,)], "n double")
    assert rows(odd.select(format_thousands("n"))) == [(None,), (None,), (None,)]


def test_top_reasons_long(golden):
    got = rows(op.top_reasons_long(golden, 3).where(F.col("time_period") == P1).orderBy("position"))
    assert got == [(P1, 1, "holiday", 50), (P1, 2, "illness", 50), (P1, 3, "appointments", 10)]
    # k beyond the number of reasons keeps every reason once
    assert op.top_reasons_long(golden, 20).where(F.col("time_period") == P1).count() == 9
    wide = op.top_reasons(golden, 11).where(F.col("time_period") == P1).first()
    assert wide["9th"] is not None and wide["10th"] is None and wide["11th"] is None


def test_write_report_csv(spark, golden, tmp_path):
    report = op.region_ranking(golden)
    path = op.write_report(report, str(tmp_path / "ranking"), fmt="csv")
    back = spark.read.option("header", "true").csv(path)
    assert sorted((int(r[0]), r[1]) for r in back.collect()) == [(1, "South"), (2, "East"), (3, "North")]


def test_load_several_files(spark, tmp_path):
    """A table delivered in parts: every file is read with the same header and casts."""
    parts = []
    for i in range(3):
        p = tmp_path / f"part{i}.csv"
        p.write_text(csv_text())
        parts.append(str(p))
    both = load_table(spark, parts)
    assert both.count() == 3 * len(ROWS)
    assert load_table(spark, str(tmp_path)).count() == 3 * len(ROWS)  # a folder works too
    assert dict(both.dtypes)["enrolments"] == "bigint"


def test_not_total_also_drops_null_categories(golden):
    """`category != 'Total'` is null for a null category, so the row is dropped, as in the source."""
    school = golden.where(F.col("geographic_level") == "School").limit(1)
    with_null = golden.unionByName(school.withColumn("school_type", F.lit(None).cast("string")))
    assert [r[0] for r in op.members_school_type(with_null).collect()] == ["Primary", "Secondary"]
    same = rows(op.compare_school_types(with_null, ["Leeds"], P2))
    assert same == rows(op.compare_school_types(golden, ["Leeds"], P2))


def test_percent_table_keeps_any_percent_column(golden):
    """A source rate ending in `percent` passes through, renamed like the others."""
    regional = golden.where(F.col("geographic_level") == "Regional").select("la_name", "sess_overall_percent")
    table = op.percent_table(regional, keep=("la_name",))
    assert table.columns == ["la_name", "overall_percent"]


def test_given_member_lists_skip_the_collect(spark, golden):
    """With the grid columns given, building a ranking or grid runs no job before its action."""
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    ranks = op.rank_matrix(golden, periods=[P1, P2])
    grid = op.type_region_matrix_wide(golden, P2, regions=["East", "North", "South"])
    assert len(tracker.getJobIdsForGroup()) == before
    assert rows(grid) == [("Primary", 0.0, 3.1, 4.2), ("Secondary", 5.5, 0.0, 0.0)]
    assert ranks.count() == 6


def test_example_writes_every_feature(spark, tmp_path):
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location("report_example", os.path.join(os.path.dirname(__file__), "..", "examples", "report.py"))
    example = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(example)
    csv = tmp_path / "absence.csv"
    csv.write_text(csv_text())
    out = tmp_path / "out"
    written = example.main([str(csv), str(out), "--areas", "Leeds", "York", "--period", P2, "--category", "Primary"])
    assert len(written) == 11
    ranking = spark.read.parquet(written["region_ranking"]).orderBy("rank (best -> worst)")
    assert [r.region_name for r in ranking.collect()] == ["South", "East", "North"]
    assert spark.read.parquet(written["compare"]).count() > 0


def test_ingest_replaces_only_restated_periods(spark, tmp_path):
    from tierstat.sources import ingest_table

    first = tmp_path / "first.csv"
    first.write_text(csv_text())
    table_path = str(tmp_path / "table")
    ingest_table(spark, str(first), table_path)
    # A restated delivery for 2007/08 only, with every enrolment doubled.
    lines = csv_text().splitlines()
    header, body = lines[0], [line for line in lines[1:] if line.startswith("200708,")]
    idx = header.split(",").index("enrolments")

    def doubled(line):
        cells = line.split(",")
        if cells[idx] not in ("", "12.0"):
            cells[idx] = str(int(cells[idx]) * 2)
        return ",".join(cells)

    restated = tmp_path / "restated.csv"
    restated.write_text("\n".join([header] + [doubled(line) for line in body]) + "\n")
    table = ingest_table(spark, str(restated), table_path, replace_periods=True)
    leeds = {
        r.time_period: r.enrolments
        for r in table.where((F.col("la_name") == "Leeds") & (F.col("school_type") == "Total")).collect()
    }
    assert leeds == {P1: 12, P2: 30}  # 2006/07 kept as it was, 2007/08 replaced
    assert table.where(F.col("time_period") == "2008/09").count() == 1  # untouched period still there
