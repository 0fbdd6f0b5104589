"""Incremental ingest, and plan properties the design relies on."""

import contextlib
import io
import re

import pytest
from conftest import SF01
from golden import COLUMNS, ROWS, csv_text
from pyspark.sql import functions as F
from query_catalog import LA1, LA2, PERIOD, QUERIES
from tierstat import operators as op
from tierstat.plans import compare_report
from tierstat.sources import load_table, stats_table
from tierstat.streaming import start_ingest


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def scans(plan: str) -> int:
    """Number of Parquet scan nodes (each has one numbered detail entry)."""
    return len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M))


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    inbox, table, ckpt = tmp_path / "inbox", tmp_path / "table", tmp_path / "ckpt"
    inbox.mkdir()
    (inbox / "part1.csv").write_text(csv_text())
    q = start_ingest(spark, str(inbox), str(table), COLUMNS, checkpoint=str(ckpt))
    q.awaitTermination(120)
    assert spark.read.parquet(str(table)).count() == len(ROWS)

    (inbox / "part2.csv").write_text(csv_text())
    q = start_ingest(spark, str(inbox), str(table), COLUMNS, checkpoint=str(ckpt))
    q.awaitTermination(120)
    streamed = spark.read.parquet(str(table))
    assert streamed.count() == 2 * len(ROWS)

    batch = load_table(spark, str(inbox / "part1.csv"))
    cols = [c for c in batch.columns if c != "time_period"]
    key = ["time_period", *cols]
    def canon(df):
        return sorted((tuple(repr(v) for v in r) for r in df.select(*key).distinct().collect()))

    a, b = canon(streamed), canon(batch)
    assert a == b
    assert dict(streamed.dtypes)["enrolments"] == "bigint"


def test_compare_report_is_one_scan_with_pushdown(spark):
    plan = plan_text(compare_report(stats_table(spark, SF01), LA1, LA2, PERIOD))
    assert scans(plan) == 1
    assert "PartitionFilters: [isnotnull(time_period" in plan  # period pruned by folder
    assert "In(la_name, [NATION_3,NATION_7])" in plan  # names pushed into the scan
    assert "Join" not in plan  # sides are tagged by a narrow explode
    first = re.search(r"^\(\d+\) Exchange", plan, flags=re.M).start()
    assert "partial_sum" in plan[:first]  # summed before anything moves


def test_top3_is_one_aggregate(spark):
    plan = plan_text(op.top_reasons(stats_table(spark, SF01), 3))
    assert "Window" not in plan and plan.count("Exchange") == 2  # the aggregate's shuffle (tree + details)
    assert scans(plan) == 1


def test_build_has_no_distinct_aggregate(spark):
    from tierstat.sources import multi_level, read_tables

    plan = plan_text(multi_level(read_tables(spark, SF01)))
    assert "count(distinct" not in plan.lower()
    assert len(re.findall(r"^\(\d+\) Expand", plan, flags=re.M)) == 1  # seven levels, one aggregate


def test_filters_reach_the_scan(spark):
    plan = plan_text(op.unauthorised_by_region(stats_table(spark, SF01), PERIOD))
    # Period and level prune folders: the School files are never opened.
    assert "(time_period#" in plan and "= 1997/98)" in plan
    assert re.search(r"PartitionFilters: \[.*\(geographic_level#\d+ = Regional\)", plan)
    assert "EqualTo(school_type,Total)" in plan  # pushed into the Parquet reader
    assert "ReadSchema: struct<region_name:string,school_type:string,sess_unauthorised:bigint>" in plan


# Queries that run a job while being built, and why: a pivot needs its column
# list (grids, rankings), global positions need a checkpoint (column_to_list,
# rankings, F2), two keys write files (the CSV copy, the report), and
# period_label opens a raw table, whose schema Spark reads from a Parquet
# footer in a small job.
EAGER = {
    "period_label",
    "rate_matrix_wide", "rank_matrix_wide", "region_ranking", "region_ranking_la", "region_performance",
    "region_performance_la", "type_region_matrix_wide", "absence_location_school", "column_to_list", "report_sink", "load_table",
    "rank_matrix_la", "mean_rank_la",  # their grids are checkpointed to be ranked over many tasks
}


def test_queries_are_lazy_except_member_lists(spark):
    """Building a query runs no job unless it needs a pivot column list, a checkpoint or a file."""
    tracker = spark.sparkContext.statusTracker()
    stats_table(spark, SF01).columns  # make sure the stored copy exists
    QUERIES["load_table"](spark, SF01)  # its CSV copy too
    eager = set()
    for key, query in QUERIES.items():
        before = len(tracker.getJobIdsForGroup())
        query(spark, SF01)
        if len(tracker.getJobIdsForGroup()) != before:
            eager.add(key)
    assert eager <= EAGER, eager - EAGER
    assert {"top3_reasons", "compare_report", "menus", "members_la", "rate_series"}.isdisjoint(eager)


def test_every_registered_query_reads_the_tables(spark):
    """Every registered query scans stored data (tables, the derived table or its checkpoint)."""
    for key, query in QUERIES.items():
        plan = plan_text(query(spark, SF01))
        assert re.search(r"^\(\d+\) Scan (parquet|csv|ExistingRDD)", plan, flags=re.M), key


def test_build_scans_lineitem_once(spark):
    """School rows and the coarser levels share the upstream shuffles (exchange reuse)."""
    from tierstat.sources import multi_level, read_tables

    df = multi_level(read_tables(spark, SF01))
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    final = buf.getvalue().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("lineitem.parquet") == 1


def _build_input(spark, n):
    """``n`` orders of two lines each by ``n // 10`` customers, spread over three years."""
    from tierstat.sources.tpch import TABLES

    order = spark.range(n)
    tables = {
        "lineitem": spark.range(2 * n).selectExpr(
            "id % {0} as l_orderkey".format(n), "id % 11 as l_partkey", "id % 7 as l_suppkey", "cast(id % 50 as double) as l_quantity",
            "0.01 * (id % 9) as l_discount", "array('A', 'R', 'N')[id % 3] as l_returnflag"),
        "orders": order.selectExpr(
            "id as o_orderkey", "id % {0} as o_custkey".format(n // 10), "date_add(date'1997-06-01', cast(365 * (id % 3) as int)) as o_orderdate",
            "if(id % 2 = 0, 'F', 'O') as o_orderstatus"),
        "customer": spark.range(n // 10).selectExpr("id as c_custkey", "id % 2 as c_nationkey", "'BUILDING' as c_mktsegment"),
        "nation": spark.range(2).selectExpr("id as n_nationkey", "concat('N', id) as n_name", "0L as n_regionkey"),
        "region": spark.range(1).selectExpr("id as r_regionkey", "'R' as r_name"),
    }
    assert set(tables) == set(TABLES)
    return tables


@pytest.mark.parametrize("years", [None, [1997, 1998, 1999]])
def test_build_partitions_grow_with_the_tables(spark, monkeypatch, years):
    """A task of the build gets no more rows of a larger table, whatever number of partitions the session sets."""
    from tierstat.sources import multi_level, tpch

    monkeypatch.setattr(tpch, "_ROWS_PER_TASK", 1000, raising=False)
    n = 20_000
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = multi_level(_build_input(spark, n), years=years)
        plan = plan_text(df)
        dealt = {key: {int(p) for p in re.findall(rf"hashpartitioning\({key}#\d+L?, (\d+)\)", plan)} for key in ("l_orderkey", "o_custkey")}
        assert dealt == {"l_orderkey": {2 * n // 1000}, "o_custkey": {n // 1000}}, dealt  # lines and orders; orders, and customers with them
        top = df.where("geographic_level = 'National' and school_type = 'Total'").agg(F.sum("enrolments"), F.sum("sess_possible"), F.sum("sess_overall"))
        assert tuple(top.first()) == (n, sum(i % 50 for i in range(2 * n)), sum(i % 50 for i in range(2 * n) if i % 3 < 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_medical_total_from_the_tables_uses_dealt_rows(spark, monkeypatch):
    """The total over the build itself: the lines' shuffle grows with them, and the sums are those of plain loops."""
    from tierstat.sources import multi_level, tpch

    monkeypatch.setattr(tpch, "_ROWS_PER_TASK", 1000, raising=False)
    n = 20_000
    total = op.medical_absence_total(multi_level(_build_input(spark, n)), "BUILDING", "1998/99")
    assert re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {2 * n // 1000}\)", plan_text(total))
    lines = [i for i in range(2 * n) if i % n % 3 == 1 and i % 3 == 0]  # orders of 1998, flag A
    reasons = {r: tpch.AUTH_REASONS.index(r) for r in ("sess_auth_appointments", "sess_auth_illness")}
    want = {r: sum(i % 50 for i in lines if i % 11 % 9 == k) for r, k in reasons.items()}
    assert total.first().asDict() == {**want, "total": sum(want.values())} and all(want.values())


def test_dealt_lines_are_narrow_and_keep_every_measure(spark):
    """A row of the lines' shuffle is key, quantity and kind, and the sums over odd lines are those of plain loops."""
    from tierstat.roles import AUTH_REASONS, UNAUTH_REASONS
    from tierstat.sources import multi_level

    n = 300
    odd = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string"
    keys = [None, -13, -9, -1, 0, *range(1, 24)]
    lines = [
        (i % n, keys[i % 28], keys[i % 27], [None, 0.0, 1.0, 7.0][i % 4], [None, 0.0, 0.05, 0.06, float("nan")][i % 5], [None, "A", "R", "N", "", "a", "R"][i % 7])
        for i in range(6000)
    ]
    df = multi_level({**_build_input(spark, n), "lineitem": spark.createDataFrame(lines, odd)})
    top = df.where("geographic_level = 'National' and school_type = 'Total'")
    got = {r["time_period"]: r.asDict() for r in top.collect()}

    def total(year, wanted):
        found = [x[3] for x in lines if x[0] % 3 == year - 1997 and x[3] is not None and wanted(x)]
        return int(sum(found)) if found else None

    def rest(key, m):  # as in SQL, where a negative key has no positive remainder
        return None if key is None or key < 0 and -(-key % m) else key % m

    for year in (1997, 1998, 1999):
        row = got[f"{year}/{(year + 1) % 100:02d}"]
        pa = [x for x in lines if x[4] is not None and (x[4] > 0.05 or x[4] != x[4])]  # NaN is the largest double
        flags = {"possible": (None, "A", "R", "N", "", "a"), "overall": ("A", "R"), "authorised": ("A",), "unauthorised": ("R",)}
        want = {f"sess_{k}": total(year, lambda x, f=f: x[5] in f) for k, f in flags.items()}
        want |= {f"sess_{k}_pa_10_exact": total(year, lambda x, f=f: x[5] in f and x in pa) for k, f in flags.items()}
        want |= {r: total(year, lambda x, k=k: x[5] == "A" and rest(x[1], 9) == k) for k, r in enumerate(AUTH_REASONS)}
        want |= {r: total(year, lambda x, k=k: x[5] == "R" and rest(x[2], 4) == k) for k, r in enumerate(UNAUTH_REASONS)}
        assert {k: row[k] for k in want} == want
    dealt = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(l_orderkey#\d+L?,", plan_text(df))
    assert ["l_orderkey", "_quantity", "_kind"] in [re.findall(r"(\w+)#", columns) for columns in dealt], dealt


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def test_no_cross_join_and_no_python_in_any_query(spark):
    """No registered query pairs all rows, runs Python per row, or gathers rows into one task."""
    for key, query in QUERIES.items():
        df = query(spark, SF01)
        plan = plan_text(df)
        for node in FORBIDDEN:
            assert node not in plan, (key, node)
        # A single-partition exchange may only carry one row per map partition:
        # partial aggregate buffers of a global aggregate (one member set for each task), or the per-partition
        # sizes of global_row_number. Never raw rows or grid cells.
        for block in plan.split("\n\n"):
            if re.match(r"^\(\d+\) Exchange", block.strip()) and "SinglePartition" in block:
                inputs = re.search(r"Input \[\d+\]: \[(.*)\]", block).group(1).split(", ")
                offsets = "_ts_part" in block and "_ts_n" in block
                partials = all(re.match(r"^(sum|count|max|min|avg|isEmpty|buf)#", c) for c in inputs)
                assert offsets or partials, (key, block)


def test_continuous_ingest_picks_up_new_files(spark, tmp_path):
    inbox, table = tmp_path / "inbox", tmp_path / "table"
    inbox.mkdir()
    (inbox / "a.csv").write_text(csv_text())
    q = start_ingest(
        spark, str(inbox), str(table), COLUMNS, checkpoint=str(tmp_path / "ckpt"),
        available_now=False, processing_time="1 second",
    )
    try:
        q.processAllAvailable()
        assert spark.read.parquet(str(table)).count() == len(ROWS)
        (inbox / "b.csv").write_text(csv_text())
        q.processAllAvailable()
        assert spark.read.parquet(str(table)).count() == 2 * len(ROWS)
    finally:
        q.stop()
