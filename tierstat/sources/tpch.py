"""Derive a multi-level statistics table from the TPC-H-like driver tables.

No absence file is available, so the operators are exercised on a table of
the same shape derived from ``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region``:

=====================  ==========================================
column                 source
=====================  ==========================================
time_period            order year y, labelled ``y/(y+1)%100``
region_name, la_name   r_name, n_name
school_id              c_custkey (School level only)
school_type            c_mktsegment, or ``Total`` when grouped away
num_schools            distinct customers
enrolments             distinct orders
enrolments_pa_10_exact distinct orders with status 'F'
sess_possible          sum of quantity
sess_overall           quantity of lines flagged 'A' or 'R'
sess_authorised        ... 'A';  sess_unauthorised ... 'R'
*_pa_10_exact          parent restricted to discount > 0.05
sess_auth_<reason>     'A' lines by partkey % 9 (reasons in schema order)
sess_unauth_<reason>   'R' lines by suppkey % 4
sess_overall_percent   round(sess_overall / sess_possible * 100, 3)
=====================  ==========================================

Plan, chosen for scale: line measures are pre-aggregated per order before
the join (one shuffle of lineitem), joined to
orders on the order key, aggregated to one row per (customer, year), and
only then joined to the customer and the two tiny dimension tables.  Lines, and
then orders, are dealt by their key over partitions whose number follows
the tables' row counts, so a task's hash tables and sorts do not grow with the
tables (nor with the file splits: nothing is combined before the shuffle, as
the lines of a split seldom share an order).  Lines are dealt as three narrow
columns, as the task that deals them may hold its whole split.  Each
customer appears once per year, so those rows are the School level as they
are, and every level above is a plain sum of School rows: these are summed once per
period, region, area and category, and the six coarser levels come out of one
GROUPING SETS aggregate over that small result, with no distinct aggregate
anywhere.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstat.roles import AUTH_REASONS, DEFAULT, UNAUTH_REASONS, Roles
from tierstat.session import app_id, scratch_path
from tierstat.sources.table import (
    drop_folder,
    path_exists,
    path_state,
    period_label,
    read_partitioned,
    table_exists,
    write_partitioned,
)

TABLES = ("lineitem", "orders", "customer", "nation", "region")

# Line measures summed per order, then per (customer, year), then per level.
_LINE_MEASURES = [
    "sess_possible",
    "sess_possible_pa_10_exact",
    "sess_overall",
    "sess_overall_pa_10_exact",
    "sess_authorised",
    "sess_authorised_pa_10_exact",
    "sess_unauthorised",
    "sess_unauthorised_pa_10_exact",
    *AUTH_REASONS,
    *UNAUTH_REASONS,
]


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES}


# The cause of a line, a number: none, an 'A' line's reason (the last: no known one), an 'R' line's reason (likewise).
_FIRST_AUTH = 1
_FIRST_UNAUTH = _FIRST_AUTH + len(AUTH_REASONS) + 1


def _narrow(lineitem: DataFrame) -> DataFrame:
    """Order key, quantity and kind (twice the cause, plus 1 where the discount is above 0.05) of each line.

    The task that deals lines may hold those of its whole split, so a row has no more columns than the measures need.
    """
    flag = F.col("l_returnflag")

    def reason(column: str, n: int) -> Column:
        rest = F.col(column) % n
        return F.when(rest >= 0, rest).otherwise(n)  # null or negative: no known reason

    cause = (
        F.when(flag == F.lit("A"), reason("l_partkey", 9) + _FIRST_AUTH)
        .when(flag == F.lit("R"), reason("l_suppkey", 4) + _FIRST_UNAUTH)
        .otherwise(0)
    )
    pa = F.when(F.col("l_discount") > F.lit(0.05), 1).otherwise(0)
    return lineitem.select("l_orderkey", F.col("l_quantity").cast("bigint").alias("_quantity"), (cause * 2 + pa).cast("int").alias("_kind"))


def _line_measures() -> list[Column]:
    """Sums of the line measures over rows of :func:`_narrow`."""
    q = F.col("_quantity")
    pa = F.col("_kind") % 2 == 1
    cause = F.shiftright("_kind", 1)
    auth = cause.between(_FIRST_AUTH, _FIRST_UNAUTH - 1)
    unauth = cause >= _FIRST_UNAUTH
    overall = cause >= _FIRST_AUTH
    out = {
        "sess_possible": q,
        "sess_possible_pa_10_exact": F.when(pa, q),
        "sess_overall": F.when(overall, q),
        "sess_overall_pa_10_exact": F.when(overall & pa, q),
        "sess_authorised": F.when(auth, q),
        "sess_authorised_pa_10_exact": F.when(auth & pa, q),
        "sess_unauthorised": F.when(unauth, q),
        "sess_unauthorised_pa_10_exact": F.when(unauth & pa, q),
    }
    for i, name in enumerate(AUTH_REASONS):
        out[name] = F.when(cause == _FIRST_AUTH + i, q)
    for i, name in enumerate(UNAUTH_REASONS):
        out[name] = F.when(cause == _FIRST_UNAUTH + i, q)
    return [F.sum(out[m]).alias(m) for m in _LINE_MEASURES]


# Rows of lines, orders or customers that a task of the build gets, about; and
# the fewest partitions (if the session has as many) that keep small tables parallel.
_ROWS_PER_TASK = 500_000
_LEAST_PARTITIONS = 32


def _dealt(df: DataFrame, key: str, *counted: DataFrame) -> DataFrame:
    """``df`` hashed by ``key`` over partitions whose number grows with the rows of the largest of ``counted``.

    Spark's own exchange before an aggregate has as many partitions as the session
    sets, however large the table.  The counts read file footers only.
    """
    least = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _LEAST_PARTITIONS)
    return df.repartition(max(least, *[-(-t.count() // _ROWS_PER_TASK) for t in counted]), key)


# The columns that the line measures read.
_LINE_COLUMNS = ["l_quantity", "l_discount", "l_returnflag", "l_partkey", "l_suppkey"]


def _dealt_lines(lines: DataFrame, tables: dict[str, DataFrame], keys: DataFrame | None) -> DataFrame:
    """Of ``lines`` (columns made of lineitem's), those of the orders ``keys`` (None: all), dealt by order key."""
    counted = (tables["lineitem"], tables["orders"])
    if keys is None:
        return _dealt(lines, "l_orderkey", *counted)
    # The join moves the lines to where the keys are; keys few enough for a broadcast make small hash tables anyway.
    return lines.join(_dealt(keys, "l_orderkey", *counted), "l_orderkey", "left_semi")


def _orders_of(orders: DataFrame, years: list[int] | None) -> DataFrame:
    """The orders of ``years`` (None: all); ranges of the raw date reach the scan."""
    if years is None:
        return orders
    day = F.col("o_orderdate")
    spans = [(day >= F.lit(f"{y}-01-01").cast("date")) & (day < F.lit(f"{y + 1}-01-01").cast("date")) for y in years]
    return orders.where(reduce(or_, spans, F.lit(False)))


def school_rows(
    tables: dict[str, DataFrame], roles: Roles = DEFAULT, years: list[int] | None = None
) -> DataFrame:
    """One row per (customer, order year): the School level, before labelling.

    With ``years``, only those order years are built: orders are filtered
    first and lineitem is reduced to their lines by a semi-join, so a yearly
    refresh does not aggregate the whole history.  Rows of lineitem, orders and
    customer are counted (from file footers) to size the shuffles.
    """
    orders = _orders_of(tables["orders"], years).select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.year("o_orderdate").alias("_year"),
        (F.col("o_orderstatus") == F.lit("F")).cast("bigint").alias("_final"),
    )
    lines = _dealt_lines(_narrow(tables["lineitem"]), tables, None if years is None else orders.select("l_orderkey"))
    per_order = lines.groupBy("l_orderkey").agg(*_line_measures())
    per_customer_year = (
        _dealt(per_order.join(orders, "l_orderkey"), "o_custkey", tables["orders"], tables["customer"])
        .groupBy("o_custkey", "_year")
        .agg(
            F.count(F.lit(1)).alias("enrolments"),
            F.sum("_final").alias("enrolments_pa_10_exact"),
            *[F.sum(m).alias(m) for m in _LINE_MEASURES],
        )
    )
    customers = tables["customer"].select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.col("c_mktsegment").alias(roles.category)
    )
    nations = tables["nation"].select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias(roles.area), "n_regionkey"
    )
    regions = tables["region"].select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias(roles.region)
    )
    code = F.concat(
        F.col("_year").cast("string"), F.lpad(((F.col("_year") + 1) % 100).cast("string"), 2, "0")
    )
    return (
        per_customer_year.join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .join(regions, "n_regionkey")
        .select(
            period_label(code).alias(roles.period),
            roles.region,
            roles.area,
            F.col("o_custkey").alias(roles.unit),
            roles.category,
            "enrolments",
            "enrolments_pa_10_exact",
            *_LINE_MEASURES,
        )
    )


def _finish(rows: DataFrame, level: Column, roles: Roles, unit: Column, category: Column) -> DataFrame:
    """Order the columns of one block of levels like the source table."""
    p, r, a = roles.period, roles.region, roles.area
    return rows.select(
        p,
        level.alias(roles.level),
        r,
        a,
        unit.alias(roles.unit),
        category.alias(roles.category),
        "num_schools",
        "enrolments",
        "enrolments_pa_10_exact",
        *_LINE_MEASURES[:2],
        "sess_overall",
        "sess_overall_pa_10_exact",
        F.col("sess_overall").alias("sess_overall_totalreasons"),
        *_LINE_MEASURES[4:8],
        *AUTH_REASONS,
        F.col("sess_authorised").alias("sess_auth_totalreasons"),
        *UNAUTH_REASONS,
        F.col("sess_unauthorised").alias("sess_unauth_totalreasons"),
        F.round(F.try_divide(F.col("sess_overall"), F.col("sess_possible")) * F.lit(100), 3).alias(
            roles.rate
        ),
    )


def multi_level(
    tables: dict[str, DataFrame], roles: Roles = DEFAULT, years: list[int] | None = None
) -> DataFrame:
    """The multi-level table: National, Regional, Local authority and School rows.

    School rows are the (customer, year) rows themselves; the six coarser
    levels are one GROUPING SETS aggregate over them.  Both blocks read the
    same upstream shuffles (Spark reuses the identical exchanges), so the raw
    tables are scanned once and the School rows, the bulk of the output, are
    not shuffled again.
    """
    schools = school_rows(tables, roles, years)
    p, r, a, t = roles.period, roles.region, roles.area, roles.category
    sets = [[p], [p, t], [p, r], [p, r, t], [p, r, a], [p, r, a, t]]
    sums = [F.sum(m).alias(m) for m in ["enrolments", "enrolments_pa_10_exact", *_LINE_MEASURES]]
    # First to one row per area and category: the grouping sets, which copy each
    # row six times, then see that small result instead of every School row.
    finest = schools.groupBy(p, r, a, t).agg(F.count(F.lit(1)).alias("num_schools"), *sums)
    cube = finest.groupingSets(sets, p, r, a, t).agg(
        F.sum("num_schools").alias("num_schools"),
        *sums,
        F.grouping(r).alias("_g_r"),
        F.grouping(a).alias("_g_a"),
        F.grouping(t).alias("_g_t"),
    )
    level = (
        F.when(F.col("_g_a") == 0, F.lit(roles.area_level))
        .when(F.col("_g_r") == 0, F.lit(roles.regional))
        .otherwise(F.lit(roles.national))
    )
    coarse = _finish(
        cube,
        level,
        roles,
        F.lit(None).cast("bigint"),
        F.when(F.col("_g_t") == 1, F.lit(roles.total)).otherwise(F.col(t)),
    )
    units = _finish(
        schools.withColumn("num_schools", F.lit(1).cast("bigint")),
        F.lit(roles.unit_level),
        roles,
        F.col(roles.unit),
        F.col(t),
    )
    return coarse.unionByName(units)


# (application, tables folder and roles, given path) -> (mark of the inputs, stored path, stored table)
_MATERIALISED: dict[tuple[str, str, str], tuple[str, str, DataFrame]] = {}


def inputs_mark(spark: SparkSession, sf_dir: str, roles: Roles = DEFAULT) -> str:
    """Names the state of the input tables: folder, roles, and each table's bytes, files and time (no job)."""
    state = [(t, *path_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")) for t in TABLES]
    return hashlib.sha256(repr((sf_dir.rstrip("/"), repr(roles), state)).encode()).hexdigest()


def year_marks(tables: dict[str, DataFrame], years: list[int] | None = None) -> dict[int, str]:
    """For each order year (or those of ``years``), counts and hash sums of its orders and lines and of the dimension tables.

    Equal marks mean that the year's rows of the stored table are still right.  One row per year comes to the driver.
    """

    def summed(df: DataFrame, columns: list[str]) -> list[Column]:
        return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")]

    dimensions = [tuple(tables[t].agg(*summed(tables[t], sorted(tables[t].columns))).first()) for t in ("customer", "nation", "region")]
    orders = _orders_of(tables["orders"], years).withColumn("_year", F.year("o_orderdate"))
    lines = tables["lineitem"].select("l_orderkey", F.xxhash64(*_LINE_COLUMNS).alias("own"))
    lines = _dealt_lines(lines, tables, None if years is None else orders.select(F.col("o_orderkey").alias("l_orderkey")))
    lines = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("decimal(38,0)")).alias("h"))
    own = F.xxhash64("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus").cast("decimal(38,0)")
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("_year").agg(
        F.count(F.lit(1)), F.sum(own), F.sum("n"), F.sum("h")
    )
    return {r[0]: hashlib.sha256(repr((dimensions, tuple(r)[1:])).encode()).hexdigest() for r in rows.collect() if r[0] is not None}


def _state_path(path: str) -> str:
    return path.rstrip("/") + "/_inputs/state"


def _stored_state(spark: SparkSession, path: str) -> dict:
    """What the table at ``path`` was made from: source, mark of all inputs, mark of each year; empty if unknown."""
    if not path_exists(spark, _state_path(path)):
        return {}
    line = spark.read.schema("value string").text(_state_path(path)).first()
    return json.loads(line[0]) if line else {}


def _store_state(spark: SparkSession, path: str, source: str, mark: str | None, years: dict[int, str]) -> None:
    state = json.dumps({"source": source, "mark": mark, "years": {str(y): m for y, m in sorted(years.items())}})
    spark.createDataFrame([(state,)], "value string").coalesce(1).write.mode("overwrite").text(_state_path(path))


def _source(sf_dir: str, roles: Roles) -> str:
    return hashlib.sha256(repr((sf_dir.rstrip("/"), repr(roles))).encode()).hexdigest()


def store_stats(
    spark: SparkSession, sf_dir: str, roles: Roles = DEFAULT, path: str | None = None
) -> DataFrame:
    """Build the multi-level table, write it, read it back.

    ``path`` names a shared location to keep it across applications; by
    default a fresh folder under the shared checkpoint folder is used.  A table that is at ``path`` already
    stays readable until the new one is complete, and stays as it was if the build fails.  The
    stored copy (Parquet partitioned by period and level) becomes the one
    :func:`stats_table` returns for ``sf_dir`` and ``path`` in this application.
    """
    mark = inputs_mark(spark, sf_dir, roles)
    tables = read_tables(spark, sf_dir)
    if path is None:
        out = write_partitioned(multi_level(tables, roles), scratch_path(spark, "stats"), roles)
    else:
        out, years = path, year_marks(tables)
        stats = multi_level(tables, roles)
        aside = write_partitioned(stats, scratch_path(spark, "stats"), roles)
        _publish(spark, read_partitioned(spark, aside, roles, stats.schema), out, roles, None)
        _store_state(spark, out, _source(sf_dir, roles), mark, years)
    return _remember(spark, sf_dir, roles, path, mark, out)


def _publish(spark: SparkSession, fresh: DataFrame, path: str, roles: Roles, periods: list[str] | None) -> None:
    """Replace the folders of ``periods`` (None: all) at ``path`` by those of the finished table ``fresh``.

    Spark moves new folders to their places only after all of them are written; folders of which the new
    table has none go last, one by one.  What the state says of the inputs is taken back first, so a
    table left half-way is never taken for a current one.
    """
    folders = [roles.period, roles.level]
    gone: list[tuple[str, str]] = []
    there = table_exists(spark, path)
    if there:
        state = _stored_state(spark, path)
        kept = {int(y): m for y, m in state.get("years", {}).items() if periods is not None and _period_name(int(y)) not in periods}
        _store_state(spark, path, state.get("source", ""), None, kept)
        old = read_partitioned(spark, path, roles)
        old = old if periods is None else old.where(F.col(roles.period).isin(periods))
        stale = old.select(*folders).distinct().join(fresh.select(*folders).distinct(), folders, "left_anti")
        gone = [tuple(r) for r in stale.collect()]  # folder names only
    write_partitioned(fresh, path, roles, dynamic=there)
    for period, level in gone:
        drop_folder(spark, path, {roles.period: period, roles.level: level})


def _remember(spark: SparkSession, sf_dir: str, roles: Roles, path: str | None, mark: str, out: str) -> DataFrame:
    # Reusing one DataFrame keeps its file listing: later queries skip it.
    stored = read_partitioned(spark, out, roles)
    _MATERIALISED[_key(spark, sf_dir, roles, path)] = (mark, out, stored)
    return stored


def _key(spark: SparkSession, sf_dir: str, roles: Roles, path: str | None) -> tuple[str, str, str]:
    return (app_id(spark), sf_dir.rstrip("/") + "|" + repr(roles), path or "")


def stats_table(
    spark: SparkSession,
    sf_dir: str,
    roles: Roles = DEFAULT,
    materialise: bool = True,
    path: str | None = None,
) -> DataFrame:
    """The multi-level table for ``sf_dir``.

    With ``materialise`` (default) it is computed once per application and
    stored (see :func:`store_stats`): later queries prune by period and push
    level and name filters into the scan, and the lineage to the raw tables
    is cut.  A stored copy is used as long as the input files are those it
    was made from, and built again when they have changed.  With ``path``, the copy is kept there, also for
    later applications, and when files of the same folder have changed only the years whose orders, lines or
    dimensions differ are built again.  A table there that was made from another folder, or not by
    this function, is an error and is not overwritten.  Without
    ``materialise``, the lazy plan over the raw tables is returned.
    """
    if not materialise:
        return multi_level(read_tables(spark, sf_dir), roles)
    mark = inputs_mark(spark, sf_dir, roles)
    known = _MATERIALISED.get(_key(spark, sf_dir, roles, path))
    if known is not None and known[0] == mark and table_exists(spark, known[1]):  # still there (not cleaned up since)
        return known[2]
    if path is None or not table_exists(spark, path):
        return store_stats(spark, sf_dir, roles, path)
    state = _stored_state(spark, path)
    if state.get("source") != _source(sf_dir, roles):
        raise ValueError(f"{path} holds a table of other inputs; store_stats() there replaces it")
    if state["mark"] != mark:
        now, then = year_marks(read_tables(spark, sf_dir)), {int(y): m for y, m in state["years"].items()}
        changed = sorted(y for y in {*now, *then} if now.get(y) != then.get(y))
        held = read_partitioned(spark, path, roles).select(roles.period).distinct().collect()  # folder names only
        changed = sorted({*changed, *[int(r[0][:4]) for r in held if int(r[0][:4]) not in now]})
        if changed:
            _rebuild(spark, sf_dir, path, changed, roles)
        _store_state(spark, path, _source(sf_dir, roles), mark, now)
    return _remember(spark, sf_dir, roles, path, mark, path)


def _rebuild(spark: SparkSession, sf_dir: str, path: str, years: list[int], roles: Roles) -> None:
    fresh = multi_level(read_tables(spark, sf_dir), roles, years)
    aside = write_partitioned(fresh, scratch_path(spark, "refreshed"), roles)  # built once; its folders are known from their names
    _publish(spark, read_partitioned(spark, aside, roles, fresh.schema), path, roles, [_period_name(y) for y in years])


def refresh_periods(
    spark: SparkSession, sf_dir: str, path: str, years: list[int], roles: Roles = DEFAULT
) -> DataFrame:
    """Rebuild only the periods of ``years`` in the table stored at ``path``.

    A period's rows depend only on that year's orders and their lines, so
    the new rows are built from those alone and replace the folders of these periods; every
    other period's files stay as they are, and a (period, level) that has lost all
    its rows loses its folder.  Only the marks of ``years`` are renewed: if the
    inputs changed in other years too, the next :func:`stats_table` finds and rebuilds these.
    """
    marks = year_marks(read_tables(spark, sf_dir), years)
    _rebuild(spark, sf_dir, path, years, roles)
    then = {int(y): m for y, m in _stored_state(spark, path)["years"].items()}
    _store_state(spark, path, _source(sf_dir, roles), None, {**then, **marks})
    _MATERIALISED.pop(_key(spark, sf_dir, roles, path), None)
    return read_partitioned(spark, path, roles)


def _period_name(year: int) -> str:
    """1999 -> '1999/00'."""
    return f"{year}/{(year + 1) % 100:02d}"
