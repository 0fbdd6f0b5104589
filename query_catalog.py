"""Registered queries: each operator bound to arguments on the derived table.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame; ``ORACLE[key]`` is
DuckDB SQL over the driver's tables for the same result (column names
equal).  Every query reads the derived multi-level table of ``sf_dir``,
cut only by the level, period or area rule of its own operator (the table is itself computed from lineitem, orders, customer, nation and
region), so its work grows with the tables; ``period_label`` reads
``orders`` directly, and ``load_table`` reads a text CSV copy of the
derived table (the source application's input format).  The arguments
stand for the choices a user makes in the source application: two areas,
a period and a category.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle_sql_text import AUTH, UNAUTH, with_stats
from tierstat import operators as op
from tierstat.functions import format_percent, format_thousands, sum_columns
from tierstat.plans import absence_location_school, compare_report, region_performance
from tierstat.roles import (
    AUTH_MEASURES,
    DEFAULT,
    ENROLMENT_MEASURES,
    SESSION_MEASURES,
    SESSION_MEASURES_WIDE,
    UNAUTH_MEASURES,
    UNAUTH_MEASURES_WIDE,
    UNAUTH_REASONS,
)
from tierstat.session import app_id, scratch_path
from tierstat.sources import load_table, period_label, stats_table, table_exists, typed

# Arguments used on the test tables (areas are nations, periods order years).
LA1, LA2 = "NATION_3", "NATION_7"
PERIOD = "1997/98"
CATEGORY = "BUILDING"
LA_LEVEL = DEFAULT.area_level

Query = Callable[[SparkSession, str], DataFrame]
_CACHE: dict[tuple[str, str, str], str] = {}


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats_table(spark, sf_dir)


def _period_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    y = F.year("o_orderdate")
    code = F.concat(y.cast("string"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))
    return (
        orders.select(code.alias("period_code"))
        .distinct()
        .select("period_code", period_label("period_code").alias("time_period"))
    )


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    """The derived table written once as text CSV with raw period codes."""
    key = (app_id(spark), sf_dir, "csv")
    if key not in _CACHE or not table_exists(spark, _CACHE[key]):
        path = scratch_path(spark, "stats-csv")
        stats = _stats(spark, sf_dir)
        raw = stats.withColumn("time_period", F.regexp_replace("time_period", "/", ""))
        raw.select([F.col(c).cast("string") for c in raw.columns]).write.option("header", "true").csv(path)
        _CACHE[key] = path
    return _CACHE[key]


def _load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = load_table(spark, _csv_copy(spark, sf_dir))
    return typed(loaded, counts=["school_id"], rates=[])


def _report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the region ranking report, then read it back (the write is the work)."""
    path = scratch_path(spark, "report")
    op.write_report(op.region_ranking(_stats(spark, sf_dir)), path)
    return spark.read.parquet(path)


def _la_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("geographic_level") == LA_LEVEL)


QUERIES: dict[str, Query] = {
    "period_label": _period_codes,
    "load_table": _load_table,
    "members_la": lambda s, d: op.members_la(_stats(s, d)),
    "members_la_nonempty": lambda s, d: op.members_la_nonempty(_stats(s, d)),
    "members_school_type": lambda s, d: op.members_school_type(_stats(s, d)),
    "members_period": lambda s, d: op.members_period(_stats(s, d)),
    "members_period_any": lambda s, d: op.members_period_any(_stats(s, d)),
    "members_region": lambda s, d: op.members_region(_stats(s, d)),
    "members_region_period": lambda s, d: op.members_region(_stats(s, d), PERIOD),
    "menus": lambda s, d: op.menus(_stats(s, d)),
    "column_to_list": lambda s, d: op.column_to_list(_la_rows(_stats(s, d)), "la_name"),
    "enrolment_series": lambda s, d: op.enrolment_series(_stats(s, d), LA1),
    "enrolment_series_formatted": lambda s, d: op.with_formats(
        op.enrolment_series(_stats(s, d), LA1), thousands=["enrolments"]
    ),
    "enrolment_series_multi": lambda s, d: op.enrolment_series_multi(_stats(s, d), [LA1, LA2]),
    "medical_absence_total": lambda s, d: op.medical_absence_total(_stats(s, d), CATEGORY, PERIOD),
    "sum_columns": lambda s, d: _stats(s, d).select(
        "time_period", "geographic_level", "region_name", "la_name", "school_id", "school_type",
        sum_columns(UNAUTH_REASONS).alias("unauth_sum"),
    ),
    "unauthorised_by_la": lambda s, d: op.unauthorised_by_la(_stats(s, d), PERIOD),
    "unauthorised_by_la_formatted": lambda s, d: op.with_formats(
        op.unauthorised_by_la(_stats(s, d), PERIOD), thousands=["sess_unauthorised"]
    ),
    "unauthorised_by_region": lambda s, d: op.unauthorised_by_region(_stats(s, d), PERIOD),
    "reason_totals": lambda s, d: op.reason_totals(_stats(s, d)),
    "top3_reasons": lambda s, d: op.top_reasons(_stats(s, d), 3),
    "top3_reasons_la_total": lambda s, d: op.top_reasons(
        _stats(s, d), 3, level=LA_LEVEL, category="Total"
    ),
    "compare_sum": lambda s, d: op.compare_sum(
        _stats(s, d), ["sess_possible", "sess_overall"], LA1, PERIOD, by="school_type"
    ),
    "compare_enrolment": lambda s, d: op.compare_enrolment(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_school_types": lambda s, d: op.compare_school_types(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_authorised": lambda s, d: op.compare_authorised(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_sessions": lambda s, d: op.compare_sessions(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_sessions_wide": lambda s, d: op.compare_sessions_wide(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_unauthorised": lambda s, d: op.compare_unauthorised(_stats(s, d), [LA1, LA2], PERIOD),
    "compare_unauthorised_wide": lambda s, d: op.compare_unauthorised_wide(
        _stats(s, d), [LA1, LA2], PERIOD
    ),
    "compare_union": lambda s, d: op.compare_union(_stats(s, d), ENROLMENT_MEASURES, LA1, LA1, PERIOD),
    "percent_of": lambda s, d: op.percent_of(
        _stats(s, d).select(
            "time_period", "geographic_level", "region_name", "la_name", "school_id", "school_type", "sess_unauthorised", "sess_overall"
        ),
        "sess_unauthorised",
        "sess_overall",
    ),
    "persistent_absentee_percent": lambda s, d: op.persistent_absentee_percent(
        _stats(s, d), [LA1, LA2], PERIOD
    ),
    "authorised_reason_percents": lambda s, d: op.authorised_reason_percents(
        _stats(s, d), [LA1, LA2], PERIOD
    ),
    "unauthorised_reason_percents": lambda s, d: op.unauthorised_reason_percents(
        _stats(s, d), [LA1, LA2], PERIOD
    ),
    "school_type_share": lambda s, d: op.school_type_share(_stats(s, d), [LA1, LA2], PERIOD),
    "session_split": lambda s, d: op.session_split(_stats(s, d), [LA1, LA2], PERIOD),
    "session_percents_wide": lambda s, d: op.session_percents_wide(_stats(s, d), [LA1, LA2], PERIOD),
    "percent_table": lambda s, d: op.percent_table(
        op.authorised_reason_percents(_stats(s, d), [LA1, LA2], PERIOD)
    ),
    "rate_series": lambda s, d: op.rate_series(_stats(s, d)),
    "rate_series_with_national": lambda s, d: op.rate_series_with_national(_stats(s, d)),
    "rate_matrix": lambda s, d: op.rate_matrix(_stats(s, d)),
    "rate_matrix_wide": lambda s, d: op.rate_matrix_wide(_stats(s, d)),
    "rate_matrix_la": lambda s, d: op.rate_matrix(_stats(s, d), level=LA_LEVEL),
    "rate_series_la": lambda s, d: op.rate_series(_stats(s, d), level=LA_LEVEL),
    "rank_matrix": lambda s, d: op.rank_matrix(_stats(s, d)),
    "rank_matrix_wide": lambda s, d: op.rank_matrix_wide(_stats(s, d)),
    "rank_matrix_la": lambda s, d: op.rank_matrix(_stats(s, d), level=LA_LEVEL),
    "mean_rank_la": lambda s, d: op.mean_rank(_stats(s, d), level=LA_LEVEL),
    "mean_rank": lambda s, d: op.mean_rank(_stats(s, d)),
    "region_ranking": lambda s, d: op.region_ranking(_stats(s, d)),
    "region_ranking_la": lambda s, d: op.region_ranking(_stats(s, d), level=LA_LEVEL),
    "rate_by_type_region": lambda s, d: op.rate_by_type_region(_stats(s, d), PERIOD),
    "type_region_matrix": lambda s, d: op.type_region_matrix(_stats(s, d), PERIOD),
    "type_region_matrix_wide": lambda s, d: op.type_region_matrix_wide(_stats(s, d), PERIOD),
    "format_thousands": lambda s, d: op.compare_enrolment(_stats(s, d), [LA1, LA2], PERIOD).select(
        "side", "la_name", format_thousands("enrolments").alias("enrolments")
    ),
    "format_percent": lambda s, d: op.persistent_absentee_percent(_stats(s, d), [LA1, LA2], PERIOD).select(
        "side",
        "la_name",
        format_percent("enrolments_pa_10_exact_percent").alias("enrolments_pa_10_exact_percent"),
    ),
    "report_sink": _report_sink,
    "compare_report": lambda s, d: compare_report(_stats(s, d), LA1, LA2, PERIOD),
    "region_performance": lambda s, d: region_performance(_stats(s, d)).table,
    "region_performance_la": lambda s, d: region_performance(_stats(s, d), level=LA_LEVEL).table,
    "region_performance_series": lambda s, d: region_performance(_stats(s, d)).series,
    "absence_location_school": lambda s, d: absence_location_school(_stats(s, d), PERIOD).table,
}


# ---------------------------------------------------------------- oracle SQL

def _sum(cols: list[str]) -> str:
    return ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in cols)


def _pct(n: str, d: str, name: str | None = None) -> str:
    return f"round(({n})::DOUBLE / NULLIF({d}, 0) * 100, 3) AS {name or n + '_percent'}"


_SIDES = f", sides AS (SELECT 1 AS side, '{LA1}' AS la_name UNION ALL SELECT 2, '{LA2}')\n"
_CMP_WHERE = (
    f"st.time_period = '{PERIOD}' AND st.geographic_level = 'Local authority' "
    "AND st.school_type <> 'Total'"
)


def _compare(measures: list[str], sides: str = _SIDES, by_type: bool = False) -> str:
    keys = "s.side, st.la_name" + (", st.school_type" if by_type else "")
    return with_stats(
        sides
        + f", cmp AS (SELECT {keys}, {_sum(measures)} FROM stats st JOIN sides s "
        f"ON st.la_name = s.la_name WHERE {_CMP_WHERE} GROUP BY {keys})\n"
    )


def _members(col: str, where: str) -> str:
    return with_stats(f"SELECT DISTINCT {col} FROM stats WHERE {where}")


_AUTH_COLS = ["sess_auth_" + n for n in AUTH]
_UNAUTH_COLS = ["sess_unauth_" + n for n in UNAUTH]

_TOP3 = with_stats(
    ", t AS (SELECT time_period, {sums} FROM stats {where} GROUP BY time_period),\n"
    "u AS ({unions}),\n"
    "r AS (SELECT *, row_number() OVER (PARTITION BY time_period "
    "ORDER BY COALESCE(total, 0) DESC, reason) AS rn FROM u)\n"
    "SELECT time_period, max(CASE WHEN rn = 1 THEN reason END) AS \"1st\", "
    "max(CASE WHEN rn = 2 THEN reason END) AS \"2nd\", "
    "max(CASE WHEN rn = 3 THEN reason END) AS \"3rd\" FROM r GROUP BY time_period"
)


def _top3(where: str = "") -> str:
    return _TOP3.format(
        sums=_sum(_AUTH_COLS),
        where=where,
        unions=" UNION ALL ".join(
            f"SELECT time_period, '{n}' AS reason, sess_auth_{n} AS total FROM t" for n in AUTH
        ),
    )


_PERIODS_NAT = "SELECT DISTINCT time_period FROM stats WHERE geographic_level = 'National'"


def _grid(level: str, name: str) -> str:
    """Dense name x national-period grid with zero fill, ranks, mean rank, position."""
    return (
        f", periods AS ({_PERIODS_NAT}),\n"
        f"cells AS (SELECT {name}, time_period, sess_overall_percent FROM stats "
        f"WHERE geographic_level = '{level}' AND school_type = 'Total'),\n"
        f"names AS (SELECT DISTINCT {name} FROM cells),\n"
        f"grid AS (SELECT n.{name}, p.time_period, COALESCE(c.sess_overall_percent, 0.0) "
        f"AS sess_overall_percent FROM names n CROSS JOIN periods p LEFT JOIN cells c "
        f"ON c.{name} = n.{name} AND c.time_period = p.time_period),\n"
        f"ranks AS (SELECT *, row_number() OVER (PARTITION BY time_period "
        f"ORDER BY sess_overall_percent, {name}) AS rank FROM grid),\n"
        f"means AS (SELECT {name}, avg(rank) AS mean_rank FROM ranks GROUP BY {name}),\n"
        f"ranking AS (SELECT row_number() OVER (ORDER BY mean_rank, {name}) "
        f"AS \"rank (best -> worst)\", {name}, mean_rank FROM means)\n"
    )


# Columns of the wide grids in the oracle: the national periods and the regions
# of 1997/98 in the test tables (the same at every sf).  The Spark side does not
# use these lists; it reads the columns from the data.
_PERIOD_LIST = ["1995/96", "1996/97", "1997/98", "1998/99", "1999/00", "2000/01", "2001/02"]
_REGION_LIST = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _type_grid() -> str:
    cols = ", ".join(
        f"COALESCE(max(CASE WHEN c.region_name = '{r}' THEN c.sess_overall_percent END), 0.0) AS \"{r}\""
        for r in _REGION_LIST
    )
    return with_stats(
        ", types AS (SELECT DISTINCT school_type FROM stats WHERE school_type <> 'Total' "
        "AND geographic_level = 'School'),\n"
        f"cells AS (SELECT region_name, sess_overall_percent, school_type FROM stats WHERE "
        f"time_period = '{PERIOD}' AND geographic_level = 'Regional' AND school_type <> 'Total'),\n"
        f"wide AS (SELECT t.school_type, {cols} FROM types t LEFT JOIN cells c "
        "ON c.school_type = t.school_type GROUP BY t.school_type)\n"
    )


def _compare_report() -> str:
    area_measures = [
        "num_schools", "enrolments", "enrolments_pa_10_exact", "sess_possible", "sess_possible_pa_10_exact",
        "sess_authorised", "sess_overall", "sess_overall_pa_10_exact", *_AUTH_COLS, "sess_auth_totalreasons", *_UNAUTH_COLS,
        "sess_unauth_totalreasons",
    ]
    head = with_stats(
        _SIDES
        + ", picked AS (SELECT s.side, st.* FROM stats st JOIN sides s ON st.la_name = s.la_name "
        f"WHERE {_CMP_WHERE}),\n"
        f"area AS (SELECT side, la_name, {_sum(area_measures)} FROM picked GROUP BY side, la_name),\n"
        "types AS (SELECT side, la_name, school_type, CAST(SUM(num_schools) AS BIGINT) AS num_schools "
        "FROM picked GROUP BY side, la_name, school_type)\n"
    )
    rows: list[tuple[str, str, str, str | None]] = [
        ("enrolment", "enrolments", "enrolments", None),
        ("enrolment", "enrolments_pa_10_exact", "enrolments_pa_10_exact", "enrolments"),
        ("sessions", "sess_possible", "sess_possible", None),
        ("sessions", "sess_normal", "sess_possible - sess_overall", "sess_possible"),
        ("sessions", "sess_overall_exc_pa", "sess_overall - sess_overall_pa_10_exact", "sess_possible"),
        ("sessions", "sess_overall_pa_10_exact", "sess_overall_pa_10_exact", "sess_possible"),
    ]
    rows += [("session_shares", c, c, "sess_possible") for c in ("sess_possible_pa_10_exact", "sess_authorised")]
    rows += [("authorised", c, c, "sess_auth_totalreasons") for c in _AUTH_COLS]
    rows.append(("authorised", "sess_auth_totalreasons", "sess_auth_totalreasons", None))
    rows += [("unauthorised", c, c, "sess_unauth_totalreasons") for c in _UNAUTH_COLS]
    rows.append(("unauthorised", "sess_unauth_totalreasons", "sess_unauth_totalreasons", None))
    parts = []
    for section, metric, value, denom in rows:
        pct = _pct(value, denom, "percent") if denom else "CAST(NULL AS DOUBLE) AS percent"
        parts.append(
            f"SELECT '{section}' AS section, side, la_name, '{metric}' AS metric, "
            f"CAST({value} AS BIGINT) AS value, {pct} FROM area"
        )
    parts.append(
        "SELECT 'school_type' AS section, t.side, t.la_name, t.school_type AS metric, "
        "t.num_schools AS value, "
        + _pct("t.num_schools", "a.num_schools", "percent")
        + " FROM types t JOIN area a ON t.side = a.side AND t.la_name = a.la_name"
    )
    return head + "\nUNION ALL\n".join(parts)


_SES_SPLIT_NORMAL = "sess_possible - sess_overall"
_SES_SPLIT_EXC = "sess_overall - sess_overall_pa_10_exact"

ORACLE: dict[str, str] = {
    "period_label": (
        "SELECT DISTINCT code AS period_code, regexp_replace(code, '(..$)', '/\\1') AS time_period "
        "FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) || "
        "lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS code FROM orders)"
    ),
    "load_table": with_stats("SELECT * FROM stats"),
    "members_la": _members("la_name", "geographic_level = 'Local authority'"),
    "members_la_nonempty": _members("la_name", "la_name <> ''"),
    "members_school_type": _members(
        "school_type", "school_type <> 'Total' AND geographic_level = 'School'"
    ),
    "members_period": _members("time_period", "geographic_level = 'National'"),
    "members_period_any": with_stats("SELECT DISTINCT time_period FROM stats"),
    "members_region": _members(
        "region_name", "geographic_level = 'Regional' AND school_type = 'Total'"
    ),
    "members_region_period": _members(
        "region_name",
        f"geographic_level = 'Regional' AND school_type <> 'Total' AND time_period = '{PERIOD}'",
    ),
    "menus": with_stats(
        "SELECT 'la_name' AS menu, la_name AS value FROM stats WHERE geographic_level = 'Local authority' "
        "UNION SELECT 'time_period', time_period FROM stats WHERE geographic_level = 'National' "
        "UNION SELECT 'school_type', school_type FROM stats WHERE school_type <> 'Total' "
        "AND geographic_level = 'School'"
    ),
    "column_to_list": with_stats(
        "SELECT row_number() OVER (ORDER BY la_name) - 1 AS pos, la_name FROM "
        "(SELECT DISTINCT la_name FROM stats WHERE geographic_level = 'Local authority' "
        "AND la_name IS NOT NULL)"
    ),
    "enrolment_series": with_stats(
        f"SELECT enrolments, time_period FROM stats WHERE la_name = '{LA1}' "
        "AND geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "enrolment_series_formatted": with_stats(
        f"SELECT format('{{:,}}', enrolments) AS enrolments, time_period FROM stats WHERE la_name = '{LA1}' "
        "AND geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "enrolment_series_multi": with_stats(
        f"SELECT la_name, time_period, enrolments FROM stats WHERE la_name IN ('{LA1}', '{LA2}') "
        "AND geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "medical_absence_total": with_stats(
        ", m AS (SELECT CAST(SUM(sess_auth_appointments) AS BIGINT) AS sess_auth_appointments, "
        "CAST(SUM(sess_auth_illness) AS BIGINT) AS sess_auth_illness FROM stats "
        f"WHERE time_period = '{PERIOD}' AND school_type = '{CATEGORY}' "
        "AND geographic_level = 'National')\n"
        "SELECT *, sess_auth_appointments + sess_auth_illness AS total FROM m"
    ),
    "sum_columns": with_stats(
        "SELECT time_period, geographic_level, region_name, la_name, school_id, school_type, "
        + " + ".join(_UNAUTH_COLS)
        + " AS unauth_sum FROM stats"
    ),
    "unauthorised_by_la": with_stats(
        f"SELECT la_name, sess_unauthorised FROM stats WHERE time_period = '{PERIOD}' "
        "AND geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "unauthorised_by_la_formatted": with_stats(
        f"SELECT la_name, format('{{:,}}', sess_unauthorised) AS sess_unauthorised FROM stats "
        f"WHERE time_period = '{PERIOD}' AND geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "unauthorised_by_region": with_stats(
        f"SELECT region_name, sess_unauthorised FROM stats WHERE time_period = '{PERIOD}' "
        "AND geographic_level = 'Regional' AND school_type = 'Total'"
    ),
    "reason_totals": with_stats(f"SELECT time_period, {_sum(_AUTH_COLS)} FROM stats GROUP BY time_period"),
    "top3_reasons": _top3(),
    "top3_reasons_la_total": _top3(
        "WHERE geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "compare_sum": with_stats(
        f", sides AS (SELECT 1 AS side, '{LA1}' AS la_name)\n"
        f"SELECT s.side, st.la_name, st.school_type, {_sum(['sess_possible', 'sess_overall'])} "
        f"FROM stats st JOIN sides s ON st.la_name = s.la_name WHERE {_CMP_WHERE} "
        "GROUP BY s.side, st.la_name, st.school_type"
    ),
    "compare_enrolment": _compare(ENROLMENT_MEASURES) + "SELECT * FROM cmp",
    "compare_school_types": _compare(["num_schools"], by_type=True) + "SELECT * FROM cmp",
    "compare_authorised": _compare(AUTH_MEASURES) + "SELECT * FROM cmp",
    "compare_sessions": _compare(SESSION_MEASURES) + "SELECT * FROM cmp",
    "compare_sessions_wide": _compare(SESSION_MEASURES_WIDE) + "SELECT * FROM cmp",
    "compare_unauthorised": _compare(UNAUTH_MEASURES) + "SELECT * FROM cmp",
    "compare_unauthorised_wide": _compare(UNAUTH_MEASURES_WIDE) + "SELECT * FROM cmp",
    "compare_union": _compare(
        ENROLMENT_MEASURES,
        sides=f", sides AS (SELECT 1 AS side, '{LA1}' AS la_name UNION ALL SELECT 2, '{LA1}')\n",
    )
    + "SELECT * FROM cmp",
    "percent_of": with_stats(
        "SELECT time_period, geographic_level, region_name, la_name, school_id, school_type, sess_unauthorised, sess_overall, "
        + _pct("sess_unauthorised", "sess_overall")
        + " FROM stats"
    ),
    "persistent_absentee_percent": _compare(ENROLMENT_MEASURES)
    + "SELECT *, " + _pct("enrolments_pa_10_exact", "enrolments") + " FROM cmp",
    "authorised_reason_percents": _compare(AUTH_MEASURES)
    + "SELECT *, "
    + ", ".join(_pct(c, "sess_auth_totalreasons") for c in _AUTH_COLS)
    + " FROM cmp",
    "unauthorised_reason_percents": _compare(UNAUTH_MEASURES)
    + "SELECT *, "
    + ", ".join(_pct(c, "sess_unauth_totalreasons") for c in _UNAUTH_COLS)
    + " FROM cmp",
    "school_type_share": _compare(["num_schools"], by_type=True)
    + "SELECT *, "
    + _pct("num_schools", "SUM(num_schools) OVER (PARTITION BY side, la_name)")
    + " FROM cmp",
    "session_split": _compare(SESSION_MEASURES)
    + "SELECT side, la_name, "
    + _pct(_SES_SPLIT_NORMAL, "sess_possible", "normal_percent")
    + ", "
    + _pct(_SES_SPLIT_EXC, "sess_possible", "overall_exc_pa_percent")
    + ", "
    + _pct("sess_overall_pa_10_exact", "sess_possible", "overall_pa_10_exact_percent")
    + " FROM cmp",
    "session_percents_wide": _compare(SESSION_MEASURES_WIDE)
    + "SELECT *, "
    + _pct("sess_possible_pa_10_exact", "sess_possible")
    + ", "
    + _pct("sess_authorised", "sess_possible")
    + " FROM cmp",
    "percent_table": _compare(AUTH_MEASURES)
    + "SELECT side, la_name, "
    + ", ".join(_pct(f"sess_auth_{n}", "sess_auth_totalreasons", f"{n}_percent") for n in AUTH)
    + " FROM cmp",
    "rate_series": with_stats(
        "SELECT time_period, sess_overall_percent, region_name FROM stats "
        "WHERE geographic_level = 'Regional' AND school_type = 'Total'"
    ),
    "rate_series_with_national": with_stats(
        "SELECT time_period, sess_overall_percent, "
        "CASE WHEN geographic_level = 'National' THEN 'Nation Wide' ELSE region_name END AS region_name "
        "FROM stats WHERE geographic_level IN ('National', 'Regional') AND school_type = 'Total'"
    ),
    "rate_matrix": with_stats(_grid("Regional", "region_name") + "SELECT * FROM grid"),
    "rate_matrix_wide": with_stats(
        _grid("Regional", "region_name")
        + "SELECT region_name, "
        + ", ".join(
            f"max(CASE WHEN time_period = '{p}' THEN sess_overall_percent END) AS \"{p}\""
            for p in _PERIOD_LIST
        )
        + " FROM grid GROUP BY region_name"
    ),
    "rate_matrix_la": with_stats(_grid("Local authority", "la_name") + "SELECT * FROM grid"),
    "rate_series_la": with_stats(
        "SELECT time_period, sess_overall_percent, la_name FROM stats "
        "WHERE geographic_level = 'Local authority' AND school_type = 'Total'"
    ),
    "rank_matrix": with_stats(_grid("Regional", "region_name") + "SELECT * FROM ranks"),
    "rank_matrix_wide": with_stats(
        _grid("Regional", "region_name")
        + "SELECT region_name, "
        + ", ".join(f"max(CASE WHEN time_period = '{p}' THEN rank END) AS \"{p}\"" for p in _PERIOD_LIST)
        + " FROM ranks GROUP BY region_name"
    ),
    "rank_matrix_la": with_stats(_grid("Local authority", "la_name") + "SELECT * FROM ranks"),
    "mean_rank_la": with_stats(_grid("Local authority", "la_name") + "SELECT * FROM means"),
    "mean_rank": with_stats(_grid("Regional", "region_name") + "SELECT * FROM means"),
    "region_ranking": with_stats(
        _grid("Regional", "region_name") + "SELECT \"rank (best -> worst)\", region_name FROM ranking"
    ),
    "region_ranking_la": with_stats(
        _grid("Local authority", "la_name") + "SELECT \"rank (best -> worst)\", la_name FROM ranking"
    ),
    "rate_by_type_region": with_stats(
        "SELECT region_name, sess_overall_percent, school_type FROM stats "
        f"WHERE time_period = '{PERIOD}' AND geographic_level = 'Regional' AND school_type <> 'Total'"
    ),
    "type_region_matrix": _type_grid()
    + " UNION ALL ".join(
        f"SELECT school_type, '{r}' AS region_name, \"{r}\" AS sess_overall_percent FROM wide"
        for r in _REGION_LIST
    ),
    "type_region_matrix_wide": _type_grid() + "SELECT * FROM wide",
    "format_thousands": _compare(ENROLMENT_MEASURES)
    + "SELECT side, la_name, format('{:,}', enrolments) AS enrolments FROM cmp",
    "format_percent": _compare(ENROLMENT_MEASURES)
    + "SELECT side, la_name, CAST(round(enrolments_pa_10_exact::DOUBLE / NULLIF(enrolments, 0) * 100, 3) "
    "AS VARCHAR) || '%' AS enrolments_pa_10_exact_percent FROM cmp",
    "report_sink": with_stats(
        _grid("Regional", "region_name") + "SELECT \"rank (best -> worst)\", region_name FROM ranking"
    ),
    "compare_report": _compare_report(),
    "region_performance": with_stats(
        _grid("Regional", "region_name")
        + "SELECT r.region_name, r.time_period, r.sess_overall_percent, r.rank, k.mean_rank, "
        "k.\"rank (best -> worst)\" FROM ranks r JOIN ranking k ON r.region_name = k.region_name"
    ),
    "region_performance_la": with_stats(
        _grid("Local authority", "la_name")
        + "SELECT r.la_name, r.time_period, r.sess_overall_percent, r.rank, k.mean_rank, "
        "k.\"rank (best -> worst)\" FROM ranks r JOIN ranking k ON r.la_name = k.la_name"
    ),
    "region_performance_series": with_stats(
        "SELECT time_period, sess_overall_percent, "
        "CASE WHEN geographic_level = 'National' THEN 'Nation Wide' ELSE region_name END AS region_name "
        "FROM stats WHERE geographic_level IN ('National', 'Regional') AND school_type = 'Total'"
    ),
    "absence_location_school": _type_grid()
    + "SELECT t.school_type, r.region_name, COALESCE(max(c.sess_overall_percent), 0.0) AS sess_overall_percent, "
    "CASE WHEN max(c.sess_overall_percent) IS NULL THEN 0 ELSE 1 END AS known "
    "FROM types t CROSS JOIN (SELECT DISTINCT region_name FROM cells) r LEFT JOIN cells c "
    "ON c.school_type = t.school_type AND c.region_name = r.region_name GROUP BY 1, 2",
}
