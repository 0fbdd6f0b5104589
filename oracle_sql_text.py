"""DuckDB SQL used as the independent oracle for every registered query.

The ``stats`` CTE derives the multi-level table the flat way: one
GROUPING SETS aggregate over the joined base rows with COUNT(DISTINCT),
unlike the Spark build, which rolls School rows up with plain sums.  Each
oracle query is this CTE followed by its own tail.
"""

from __future__ import annotations

from tierstat.roles import AUTH_PREFIX, AUTH_REASONS, UNAUTH_PREFIX, UNAUTH_REASONS

# Reason names without their column prefix, in schema order.
AUTH = [r[len(AUTH_PREFIX):] for r in AUTH_REASONS]
UNAUTH = [r[len(UNAUTH_PREFIX):] for r in UNAUTH_REASONS]


def _auth_cols() -> str:
    return ",\n    ".join(
        f"CAST(SUM(CASE WHEN rf = 'A' AND ar = {i} THEN q END) AS BIGINT) AS sess_auth_{n}"
        for i, n in enumerate(AUTH)
    )


def _unauth_cols() -> str:
    return ",\n    ".join(
        f"CAST(SUM(CASE WHEN rf = 'R' AND ur = {i} THEN q END) AS BIGINT) AS sess_unauth_{n}"
        for i, n in enumerate(UNAUTH)
    )


STATS_CTE = f"""
WITH base AS (
  SELECT
    CAST(year(o.o_orderdate) AS VARCHAR)
      || lpad(CAST((year(o.o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS period_code,
    r.r_name AS region_name, n.n_name AS la_name, c.c_custkey AS school_id,
    c.c_mktsegment AS school_type, o.o_orderkey, o.o_orderstatus,
    CAST(l.l_quantity AS BIGINT) AS q, l.l_discount > 0.05 AS pa,
    l.l_returnflag AS rf, l.l_partkey % 9 AS ar, l.l_suppkey % 4 AS ur
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
cube AS (
  SELECT
    period_code, region_name, la_name, school_id, school_type,
    GROUPING(region_name) AS g_r, GROUPING(la_name) AS g_l,
    GROUPING(school_id) AS g_c, GROUPING(school_type) AS g_t,
    COUNT(DISTINCT school_id) AS num_schools,
    COUNT(DISTINCT o_orderkey) AS enrolments,
    COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS enrolments_pa_10_exact,
    CAST(SUM(q) AS BIGINT) AS sess_possible,
    CAST(SUM(CASE WHEN pa THEN q END) AS BIGINT) AS sess_possible_pa_10_exact,
    CAST(SUM(CASE WHEN rf IN ('A', 'R') THEN q END) AS BIGINT) AS sess_overall,
    CAST(SUM(CASE WHEN rf IN ('A', 'R') AND pa THEN q END) AS BIGINT) AS sess_overall_pa_10_exact,
    CAST(SUM(CASE WHEN rf = 'A' THEN q END) AS BIGINT) AS sess_authorised,
    CAST(SUM(CASE WHEN rf = 'A' AND pa THEN q END) AS BIGINT) AS sess_authorised_pa_10_exact,
    CAST(SUM(CASE WHEN rf = 'R' THEN q END) AS BIGINT) AS sess_unauthorised,
    CAST(SUM(CASE WHEN rf = 'R' AND pa THEN q END) AS BIGINT) AS sess_unauthorised_pa_10_exact,
    {_auth_cols()},
    {_unauth_cols()}
  FROM base
  GROUP BY GROUPING SETS (
    (period_code), (period_code, school_type),
    (period_code, region_name), (period_code, region_name, school_type),
    (period_code, region_name, la_name), (period_code, region_name, la_name, school_type),
    (period_code, region_name, la_name, school_id, school_type))
),
stats AS (
  SELECT
    regexp_replace(period_code, '(..$)', '/\\1') AS time_period,
    CASE WHEN g_c = 0 THEN 'School' WHEN g_l = 0 THEN 'Local authority'
         WHEN g_r = 0 THEN 'Regional' ELSE 'National' END AS geographic_level,
    region_name, la_name, school_id,
    CASE WHEN g_t = 1 THEN 'Total' ELSE school_type END AS school_type,
    num_schools, enrolments, enrolments_pa_10_exact,
    sess_possible, sess_possible_pa_10_exact,
    sess_overall, sess_overall_pa_10_exact, sess_overall AS sess_overall_totalreasons,
    sess_authorised, sess_authorised_pa_10_exact,
    sess_unauthorised, sess_unauthorised_pa_10_exact,
    {", ".join("sess_auth_" + n for n in AUTH)},
    sess_authorised AS sess_auth_totalreasons,
    {", ".join("sess_unauth_" + n for n in UNAUTH)},
    sess_unauthorised AS sess_unauth_totalreasons,
    round(sess_overall::DOUBLE / NULLIF(sess_possible, 0) * 100, 3) AS sess_overall_percent
  FROM cube
)
"""


def with_stats(tail: str) -> str:
    return STATS_CTE + tail
