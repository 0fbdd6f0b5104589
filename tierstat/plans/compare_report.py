"""the whole comparison of areas in one period as one tidy frame, from one scan.

Output ``section, side, la_name, metric, value, percent``:

* ``enrolment``: enrolments; persistent absentees with their share of enrolments
* ``school_type``: schools per category with their share of the area's schools
* ``sessions``: possible sessions; attended, absent excluding persistent
  absentees, and persistent-absentee sessions, each with its share of possible
* ``session_shares``: persistent absentees' possible sessions and authorised
  absence, each with its share of possible (O33)
* ``authorised`` / ``unauthorised``: each reason and the total, with the
  reason's share of the total

One filtered scan.  The rows of the two areas are summed per side and
category and per side in one grouping-sets aggregate, in each task and then across tasks;
``inline`` turns the side's row into its sections and each category row into its share of the schools.  Expressions are
given as SQL text, parsed at once: building the query takes less time than from single columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstat.operators.compare import with_sides
from tierstat.operators.ratios import SESSION_SHARES
from tierstat.roles import (
    AUTH_REASONS,
    AUTH_TOTAL,
    DEFAULT,
    UNAUTH_REASONS,
    UNAUTH_TOTAL,
    Roles,
)

SECTIONS = ("enrolment", "school_type", "sessions", "session_shares", "authorised", "unauthorised")
_MEASURES = [
    "num_schools",
    "enrolments",
    "enrolments_pa_10_exact",
    "sess_possible",
    *SESSION_SHARES,
    "sess_overall",
    "sess_overall_pa_10_exact",
    *AUTH_REASONS,
    AUTH_TOTAL,
    *UNAUTH_REASONS,
    UNAUTH_TOTAL,
]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _entry(section: str, metric: str, value: str, denom: str | None) -> str:
    """One row of the report as SQL text; ``percent`` is the value's share of ``denom``."""
    share = "cast(null as double)" if denom is None else f"cast(round(try_divide({value}, {denom}) * 100, 3) as double)"
    return f"named_struct('section', '{section}', 'metric', {metric}, 'value', cast({value} as bigint), 'percent', {share})"


def _area_entries() -> list[str]:
    """The sections that an area has once."""
    out = [
        _entry("enrolment", "'enrolments'", "enrolments", None),
        _entry("enrolment", "'enrolments_pa_10_exact'", "enrolments_pa_10_exact", "enrolments"),
        _entry("sessions", "'sess_possible'", "sess_possible", None),
        _entry("sessions", "'sess_normal'", "(sess_possible - sess_overall)", "sess_possible"),
        _entry("sessions", "'sess_overall_exc_pa'", "(sess_overall - sess_overall_pa_10_exact)", "sess_possible"),
        _entry("sessions", "'sess_overall_pa_10_exact'", "sess_overall_pa_10_exact", "sess_possible"),
    ]
    out += [_entry("session_shares", f"'{m}'", m, "sess_possible") for m in SESSION_SHARES]
    for section, reasons, total in (("authorised", AUTH_REASONS, AUTH_TOTAL), ("unauthorised", UNAUTH_REASONS, UNAUTH_TOTAL)):
        out += [_entry(section, f"'{r}'", r, total) for r in reasons]
        out.append(_entry(section, f"'{total}'", total, None))
    return out


def compare_report(
    df: DataFrame, first: str, second: str, period: str, roles: Roles = DEFAULT
) -> DataFrame:
    """Compare two areas in ``period``, the first area first (the same area twice gives two equal sides)."""
    area, category = _quoted(roles.area), _quoted(roles.category)
    # Sums per category and per area in one aggregate, partial in each task before the shuffle.
    sums = with_sides(df, [first, second], period, roles).groupingSets(
        [["side", roles.area], ["side", roles.area, roles.category]], "side", roles.area, roles.category
    )
    sums = sums.agg(*[F.expr(f"sum({m}) as {m}") for m in _MEASURES], F.expr(f"grouping({category}) as _whole"))
    schools = f"max(if(_whole = 1, num_schools, null)) over (partition by side, {area}) as _schools"
    entries = (
        f"inline(if(_whole = 1, array({', '.join(_area_entries())}), "
        f"array({_entry('school_type', category, 'num_schools', '_schools')})))"
    )
    section = f"array_position(array({', '.join(repr(s) for s in SECTIONS)}), section)"
    report = sums.selectExpr("*", schools).selectExpr("side", area, entries)
    return report.selectExpr("section", "side", area, "metric", "value", "percent").orderBy("side", F.expr(section), "metric")
