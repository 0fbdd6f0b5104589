"""Hand-written multi-level fixture, as text, in the shape of the absence table.

Cases covered: a non-numeric token, ``12.0`` in a count column, an empty and a
null area, equal reason totals, an all-null reason, a zero denominator, a
missing region/period cell, equal rates in one period, a rate above 10, an
area absent in one period, a category present at Regional but not at School,
a period present at Regional level only.
"""

from __future__ import annotations

COLUMNS = [
    "time_period", "geographic_level", "region_name", "la_name", "school_type",
    "num_schools", "enrolments", "enrolments_pa_10_exact",
    "sess_possible", "sess_overall", "sess_overall_pa_10_exact", "sess_overall_percent",
    "sess_unauthorised_percent",
    "sess_unauthorised",
    "sess_authorised", "sess_authorised_pa_10_exact", "sess_overall_totalreasons",
    "sess_possible_pa_10_exact", "sess_unauthorised_pa_10_exact",
    "sess_auth_appointments", "sess_auth_excluded", "sess_auth_ext_holiday", "sess_auth_holiday",
    "sess_auth_illness", "sess_auth_other", "sess_auth_religious", "sess_auth_study",
    "sess_auth_traveller", "sess_auth_totalreasons",
    "sess_unauth_holiday", "sess_unauth_late", "sess_unauth_noyet", "sess_unauth_other",
    "sess_unauth_totalreasons",
]

AUTH9 = [c for c in COLUMNS if c.startswith("sess_auth_") and c != "sess_auth_totalreasons"]
UNAUTH4 = [c for c in COLUMNS if c.startswith("sess_unauth_") and c != "sess_unauth_totalreasons"]


def _row(period, level, region="", la="", stype="Total", **measures):
    out = {c: "" for c in COLUMNS}
    out.update(time_period=period, geographic_level=level, region_name=region, la_name=la, school_type=stype)
    for k, v in measures.items():
        out[k] = v
    return out


def _auth(*values):
    return {c: v for c, v in zip(AUTH9, values)}


def _unauth(*values):
    return {c: v for c, v in zip(UNAUTH4, values)}


P1, P2 = "200607", "200708"  # labelled 2006/07 and 2007/08

ROWS = [
    # National totals: reasons with a tie (holiday = illness = 50 in P1), and
    # `traveller` null in every row (an all-null reason).
    _row(P1, "National", sess_overall_percent="4.5",
         **_auth("10", "5", "5", "50", "50", "1", "0", "0", ""), sess_auth_totalreasons="121"),
    _row(P2, "National", sess_overall_percent="4.6",
         **_auth("70", "5", "5", "20", "60", "1", "0", "", ""), sess_auth_totalreasons="161"),
    # National by category: medical totals; Secondary has a null illness.
    _row(P2, "National", stype="Primary", **_auth("3", "", "", "", "4", "", "", "", "")),
    _row(P2, "National", stype="Secondary", **_auth("6", "", "", "", "", "", "", "", "")),
    # Regional totals: equal rates in P1 (East = South = 4.5), a rate above 10
    # (North 10.1, which sorts first as text), and South missing in P2.
    _row(P1, "Regional", "North", sess_overall_percent="10.1", sess_unauthorised="7",
         sess_unauthorised_percent="1.25"),
    _row(P1, "Regional", "South", sess_overall_percent="4.5", sess_unauthorised="8"),
    _row(P1, "Regional", "East", sess_overall_percent="4.5", sess_unauthorised="9"),
    _row(P2, "Regional", "North", sess_overall_percent="3.9", sess_unauthorised="x"),
    _row(P2, "Regional", "East", sess_overall_percent="5.0", sess_unauthorised="11"),
    # A period seen regionally but not nationally: never a grid column.
    _row("200809", "Regional", "North", sess_overall_percent="1.0", sess_unauthorised="1"),
    # Regional by category in P2: Special exists only at Regional level.
    _row(P2, "Regional", "North", stype="Primary", sess_overall_percent="3.1"),
    _row(P2, "Regional", "North", stype="Special", sess_overall_percent="7.0"),
    _row(P2, "Regional", "South", stype="Primary", sess_overall_percent="4.2"),
    _row(P2, "Regional", "East", stype="Secondary", sess_overall_percent="5.5"),
    # Area totals: York has no P1 row; Leeds P1 enrolments written as 12.0.
    _row(P1, "Local authority", "North", "Leeds", enrolments="12.0", sess_unauthorised="3"),
    _row(P2, "Local authority", "North", "Leeds", enrolments="15", sess_unauthorised="abc"),
    _row(P2, "Local authority", "North", "York", enrolments="20", sess_unauthorised="4"),
    # Area rows with an empty and a null area name.
    _row(P2, "Local authority", "North", "", enrolments="1"),
    _row(P2, "Local authority", "North", None, enrolments="2"),
    # Leeds per category in P2 (the compare rows).
    _row(P2, "Local authority", "North", "Leeds", "Primary", num_schools="3", enrolments="100",
         enrolments_pa_10_exact="10", sess_possible="1000", sess_overall="50",
         sess_overall_pa_10_exact="20",
         **_auth("1", "2", "3", "4", "5", "6", "7", "8", "9"), sess_auth_totalreasons="45",
         **_unauth("1", "1", "1", "1"), sess_unauth_totalreasons="4"),
    _row(P2, "Local authority", "North", "Leeds", "Secondary", num_schools="1", enrolments="60",
         enrolments_pa_10_exact="bad", sess_possible="600", sess_overall="30",
         sess_overall_pa_10_exact="6",
         **_auth("1", "1", "1", "1", "1", "1", "1", "1", "1"), sess_auth_totalreasons="9",
         **_unauth("0", "0", "0", "0"), sess_unauth_totalreasons="0"),
    # York per category in P2, with zero possible sessions.
    _row(P2, "Local authority", "North", "York", "Primary", num_schools="2", enrolments="0",
         enrolments_pa_10_exact="0", sess_possible="0", sess_overall="0",
         sess_overall_pa_10_exact="0", **_unauth("0", "0", "0", "0"), sess_unauth_totalreasons="0"),
    # School rows: categories Primary and Secondary only.
    _row(P2, "School", "North", "Leeds", "Primary", num_schools="1"),
    _row(P2, "School", "North", "Leeds", "Secondary", num_schools="1"),
    _row(P2, "School", "North", "York", "Primary", num_schools="1"),
]


def csv_text() -> str:
    """The fixture as CSV: a null cell is an empty field, the empty area name is ``""``."""
    lines = [",".join(COLUMNS)]
    for r in ROWS:
        cells = []
        for c in COLUMNS:
            v = r[c]
            cells.append('""' if (c == "la_name" and v == "") else ("" if v is None else v))
        lines.append(",".join(cells))
    return "\n".join(lines) + "\n"
