"""Column roles of a multi-level statistics table.

A multi-level table holds rows for the nation, its regions, its local areas
and single units side by side, each per period and category, with a
``Total`` member standing for "all categories".  Operators take a ``Roles``
value so that they run on any table of that shape, whatever its column names.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    # The defaults are the source table's column names, its
    # category total member and its level labels.
    period: str = "time_period"
    level: str = "geographic_level"
    region: str = "region_name"
    area: str = "la_name"
    category: str = "school_type"
    unit: str = "school_id"
    rate: str = "sess_overall_percent"
    total: str = "Total"
    national: str = "National"
    regional: str = "Regional"
    area_level: str = "Local authority"
    unit_level: str = "School"

    def level_column(self, level_value: str) -> str:
        """Name column that identifies rows of a level (Regional -> region)."""
        mapping = {self.regional: self.region, self.area_level: self.area}
        if level_value not in mapping:
            raise ValueError(f"no name column for level {level_value!r}")
        return mapping[level_value]


DEFAULT = Roles()

# --- Fixed values: column names of the absence table (must stay as written) ---
AUTH_PREFIX = "sess_auth_"
UNAUTH_PREFIX = "sess_unauth_"
AUTH_REASONS = [
    "sess_auth_appointments",
    "sess_auth_excluded",
    "sess_auth_ext_holiday",
    "sess_auth_holiday",
    "sess_auth_illness",
    "sess_auth_other",
    "sess_auth_religious",
    "sess_auth_study",
    "sess_auth_traveller",
]
AUTH_TOTAL = "sess_auth_totalreasons"
UNAUTH_REASONS = [
    "sess_unauth_holiday",
    "sess_unauth_late",
    "sess_unauth_noyet",
    "sess_unauth_other",
]
UNAUTH_TOTAL = "sess_unauth_totalreasons"

ENROLMENT_MEASURES = ["enrolments", "enrolments_pa_10_exact"]
SCHOOL_MEASURES = ["num_schools"]
AUTH_MEASURES = AUTH_REASONS + [AUTH_TOTAL]
SESSION_MEASURES = ["sess_possible", "sess_overall", "sess_overall_pa_10_exact"]
SESSION_MEASURES_WIDE = [
    "sess_authorised",
    "sess_authorised_pa_10_exact",
    "sess_overall",
    "sess_overall_pa_10_exact",
    "sess_overall_totalreasons",
    "sess_possible",
    "sess_possible_pa_10_exact",
]
UNAUTH_MEASURES = UNAUTH_REASONS + [UNAUTH_TOTAL]
UNAUTH_MEASURES_WIDE = UNAUTH_MEASURES + ["sess_unauthorised", "sess_unauthorised_pa_10_exact"]

# Every count column of the table, in schema order.
COUNT_MEASURES = [
    "num_schools",
    "enrolments",
    "enrolments_pa_10_exact",
    "sess_possible",
    "sess_possible_pa_10_exact",
    "sess_overall",
    "sess_overall_pa_10_exact",
    "sess_overall_totalreasons",
    "sess_authorised",
    "sess_authorised_pa_10_exact",
    "sess_unauthorised",
    "sess_unauthorised_pa_10_exact",
    *AUTH_REASONS,
    AUTH_TOTAL,
    *UNAUTH_REASONS,
    UNAUTH_TOTAL,
]
RATE_MEASURES = ["sess_overall_percent"]
# --- end of fixed values ---
