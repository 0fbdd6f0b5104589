from tierstat.operators.compare import (
    compare_authorised,
    compare_enrolment,
    compare_school_types,
    compare_sessions,
    compare_sessions_wide,
    compare_sum,
    compare_unauthorised,
    compare_unauthorised_wide,
    compare_union,
)
from tierstat.operators.matrix import (
    pivot_grid,
    rate_by_type_region,
    rate_cells,
    rate_matrix,
    rate_matrix_wide,
    type_region_matrix,
    type_region_matrix_wide,
)
from tierstat.operators.members import (
    collect_members,
    column_to_list,
    members,
    members_la,
    members_la_nonempty,
    members_period,
    members_period_any,
    members_region,
    members_school_type,
    menus,
)
from tierstat.operators.ranking import final_ranking, mean_rank, rank_cells, rank_matrix, rank_matrix_wide, region_ranking
from tierstat.operators.ratios import (
    authorised_reason_percents,
    percent_of,
    percent_table,
    percents_of,
    persistent_absentee_percent,
    school_type_share,
    session_percents_wide,
    session_split,
    unauthorised_reason_percents,
)
from tierstat.operators.series import (
    enrolment_series,
    enrolment_series_multi,
    rate_series,
    rate_series_with_national,
)
from tierstat.operators.sink import with_formats, write_report
from tierstat.operators.topk import top_reasons, top_reasons_long
from tierstat.operators.totals import (
    medical_absence_total,
    reason_totals,
    unauthorised_by,
    unauthorised_by_la,
    unauthorised_by_region,
)

__all__ = [
    "authorised_reason_percents",
    "collect_members",
    "column_to_list",
    "compare_authorised",
    "compare_enrolment",
    "compare_school_types",
    "compare_sessions",
    "compare_sessions_wide",
    "compare_sum",
    "compare_unauthorised",
    "compare_unauthorised_wide",
    "compare_union",
    "enrolment_series",
    "enrolment_series_multi",
    "final_ranking",
    "mean_rank",
    "medical_absence_total",
    "members",
    "members_la",
    "members_la_nonempty",
    "members_period",
    "members_period_any",
    "members_region",
    "members_school_type",
    "menus",
    "percent_of",
    "percent_table",
    "percents_of",
    "persistent_absentee_percent",
    "pivot_grid",
    "rank_cells",
    "rank_matrix",
    "rank_matrix_wide",
    "rate_by_type_region",
    "rate_cells",
    "rate_matrix",
    "rate_matrix_wide",
    "rate_series",
    "rate_series_with_national",
    "reason_totals",
    "region_ranking",
    "school_type_share",
    "session_percents_wide",
    "session_split",
    "top_reasons",
    "top_reasons_long",
    "type_region_matrix",
    "type_region_matrix_wide",
    "unauthorised_by",
    "unauthorised_by_la",
    "unauthorised_by_region",
    "unauthorised_reason_percents",
    "with_formats",
    "write_report",
]
