from tierstat.functions.columns import (
    format_percent,
    format_thousands,
    lenient_double,
    lenient_long,
    ordinal,
    percent,
    sum_columns,
)
from tierstat.functions.ordering import global_row_number

__all__ = [
    "format_percent",
    "format_thousands",
    "global_row_number",
    "lenient_double",
    "lenient_long",
    "ordinal",
    "percent",
    "sum_columns",
]
