from tierstat.sources.table import (
    ingest_table,
    load_table,
    period_label,
    read_partitioned,
    table_exists,
    typed,
    write_partitioned,
)
from tierstat.sources.tpch import (
    multi_level,
    read_tables,
    refresh_periods,
    school_rows,
    stats_table,
    store_stats,
)

__all__ = [
    "ingest_table",
    "load_table",
    "multi_level",
    "period_label",
    "read_partitioned",
    "read_tables",
    "refresh_periods",
    "school_rows",
    "stats_table",
    "store_stats",
    "table_exists",
    "typed",
    "write_partitioned",
]
