"""Report output.

Operators return DataFrames; showing one is the caller's action.  For
reports kept on storage, :func:`write_report` writes Parquet or CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierstat.functions.columns import format_percent, format_thousands


def with_formats(df: DataFrame, thousands: list[str] = (), percents: list[str] = ()) -> DataFrame:
    """Replace count columns by ``1,234`` text and percent columns by ``12.5%`` text."""
    changes = {c: format_thousands(c) for c in thousands}
    changes.update({c: format_percent(c) for c in percents})
    return df.withColumns(changes) if changes else df


def write_report(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> str:
    """Write a result frame; CSV gets a header row."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
