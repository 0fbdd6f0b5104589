"""Incremental loading of the multi-level table (O1 for files that keep arriving).

New CSV files dropped in a folder are read as text with the table's header,
relabelled and cast exactly as :func:`tierstat.sources.load_table` does, and
appended to the period-partitioned Parquet table that the batch operators
query.  The file sink keeps a transaction log next to the data and the query
keeps its progress in a checkpoint folder, so each file is loaded exactly
once even if the job or an executor dies mid-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tierstat.roles import DEFAULT, Roles
from tierstat.sources.table import is_streamed, period_label, table_exists, typed


def text_schema(columns: list[str]) -> StructType:
    """Every column as text, as the batch loader reads a header-only CSV."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def stream_table(
    spark: SparkSession,
    input_dir: str,
    columns: list[str],
    roles: Roles = DEFAULT,
    sep: str = "/",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame over the CSV files of ``input_dir``, typed like the batch load."""
    reader = spark.readStream.option("header", "true").option("enforceSchema", "false").schema(text_schema(columns))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(input_dir)
    return typed(raw.withColumn(roles.period, period_label(roles.period, sep)), roles=roles)


def start_ingest(
    spark: SparkSession,
    input_dir: str,
    output_path: str,
    columns: list[str],
    checkpoint: str | None = None,
    roles: Roles = DEFAULT,
    available_now: bool = True,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Append newly arrived files to the Parquet table at ``output_path``, partitioned by period and level.

    ``available_now`` processes what is there and stops (a scheduled job);
    otherwise the query polls every ``processing_time``.  The checkpoint
    folder is by default ``_checkpoint`` inside the table (readers skip it), so
    that every start for the same table goes on where the last one ended.  A table that
    batch writes made is refused.
    """
    if not is_streamed(spark, output_path) and table_exists(spark, output_path):
        raise ValueError(f"{output_path} holds a table written in batch; ingest into a path of its own")
    checkpoint = checkpoint or output_path.rstrip("/") + "/_checkpoint"
    writer = (
        stream_table(spark, input_dir, columns, roles)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*[c for c in (roles.period, roles.level) if c in columns])
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
