"""Loading a multi-level table (O1, O2) and storing it for repeated queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierstat.functions.columns import col_of, lenient_double, lenient_long
from tierstat.roles import COUNT_MEASURES, DEFAULT, RATE_MEASURES, Roles

PERIOD_PATTERN = "(..$)"  # fixed value: the source's pattern (the last two characters)


def period_label(c: str | Column, sep: str = "/") -> Column:
    """Put ``sep`` before the last two characters: '201718' -> '2017/18' (O2)."""
    return F.regexp_replace(col_of(c), PERIOD_PATTERN, sep + "$1")


def typed(
    df: DataFrame,
    counts: list[str] | None = None,
    rates: list[str] | None = None,
    roles: Roles = DEFAULT,
) -> DataFrame:
    """Cast text measures once, leniently, so operators see typed columns.

    Count columns become bigint ('12.0' -> 12, a bad token -> null), rate
    columns double; other columns are left as text.  By default the rates
    are the roles' rate column, the known rate and every column whose name
    ends in ``percent``.  Columns not present in ``df`` are ignored.
    """
    counts = COUNT_MEASURES if counts is None else counts
    if rates is None:
        known = [roles.rate, *RATE_MEASURES]
        rates = known + [c for c in df.columns if c.endswith("percent") and c not in known]
    present = set(df.columns)
    casts = {c: lenient_long(c) for c in counts if c in present}
    casts.update({c: lenient_double(c) for c in rates if c in present})
    return df.withColumns(casts) if casts else df


def load_table(
    spark: SparkSession,
    path: str | list[str],
    roles: Roles = DEFAULT,
    sep: str = "/",
    relabel: bool = True,
    counts: list[str] | None = None,
    rates: list[str] | None = None,
) -> DataFrame:
    """Read a CSV with a header, every column as text, then cast measures (O1).

    No schema inference (one pass over the data, names taken from the
    header); the period code is relabelled with :func:`period_label`.  A file
    whose header has other names, or the same in another order, stops the
    query instead of filling the wrong columns.
    """
    raw = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    if relabel:
        raw = raw.withColumn(roles.period, period_label(roles.period, sep))
    return typed(raw, counts, rates, roles)


def partition_columns(df: DataFrame, roles: Roles = DEFAULT) -> list[str]:
    """The folder layout of a stored table: period, then level (both low-cardinality)."""
    return [c for c in (roles.period, roles.level) if c in df.columns]


def write_partitioned(
    df: DataFrame, path: str, roles: Roles = DEFAULT, mode: str = "overwrite", dynamic: bool = False
) -> str:
    """Store a multi-level table as Parquet partitioned by period and level.

    Nearly every query pins a level and many pin a period, so they open only
    their folders: a Regional query never touches the School files, which
    hold most of the rows.  ``rebalance`` on the folder columns lets AQE cut
    the output into partitions of the advisory size, a large folder (the
    School rows of a period, or a hot period) split over several tasks, so
    each folder gets a few well-sized files instead of one small file per
    task.  Inside a file rows are clustered by region, area, category and
    unit, so name and category predicates skip row groups by their min/max
    statistics.

    With ``dynamic``, an overwrite replaces only the folders present in
    ``df`` (new or restated periods) and keeps every other folder.  A table
    that a streaming ingest writes takes no batch writes: its readers follow
    the stream's log and would not see them.
    """
    if is_streamed(df.sparkSession, path):
        raise ValueError(f"{path} is written by a streaming ingest; load new files through it")
    parts = partition_columns(df, roles)
    order = parts + [c for c in (roles.region, roles.area, roles.category, roles.unit) if c in df.columns]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true":
        # Without AQE a rebalance is a plain hash repartition: a hot period
        # would land in one task, so the rows are then written as they are.
        df = df.hint("rebalance", *parts)
    writer = df.sortWithinPartitions(*order).write.mode(mode).partitionBy(*parts)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, by Spark's own file access (any store, no job).

    Only "not found" means no; any other error, say a refused read, is raised.
    """
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def path_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(bytes, files, time of the last change) of a file or folder, from its file system; no job."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = store.getContentSummary(jvm_path)
    return summary.getLength(), summary.getFileCount(), store.getFileStatus(jvm_path).getModificationTime()


def drop_folder(spark: SparkSession, path: str, values: dict[str, str]) -> None:
    """Delete the folder ``column=value/...`` of a table partitioned by the columns of ``values``, with its files."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{c}={escape(v)}" for c, v in values.items()]]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a streaming ingest writes the table at ``path``."""
    return path_exists(spark, path.rstrip("/") + "/_spark_metadata")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is at ``path``: a batch's commit marker or a stream's log is there."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS") or is_streamed(spark, path)


def read_partitioned(spark: SparkSession, path: str, roles: Roles = DEFAULT, schema: StructType | None = None) -> DataFrame:
    """Read a table stored by :func:`write_partitioned`, its folder columns first and as text (``schema``: if it may be empty)."""
    found = schema or spark.read.parquet(path).schema
    first = [c for c in (roles.period, roles.level) if c in found.names]
    # Folder names would otherwise be read as numbers or dates where they look like them.
    fixed = StructType([StructField(f.name, StringType() if f.name in first else f.dataType) for f in found])
    df = spark.read.schema(fixed).parquet(path)
    return df.select(*first, *[c for c in df.columns if c not in first])


def ingest_table(
    spark: SparkSession,
    csv_path: str | list[str],
    out_path: str,
    roles: Roles = DEFAULT,
    sep: str = "/",
    replace_periods: bool = False,
) -> DataFrame:
    """Load the text CSV once (O1, O2) and store it partitioned by period and level; return it.

    The source application rereads and recasts the CSV for every query.
    Here the cast and relabel happen once, and queries run on the typed
    Parquet copy with partition pruning and pushdown.  With
    ``replace_periods``, the files (say, a newly published year) replace only
    their own periods' folders in an existing table.
    """
    write_partitioned(load_table(spark, csv_path, roles, sep), out_path, roles, dynamic=replace_periods)
    return read_partitioned(spark, out_path, roles)
