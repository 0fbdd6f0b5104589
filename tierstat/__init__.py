"""tierstat: descriptive statistics on multi-level tables with Spark.

Subpackages: ``sources`` (loading and storing), ``functions`` (column
expressions, global positions), ``operators`` (DataFrame -> DataFrame
queries), ``plans`` (composite reports), ``streaming`` (incremental load).
"""

from tierstat.roles import DEFAULT, Roles

__all__ = ["DEFAULT", "Roles"]
