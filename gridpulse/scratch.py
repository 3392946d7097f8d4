"""Intermediate tables in the cluster's shared folder.

Some operators need two passes over the *same* physical partitioning (global
row positions) or want a small result to be counted before it is broadcast.
Both write the intermediate once as Parquet: a written table survives executor
loss, cuts the lineage, and the second pass reads only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
_LOCAL: dict[str, str] = {}  # application id -> its own folder, in local mode only


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:  # a core setting cannot be changed in a running session
        _LOCAL[app] = tempfile.mkdtemp(prefix="gridpulse-")
    return _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/gridpulse/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    # The schema is known: reading it back with it avoids a footer-reading job.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Delete everything this application wrote below the shared folder."""
    app = spark.sparkContext.applicationId
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gridpulse/{app}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str] | str,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Join a per-key result back to the rows it came from.

    The lookup is written once and counted from its footers. Up to ``max_rows``
    it is broadcast, so a hot key in ``df`` never moves; beyond that the join is
    left to Spark (sort-merge with adaptive skew splitting).
    """
    table = lookup if stored else materialize(lookup, "lookup")
    small = table.count() <= max_rows
    keys = [on] if isinstance(on, str) else list(on)
    # A missing key is a group like any other.
    renamed = table.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`") for c in table.columns if c not in keys])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return df.join(F.broadcast(renamed) if small else renamed, same, how).drop(*[f"_key_{i}" for i in range(len(keys))])
