"""Change detection against the tracking table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detect_changes(files: DataFrame, tracking: DataFrame) -> DataFrame:
    """files (path, checksum) and tracked paths with status new, modified, unchanged, missing or unknown (no checksum).

    One full outer join on the path; a file's content isn't moved.
    """
    known = tracking.groupBy("file_path").agg(F.max("checksum").alias("old"))
    both = files.select("path", "checksum").join(known, F.col("path") == F.col("file_path"), "full_outer")
    status = (
        F.when(F.col("path").isNull(), "missing")
        .when(F.col("file_path").isNull(), "new")
        .when(F.col("checksum").isNull() | F.col("old").isNull(), "unknown")
        .when(F.col("checksum") == F.col("old"), "unchanged")
        .otherwise("modified")
    )
    return both.select(F.coalesce("path", "file_path").alias("path"), "checksum", status.alias("status"))


def to_process(changes: DataFrame, force: bool = False) -> DataFrame:
    """What a run has to read: everything there if forced, else what isn't known to be unchanged."""
    there = changes.where("status <> 'missing'")
    return there if force else there.where("status <> 'unchanged'")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("status").agg(F.count("*").alias("files"))
