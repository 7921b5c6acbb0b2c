"""Session helpers: a local session for tests, and shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def local_session(cores: str = "*", partitions: int = 8, app: str = "wayframe") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers.

    Nothing is done when the workers inherit a path that already holds it
    (PYTHONPATH, or the repository as working directory).
    """
    on_path = any(p and Path(p).resolve() == ROOT for p in os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if on_path or Path.cwd().resolve() == ROOT:
        return
    sc = spark.sparkContext
    if getattr(sc, "_wayframe_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="wayframe")) / "wayframe_src.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in (ROOT / "wayframe").rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(out))
    sc._wayframe_shipped = True
