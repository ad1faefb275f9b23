"""Session factory for local use and tests; on a cluster the caller brings its own session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a context, so that they need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_quillwork_shipped", False):
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quillwork-code-")) / "quillwork.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(home.rglob("*.py")):
            z.write(path, path.relative_to(home.parent).as_posix())
    context.addPyFile(str(target))
    context._quillwork_shipped = True


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A UTC session with adaptive execution, sized for one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillwork")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUILLWORK_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
