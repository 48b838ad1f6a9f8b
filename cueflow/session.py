"""Sessions, and sending the package to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(master: str = "local[*]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the queries expect: UTC, adaptive execution."""
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application; Python functions are looked up there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="cueflow-")) / f"{root.name}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(to))
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where it is unset and Spark runs locally (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.gettempdir()
