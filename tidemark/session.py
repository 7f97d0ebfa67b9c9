"""Sessions, and the package's own code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(threads: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, with adaptive execution and UTC."""
    builder = SparkSession.builder.master(f"local[{threads}]").config("spark.sql.shuffle.partitions", partitions)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in (fixed | conf).items():
        builder = builder.config(k, v)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent).as_posix())
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; only where it is unset and all runs on this machine, a temporary folder of it."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (given or tempfile.mkdtemp(prefix="tidemark-")).rstrip("/")
