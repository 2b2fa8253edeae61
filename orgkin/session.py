"""Session and scratch-space helpers.

Library code never builds its own session; ``local_session`` exists for tests,
the bench and ad-hoc use on one machine.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "orgkin", **conf) -> SparkSession:
    shuffle = "8" if cpus == "*" else str(cpus)
    settings = {
        "spark.sql.shuffle.partitions": shuffle,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``spark-submit --py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="orgkin-package-"), "orgkin.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    Lives under ``spark.checkpoint.dir`` (shared storage on a cluster). Only a local session
    that leaves the setting empty, as in tests, gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        run = spark.range(1).selectExpr("uuid() AS id").first().id
        return f"{base.rstrip('/')}/{name}-{run}"
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"orgkin-{name}-")
