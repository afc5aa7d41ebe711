"""SparkSession factory used by tests, bench and scripts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPING = threading.Lock()


def get_session(app: str = "snapledger", cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Local session with the settings every plan here assumes: UTC, AQE on.

    On a cluster the caller brings its own session; nothing below depends on
    this function having built it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SNAPLEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context.

    Operators with Python code call it, so that a cluster needs no copy installed.
    """
    with _SHIPPING:
        _ship_once(spark.sparkContext)


def _ship_once(context) -> None:
    if getattr(context, "_snapledger_shipped", False):
        return
    home = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="snapledger-"), "snapledger.zip")
    atexit.register(shutil.rmtree, target.parent, ignore_errors=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, Path(home.name, p.relative_to(home)))
    context.addPyFile(str(target))
    context._snapledger_shipped = True
