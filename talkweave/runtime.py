"""Session helpers: reading tables of a data folder and cutting lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and return it without its lineage.

    The folder is the session's ``spark.checkpoint.dir``, which executors share. Only on one machine (a local master)
    a folder of our own is used where that is unset; on a cluster it is an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, set if it is not yet."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="talkweave-checkpoint-"))
    return sc.getCheckpointDir()


def millis(col) -> "F.Column":
    """Seconds as DOUBLE with three decimals -> whole milliseconds."""
    return F.round(F.col(col) * 1000 if isinstance(col, str) else col * 1000).cast("bigint")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by PYTHONPATH or in the working folder anyway."""
    root = Path(__file__).resolve().parent.parent
    found = {Path(p).resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."] if p}
    app = spark.sparkContext.applicationId
    if root in found or app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="talkweave-")) / "talkweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "talkweave").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
