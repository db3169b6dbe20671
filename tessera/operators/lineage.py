"""What driver and executors share: the checkpoint folder where lineage ends, and this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a session on one machine, as in tests, gets one of its own where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there, so that lineage ends and nothing is computed twice."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Let executors import this package, wherever it lies on the driver."""
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tessera_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    context.addPyFile(target)
    context._tessera_shipped = True
