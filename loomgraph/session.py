"""What a session needs before Python workers run this package's functions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> SparkSession:
    """Python workers find the package where the driver found it, whatever their working folder is."""
    environment = spark.sparkContext.environment
    paths = [p for p in (environment.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark
