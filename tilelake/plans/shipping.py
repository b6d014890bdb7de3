"""Makes the package importable for Python workers of a session that runs it from a source tree."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    old = env.get("PYTHONPATH", "")
    if root not in old.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, old) if x)
