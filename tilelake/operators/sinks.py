"""Output tables, status log and resume.

Outputs are Parquet tables partitioned by slide, overwritten partition by partition, so a rerun replaces just its slides.
The status row of a slide is appended after its data is committed.
"""

from __future__ import annotations

import os
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.operators import arrays

if TYPE_CHECKING:
    from tilelake.plans.config import OutputConfig

DONE, MPP_ERROR, LOAD_ERROR = "done", "mpp_extraction_error", "load_error"
STATUS = T.StructType([T.StructField("path", T.StringType()), T.StructField("stem", T.StringType()), T.StructField("status", T.StringType()), T.StructField("elapsed_s", T.DoubleType())])


def pending(slides: DataFrame, status: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Slides without a status row, by path, sorted. Failed slides count as handled unless retry_failed."""
    handled = status.where(F.col("status") == DONE) if retry_failed else status
    return slides.join(handled.select("path").distinct(), "path", "left_anti").orderBy("path")


def summary(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"), F.avg("elapsed_s").alias("mean_elapsed_s"))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STATUS).parquet(f"{path}/status")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], STATUS)
        raise


def append_status(rows: DataFrame, path: str) -> None:
    rows.select("path", "stem", "status", F.col("elapsed_s").cast("double").alias("elapsed_s")).coalesce(1).write.mode("append").parquet(f"{path}/status")


def write_status_markers(rows: DataFrame, folder: str) -> None:
    """Compatibility: one text file <stem>.done per slide in a folder that the driver sees."""
    os.makedirs(folder, exist_ok=True)
    for r in rows.select("stem", "status").toLocalIterator():
        with open(os.path.join(folder, f"{r.stem}.done"), "w") as f:
            f.write(r.status)


def write_partitioned(df: DataFrame, path: str, table: str, per_file: int = 0) -> None:
    """Overwrites the slides at hand in <path>/<table>."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    if per_file:
        w = w.option("maxRecordsPerFile", per_file)
    w.partitionBy("slide_id").parquet(f"{path}/{table}")


def write_groups(patches: DataFrame, grid: DataFrame, path: str, out: OutputConfig, patch: int, width: int) -> None:
    """The same outputs as a Zarr group for each slide."""
    rows = {"patches": ("rgb", [patch, patch, 3], "|u1", out.patches), "normalized_patches": ("normalized", [patch, patch, 3], "|u1", out.normalized_patches),
            "features": ("embedding", [width], "<f4", out.features), "coords": ("place", [2], "<i4", out.coords)}
    patches = patches.withColumn("place", F.array("x", "y"))
    columns = {name: (c, shape, dtype) for name, (c, shape, dtype, on) in rows.items() if on and c in patches.columns}
    arrays.write_zarr(patches, grid, path, columns, with_grid=out.patch_index_grid)


def write_outputs(patches: DataFrame, grid: DataFrame, path: str, out: OutputConfig, patches_per_file: int = 4096, patch: int = 224, width: int = 768) -> None:
    """patches: slide_id, row, col, x, y, rgb and, where made, normalized and embedding."""
    if out.format == "zarr":
        write_groups(patches, grid, path, out, patch, width)
        return
    place = ["slide_id", "row", "col", "x", "y"]
    if out.coords:
        write_partitioned(patches.select(*place), path, "coords")
    if out.patches:
        write_partitioned(patches.select(*place, "rgb"), path, "patches", patches_per_file)
    if out.normalized_patches:
        write_partitioned(patches.select(*place, "normalized"), path, "normalized_patches", patches_per_file)
    if out.features and "embedding" in patches.columns:
        write_partitioned(patches.select(*place, "embedding"), path, "features")
    if out.patch_index_grid:
        write_partitioned(grid.select("slide_id", "row", "col", "patch_index"), path, "patch_index_grid")


def read_results(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}")
