"""Finding slides and their metadata; template images; weights."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions import metadata
from tilelake.sources.readers import open_slide

LEVELS = "array<struct<level:int,width:int,height:int,downsample:double>>"


def find_slides(spark: SparkSession, folder: str, glob: str = "*.svs", limit: int | None = None) -> DataFrame:
    """path and stem of the files in a folder, not below it, sorted. The files' contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "false").load(folder).select("path")
    out = found.select("path", metadata.stem(F.col("path")).alias("stem")).orderBy("path")
    return out.limit(limit) if limit is not None else out


def slides_from_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in sorted(paths)], "path string").select("path", metadata.stem(F.col("path")).alias("stem"))


def open_headers(slides: DataFrame, backend: str = "auto") -> DataFrame:
    """slides with properties, levels and load_error, from the files' headers, read on the executors."""

    @F.pandas_udf(f"struct<properties:map<string,string>,levels:{LEVELS},load_error:string>")
    def header(paths: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in paths:
            rows = []
            for p in s:
                try:
                    with open_slide(p.removeprefix("file://").removeprefix("file:"), backend) as r:
                        levels = [{"level": i, "width": w, "height": h, "downsample": float(d)} for i, ((w, h), d) in enumerate(zip(r.level_dimensions, r.level_downsamples, strict=True))]
                        rows.append((dict(r.properties), levels, None))
                except Exception as e:  # noqa: BLE001  becomes the status load_error
                    rows.append((None, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["properties", "levels", "load_error"])

    return slides.withColumn("h", header("path")).select(*slides.columns, "h.*")


def plan_levels(headers: DataFrame, target_mpp: float = metadata.TARGET_MPP, level: int | None = None, patch: int = metadata.PATCH) -> DataFrame:
    """headers with mpp, level, level_clamped, tile, effective_mpp and status (null if fine)."""
    mpp = metadata.mpp(F.col("properties"))
    ds = F.transform("levels", lambda x: x["downsample"])
    out = headers.withColumn("mpp", mpp).withColumn("proposed", F.when(F.col("mpp").isNotNull(), metadata.best_level_for_mpp(ds, F.col("mpp"), F.lit(float(target_mpp)))))
    asked = F.lit(level).cast("int")
    out = out.withColumns({"level": metadata.resolve_level(asked, F.col("proposed")), "level_clamped": metadata.level_clamped(asked, F.col("proposed"))})
    level_mpp = F.col("mpp") * F.try_element_at("levels", F.col("level") + 1)["downsample"]
    out = out.withColumn("tile", metadata.tile_size(level_mpp, target_mpp, patch)).withColumn("effective_mpp", metadata.effective_mpp(F.col("tile"), level_mpp, patch))
    return out.withColumn("status", F.when(F.col("load_error").isNotNull(), "load_error").when(F.col("mpp").isNull(), "mpp_extraction_error")).drop("proposed")


def template_pixels(spark: SparkSession, path: str) -> DataFrame:
    """r, g, b of every pixel of one image file that Spark's image source reads (its bytes are in BGR order)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for df in frames:
            for h, w, c, data in zip(df["height"], df["width"], df["nChannels"], df["data"], strict=True):
                a = np.frombuffer(data, np.uint8).reshape(h * w, c)
                rgb = a[:, [2, 1, 0]] if c >= 3 else np.repeat(a[:, :1], 3, axis=1)
                yield pd.DataFrame(rgb.astype(np.int32), columns=["r", "g", "b"])

    image = spark.read.format("image").option("dropInvalid", "true").load(path).select("image.*")
    return image.select("height", "width", "nChannels", "data").mapInPandas(run, "r int, g int, b int")


def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
