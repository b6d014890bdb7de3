"""Rasters and slide metadata derived from the test tables, and inline cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions.color import HE_REF

SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, patch_id, pos, r, g, b: each embedding as an 8 x 8 patch of stained colours."""
    e = table(spark, sf_dir, "embeddings")
    level = lambda x: 4 * F.abs(F.round(x.cast("double"), 3))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), lambda p: F.struct(p.alias("pos"), level(F.get("embedding", p)).alias("h"), level(F.get("embedding", (p + 21) % 64)).alias("k")))
    rows = e.select(F.col("label").alias("slide_id"), F.col("vec_id").alias("patch_id"), F.explode(pairs).alias("v")).select("slide_id", "patch_id", "v.*")
    shade = [F.floor(240 * F.exp(-(h * F.col("h") + k * F.col("k")))).cast("int").alias(c) for c, (h, k) in zip("rgb", HE_REF, strict=True)]
    return rows.select("slide_id", "patch_id", "pos", *shade)


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, row, col, is_foreground: a grid 16 patches wide for each slide; its vec_ids in order."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("slide_id"), "vec_id", F.get("embedding", F.lit(0)).alias("e0"))
    return e.select("slide_id", F.floor(F.col("vec_id") / 16).cast("int").alias("row"), (F.col("vec_id") % 16).cast("int").alias("col"), (F.col("e0") >= 0).alias("is_foreground"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, patch_id, rgb: the pixels of each patch as one binary."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.unhex(F.concat(*[F.lpad(F.hex(c), 2, "0") for c in "rgb"])).alias("v"))))
    p = pixels(spark, sf_dir).groupBy("slide_id", "patch_id").agg(ordered.alias("px"))
    return p.select("slide_id", "patch_id", F.expr("aggregate(px, cast('' as binary), (a, x) -> concat(a, x.v))").alias("rgb"))


#: Resolution cases: name, properties.
MPP_CASES = [
    ("property", {"openslide.mpp-x": "0.25"}),
    ("bad property, description", {"openslide.mpp-x": "n/a", "tiff.ImageDescription": '<OME><Image ID="1"><Pixels SizeX="3" PhysicalSizeX="0.5"/></Image></OME>'}),
    ("zero description, comment", {"tiff.ImageDescription": '<OME><Image><Pixels PhysicalSizeX="0"/></Image></OME>', "openslide.comment": "a<PixelSizeMicrons>0.2525</PixelSizeMicrons>b"}),
    ("centimeter", {"tiff.XResolution": "20000", "tiff.YResolution": "20000", "tiff.ResolutionUnit": "centimeter"}),
    ("inch", {"tiff.XResolution": "50800", "tiff.YResolution": "50900", "tiff.ResolutionUnit": "inch"}),
    ("unknown unit", {"tiff.XResolution": "50800", "tiff.YResolution": "50800", "tiff.ResolutionUnit": "none"}),
    ("broken xml", {"tiff.ImageDescription": "<OME><Image"}),
    ("no y resolution", {"tiff.XResolution": "20000", "tiff.ResolutionUnit": "centimeter"}),
    ("unclosed element, comment", {"tiff.ImageDescription": '<OME><Image><Pixels PhysicalSizeX="0.5"></Image></OME>', "openslide.comment": "<PixelSizeMicrons>0.25</PixelSizeMicrons>"}),
    ("second image only", {"tiff.ImageDescription": '<OME><Image ID="1"/><Image><Pixels PhysicalSizeX="0.5"/></Image></OME>'}),
    ("attribute elsewhere", {"tiff.ImageDescription": '<OME><Plate PhysicalSizeX="3"/><Image><Note/><Pixels A="b>c" PhysicalSizeX="0.75"/></Image></OME>'}),
    ("nothing", {"other": "1"}),
]
