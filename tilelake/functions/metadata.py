"""Slide metadata as Column expressions: resolution, pyramid level, tile geometry, chunk keys, names."""

from __future__ import annotations

from xml.dom import minidom
from xml.parsers.expat import ExpatError

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TARGET_MPP = 256.0 / 224.0
PATCH, PATCHES_PER_TILE = 224, 16

# Property names of slide files.
P_MPP, P_DESCRIPTION, P_COMMENT = "openslide.mpp-x", "tiff.ImageDescription", "openslide.comment"
P_XRES, P_YRES, P_UNIT = "tiff.XResolution", "tiff.YResolution", "tiff.ResolutionUnit"


def _prop(props: Column, key: str) -> Column:
    return F.try_element_at(props, F.lit(key))


def _number(text: Column) -> Column:
    """A positive double, else null. Written so that malformed text never fails the job."""
    v = text.try_cast("double")
    return F.when((v > 0) & (v < float("inf")), v)


def mpp_from_property(props: Column) -> Column:
    return _number(_prop(props, P_MPP))


def _physical_size(xml: str | None) -> str | None:
    """PhysicalSizeX of the first Pixels within the first Image; null for text that is no XML or lacks them."""
    if not xml:
        return None
    try:
        images = minidom.parseString(xml).documentElement.getElementsByTagName("Image")
        pixels = images[0].getElementsByTagName("Pixels") if images else []
        return pixels[0].getAttribute("PhysicalSizeX") if pixels else None
    except (ExpatError, ValueError):
        return None


def mpp_from_description(props: Column) -> Column:
    """From the XML description, which is parsed; anything unreadable is null. There is one header per slide."""
    parse = F.pandas_udf(lambda x: x.map(_physical_size).astype(object), "string")
    parse.func.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return _number(parse(_prop(props, P_DESCRIPTION)))


def mpp_from_comment(props: Column) -> Column:
    return _number(F.regexp_extract(_prop(props, P_COMMENT), r"<PixelSizeMicrons>(.*?)</PixelSizeMicrons>", 1))


def mpp_from_resolution(props: Column) -> Column:
    """Needs both resolutions; x is used."""
    x = F.when(_number(_prop(props, P_YRES)).isNotNull(), _number(_prop(props, P_XRES)))
    return F.when(_prop(props, P_UNIT) == "centimeter", 10000.0 / x).when(_prop(props, P_UNIT) == "inch", 25400.0 / x)


#: Tried in order; append to register another.
MPP_EXTRACTORS = [mpp_from_property, mpp_from_description, mpp_from_comment, mpp_from_resolution]


def register_mpp_extractor(f):
    MPP_EXTRACTORS.append(f)
    return f


def mpp(props: Column) -> Column:
    """Microns per pixel; null is the outcome mpp_extraction_error."""
    return F.coalesce(*[f(props) for f in MPP_EXTRACTORS])


def resolution_differs(props: Column) -> Column:
    """Whether the x and y resolutions differ; x is used."""
    return F.coalesce(_number(_prop(props, P_XRES)) != _number(_prop(props, P_YRES)), F.lit(False))


def best_level(downsamples: Column, target: Column) -> Column:
    """Index of the downsample closest to the target, the first of equals."""
    scored = F.transform(downsamples, lambda d, i: F.struct(F.abs(d - target).alias("gap"), i.cast("int").alias("level")))
    return F.array_min(scored)["level"]


def best_level_for_mpp(downsamples: Column, slide_mpp: Column, target_mpp: Column) -> Column:
    return best_level(downsamples, target_mpp / slide_mpp)


def resolve_level(requested: Column, proposed: Column) -> Column:
    """The requested level, no coarser than the proposed one; the proposed one if none is requested."""
    return F.least(F.coalesce(requested, proposed), proposed)


def level_clamped(requested: Column, proposed: Column) -> Column:
    return F.coalesce(requested > proposed, F.lit(False))


def tile_size(level_mpp: Column, target_mpp: float | Column = TARGET_MPP, patch: int = PATCH) -> Column:
    """Side of the region at the level that becomes one tile of 16 x 16 patches."""
    target = target_mpp if isinstance(target_mpp, Column) else F.lit(float(target_mpp))
    return F.ceil(F.lit(PATCHES_PER_TILE * patch) * target / level_mpp).cast("int")


def effective_mpp(size: Column, level_mpp: Column, patch: int = PATCH) -> Column:
    """What the resampled tile really has, as the region side is rounded up."""
    return size / F.lit(float(PATCHES_PER_TILE * patch)) * level_mpp


def pad_dimension(n: Column, tile: Column) -> Column:
    return (F.ceil(n / tile) * tile).cast("int")


def reference_position(i: Column, downsample: Column, tile: Column) -> Column:
    return (i * downsample * tile).cast("long")


def parse_chunk_key(key: Column) -> dict[str, Column]:
    """'<level>/<y>.<x>.<c>' to x, y, level; nulls for other keys."""
    m = key.rlike(r"^[0-9]+/[0-9]+\.[0-9]+\.[0-9]+$")
    part = lambda i: F.when(m, F.regexp_extract(key, r"^([0-9]+)/([0-9]+)\.([0-9]+)", i).try_cast("int"))
    return {"level": part(1), "y": part(2), "x": part(3)}


def has_chunk(level: Column, y: Column, x: Column, levels: Column, tile: Column) -> Column:
    """Whether the padded pyramid has the chunk; levels: array of structs with width and height."""
    at = F.try_element_at(levels, level + 1)
    return F.coalesce((level >= 0) & (x >= 0) & (y >= 0) & (x < F.ceil(at["width"] / tile)) & (y < F.ceil(at["height"] / tile)), F.lit(False))


def stem(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def multiscale_metadata(levels: Column) -> Column:
    """The root attributes of a multiscale group, as JSON."""
    datasets = F.transform(levels, lambda v, i: F.struct(i.cast("string").alias("path")))
    return F.to_json(F.struct(F.array(F.struct(F.lit("").alias("name"), datasets.alias("datasets"), F.lit("0.1").alias("version"))).alias("multiscales")))
