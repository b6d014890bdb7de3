"""Patches as rows: cutting, coordinates, order, grids, mosaics, resampling.

Pixel rows (y, x) serve SQL-checkable operators; packed tiles and patches (one binary per row) serve scale. A tile of
16 x 16 patches becomes 256 patch rows without a shuffle, and a row carries everything, so nothing is aligned by place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def patch_of_pixel(pixels: DataFrame, patch: int) -> DataFrame:
    """Pixels (x, y) with the patch row and col they fall in and their place inside it."""
    return pixels.withColumns({"row": F.floor(F.col("y") / patch).cast("int"), "col": F.floor(F.col("x") / patch).cast("int"), "dy": (F.col("y") % patch).cast("int"), "dx": (F.col("x") % patch).cast("int")})


def patch_coordinates(patches: DataFrame, patch: int, x: str = "x", y: str = "y") -> DataFrame:
    return patches.withColumns({x: (F.col("col") * patch).cast("int"), y: (F.col("row") * patch).cast("int")})


def patch_grid(sizes: DataFrame, patch: int) -> DataFrame:
    """All patches of images (slide_id, width, height): row, col, x, y, flat_idx in row-major order."""
    n_w, n_h = F.floor(F.col("width") / patch).cast("int"), F.floor(F.col("height") / patch).cast("int")
    cells = sizes.where((n_w > 0) & (n_h > 0)).select("slide_id", n_w.alias("n_w"), F.explode(F.sequence(F.lit(0), n_w * n_h - 1)).alias("flat_idx"))
    cells = cells.select("slide_id", F.floor(F.col("flat_idx") / F.col("n_w")).cast("int").alias("row"), (F.col("flat_idx") % F.col("n_w")).cast("int").alias("col"), "flat_idx")
    return patch_coordinates(cells, patch)


def flat_index(row: Column, col: Column, n_w: Column) -> Column:
    return row * n_w + col


def patch_index_grid(patches: DataFrame, foreground: str = "is_foreground", key: str = "slide_id") -> DataFrame:
    """patch_index: ordinal among kept patches in row-major order, -1 for background."""
    w = Window.partitionBy(key).orderBy("row", "col").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = F.coalesce(F.col(foreground), F.lit(False))
    return patches.withColumn("patch_index", F.when(kept, F.sum(kept.cast("int")).over(w) - 1).otherwise(-1).cast("int"))


def mosaic_bounds(patches: DataFrame, patch: int, key: str = "slide_id") -> DataFrame:
    return patches.groupBy(key).agg((F.max("x") + patch).cast("int").alias("width"), (F.max("y") + patch).cast("int").alias("height"))


def mosaic_pixels(pixels: DataFrame, patch: int, key: str = "slide_id") -> DataFrame:
    """Every pixel of the canvas: patch pixels at (x + dx, y + dy), zero elsewhere. pixels: key, x, y, dx, dy, r, g, b."""
    size = mosaic_bounds(pixels, patch, key)
    canvas = size.select(key, "width", F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("i"))
    canvas = canvas.select(key, (F.col("i") % F.col("width")).cast("int").alias("px"), F.floor(F.col("i") / F.col("width")).cast("int").alias("py"))
    placed = pixels.select(key, (F.col("x") + F.col("dx")).cast("int").alias("px"), (F.col("y") + F.col("dy")).cast("int").alias("py"), "r", "g", "b")
    return canvas.join(placed, [key, "px", "py"], "left").select(key, "px", "py", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("r", "g", "b")])


# --- packed images -----------------------------------------------------------------------------------------------------


def resample(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, half-pixel centres, edges repeated, rounded to the nearest level."""
    h, w = image.shape[:2]

    def axis(n_out: int, n_in: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n_out) + 0.5) * n_in / n_out - 0.5
        lo = np.floor(at).astype(int)
        return np.clip(lo, 0, n_in - 1), np.clip(lo + 1, 0, n_in - 1), (at - lo).astype(np.float32)

    y0, y1, fy = axis(height, h)
    x0, x1, fx = axis(width, w)
    out = np.empty((height, width, image.shape[2]), np.uint8)
    fx = fx[None, :, None]
    for s in range(0, height, 256):  # by strips, to bound the float copies
        e = slice(s, s + 256)
        top, low, f = image[y0[e]], image[y1[e]], fy[e, None, None]
        rows = top * (1 - f) + low * f
        out[e] = np.clip(np.rint(rows[:, x0] * (1 - fx) + rows[:, x1] * fx), 0, 255).astype(np.uint8)
    return out


def split_patches(image: np.ndarray, patch: int) -> np.ndarray:
    """(rows, cols, patch, patch, channels) of an image whose sides the patch divides."""
    h, w, c = image.shape
    if h % patch or w % patch:
        raise ValueError("the patch side must divide the image")
    return image.reshape(h // patch, patch, w // patch, patch, c).swapaxes(1, 2)


PATCH_SCHEMA = "slide_id string, row int, col int, x int, y int, rgb binary, error string"


def tiles_to_patches(tiles: DataFrame, patch: int = 224, per_side: int = 16) -> DataFrame:
    """tiles (slide_id, tile_y, tile_x, height, width, data, error) to patch rows: resampled to 16 x 16 patches, then cut.

    One tile is decoded at a time and a batch holds one tile's patches, so memory does not grow with the slide. A tile
    that failed to read gives one row with its error.
    """
    side = patch * per_side
    schema = pa.schema([("slide_id", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("rgb", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                if t["data"] is None:
                    yield pa.RecordBatch.from_pylist([{"slide_id": t["slide_id"], "error": t["error"] or "no data"}], schema)
                    continue
                image = np.frombuffer(t["data"], np.uint8).reshape(t["height"], t["width"], 3)
                cut = split_patches(image if image.shape[:2] == (side, side) else resample(image, side, side), patch)
                rows = []
                for i in range(per_side):
                    for j in range(per_side):
                        row, col = t["tile_y"] * per_side + i, t["tile_x"] * per_side + j
                        rows.append({"slide_id": t["slide_id"], "row": row, "col": col, "x": col * patch, "y": row * patch, "rgb": cut[i, j].tobytes(), "error": None})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return tiles.select("slide_id", "tile_y", "tile_x", "height", "width", "data", "error").mapInArrow(run, PATCH_SCHEMA)


def packed_histogram(patches: DataFrame, key: str = "slide_id") -> DataFrame:
    """Colour histogram of packed patches: counted per batch in Arrow, then summed natively."""
    kind = patches.schema[key].dataType.simpleString()
    out = pa.schema([(key, pa.string() if kind == "string" else pa.int64()), ("r", pa.int32()), ("g", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_key: dict = {}
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if data is not None:
                    by_key.setdefault(k, []).append(np.frombuffer(data, np.uint8).reshape(-1, 3))
            for k, parts in by_key.items():
                a = np.concatenate(parts).astype(np.uint32)
                code, n = np.unique(a[:, 0] << 16 | a[:, 1] << 8 | a[:, 2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(code), out.field(0).type), pa.array((code >> 16).astype(np.int32)), pa.array((code >> 8 & 255).astype(np.int32)), pa.array((code & 255).astype(np.int32)), pa.array(n.astype(np.int64))], schema=out)

    part = patches.select(F.col(key).cast("string" if kind == "string" else "long").alias(key), "rgb").mapInArrow(run, f"{key} {'string' if kind == 'string' else 'long'}, r int, g int, b int, n long")
    return part.groupBy(key, "r", "g", "b").agg(F.sum("n").alias("n"))


def reconstruct(patches: DataFrame, patch: int, key: str = "slide_id") -> DataFrame:
    """(key, width, height, rgb): the mosaic of each slide. For thumbnails: a slide's canvas is built in one task."""
    kind = patches.schema[key].dataType.simpleString()

    def paste(df):  # noqa: ANN001, ANN202
        import pandas as pd

        w, h = int(df["x"].max()) + patch, int(df["y"].max()) + patch
        canvas = np.zeros((h, w, 3), np.uint8)
        for x, y, data in zip(df["x"], df["y"], df["rgb"], strict=True):
            canvas[y : y + patch, x : x + patch] = np.frombuffer(data, np.uint8).reshape(patch, patch, 3)
        return pd.DataFrame({key: [df[key].iloc[0]], "width": [w], "height": [h], "rgb": [canvas.tobytes()]})

    return patches.where("rgb is not null").select(key, "x", "y", "rgb").groupBy(key).applyInPandas(paste, f"{key} {kind}, width int, height int, rgb binary")
