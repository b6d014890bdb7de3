"""Edge-density foreground: Canny edges per packed patch, threshold as a Column expression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
LOW, HIGH, LEAST_PERCENT = 40, 100, 2.0
TG22 = 13573  # tan(22.5 degrees) in 15-bit fixed point


def sobel(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3 x 3 derivatives (dx, dy) of (h, w, c) with edges repeated."""
    p = np.pad(image.astype(np.int32), ((1, 1), (1, 1), (0, 0)), mode="edge")
    sx = p[:-2] + 2 * p[1:-1] + p[2:]
    sy = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return sx[:, 2:] - sx[:, :-2], sy[2:] - sy[:-2]


def strongest_gradient(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """dx, dy and |dx| + |dy| of the channel where that is largest, the first of equals."""
    dx, dy = sobel(image)
    mag = np.abs(dx) + np.abs(dy)
    best = mag.argmax(axis=2)[:, :, None]
    return tuple(np.take_along_axis(v, best, axis=2)[:, :, 0] for v in (dx, dy, mag))  # type: ignore[return-value]


def canny(image: np.ndarray, low: int = LOW, high: int = HIGH) -> np.ndarray:
    """Boolean edges: thinning along the gradient direction, then weak pixels that touch strong ones, in 8 directions."""
    if image.ndim == 2:
        image = image[:, :, None]
    dx, dy, mag = strongest_gradient(image)
    m = np.pad(mag, 1)
    near = lambda y, x: m[1 + y : m.shape[0] - 1 + y, 1 + x : m.shape[1] - 1 + x]
    ax, ay = np.abs(dx).astype(np.int64), np.abs(dy).astype(np.int64) << 15
    flat, steep = ax * TG22, ax * TG22 + (ax << 16)
    level = (mag > near(0, -1)) & (mag >= near(0, 1))
    upright = (mag > near(-1, 0)) & (mag >= near(1, 0))
    falling = (mag > near(-1, -1)) & (mag > near(1, 1))
    rising = (mag > near(-1, 1)) & (mag > near(1, -1))
    thin = np.where(ay < flat, level, np.where(ay > steep, upright, np.where((dx ^ dy) < 0, rising, falling)))
    weak = thin & (mag > low)
    edges = weak & (mag > high)
    while True:
        p = np.pad(edges, 1)
        grown = np.zeros_like(edges)
        for y in range(3):
            for x in range(3):
                grown |= p[y : y + edges.shape[0], x : x + edges.shape[1]]
        grown &= weak
        if (grown == edges).all():
            return edges
        edges = grown


def edge_pixels(rgb: str, patch: int, mode: str = "rgb") -> Column:
    """Number of edge pixels of packed patches. mode 'rgb': the strongest channel of each pixel; 'gray': luminance."""

    @F.pandas_udf("int")
    def count(data: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> int | None:
            if b is None:
                return None
            a = np.frombuffer(b, np.uint8).reshape(patch, patch, 3)
            if mode == "gray":
                a = (a @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
            return int(canny(a).sum())

        return data.map(one).astype("Int32")

    return count(F.col(rgb))


def is_background(edges: Column, patch: int, least_percent: float = LEAST_PERCENT) -> Column:
    """Edges over all channel values of the patch, in percent, below the limit."""
    return edges * 100.0 / F.lit(float(3 * patch * patch)) < least_percent


def foreground_mask(patches: DataFrame, patch: int = 224, mode: str = "rgb", rgb: str = "rgb") -> DataFrame:
    """patches with edge_px and is_foreground."""
    out = patches.withColumn("edge_px", edge_pixels(rgb, patch, mode))
    return out.withColumn("is_foreground", ~is_background(F.col("edge_px"), patch))
