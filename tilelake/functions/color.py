"""Pixel and colour formulas as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
IO, BETA, ALPHA = 240.0, 0.15, 1.0
HE_REF = ((0.5626, 0.2159), (0.7201, 0.8012), (0.4062, 0.5581))
MAXC_REF = (1.9705, 1.0308)
IMAGENET_MEAN, IMAGENET_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
CHANNELS = ("r", "g", "b")


def optical_density(c: Column, io: float = IO) -> Column:
    return -F.ln((c + 1) / F.lit(float(io)))


def optical_density_255(c: Column) -> Column:
    """The variant over 255, with zero read as one."""
    return -F.ln(F.greatest(c, F.lit(1)) / F.lit(255.0))


def od_columns(io: float = IO) -> dict[str, Column]:
    return {f"od_{c}": optical_density(F.col(c), io) for c in CHANNELS}


def is_tissue(beta: float = BETA) -> Column:
    """All channels at or above beta: a pixel goes if any is below."""
    return (F.col("od_r") >= beta) & (F.col("od_g") >= beta) & (F.col("od_b") >= beta)


def gray(r: Column, g: Column, b: Column) -> Column:
    return (F.lit(0.299) * r + F.lit(0.587) * g + F.lit(0.114) * b).cast("int")


def clip255(v: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0))


def channel_normalised(c: str) -> Column:
    i = CHANNELS.index(c)
    return (F.col(c) / 255.0 - IMAGENET_MEAN[i]) / IMAGENET_STD[i]
