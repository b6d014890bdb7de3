"""Stain normalisation over colour histograms.

Every quantity is a function of (r, g, b) and constants per slide, so pixels are counted per colour first (map-side
combine) and all statistics are weighted by the counts: at most 256**3 rows per slide, whatever its size. Moments,
percentiles and the colour table are grouped by slide; nothing is collected but a fitted reference.

Slides without enough tissue (fewer than two pixels, no spread, or no concentration) get null statistics and their
colours pass through unchanged. Eigenvector signs are fixed so that the mean optical density projects positively.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions.color import ALPHA, BETA, CHANNELS, HE_REF, IO, MAXC_REF, clip255, is_tissue, od_columns, optical_density_255
from tilelake.functions.linalg import eigenvector, lasso_two, solve_two, symmetric_eigenvalues
from tilelake.operators.raster import packed_histogram

OD = ["od_r", "od_g", "od_b"]
COVARIANCES = {"c_rr": (0, 0), "c_rg": (0, 1), "c_rb": (0, 2), "c_gg": (1, 1), "c_gb": (1, 2), "c_bb": (2, 2)}
HE = ["he_r1", "he_g1", "he_b1", "he_r2", "he_g2", "he_b2"]


_HELD: list[list[DataFrame]] = []


@contextlib.contextmanager
def holding() -> Iterator[None]:
    """Releases at its end the tables that the operators kept inside. For results that are written before it ends."""
    _HELD.append([])
    try:
        yield
    finally:
        for df in _HELD.pop():
            df.unpersist()


def _kept(table: DataFrame) -> DataFrame:
    """A table that later steps use more than once, computed once. Lost blocks are computed again."""
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    if _HELD:
        _HELD[-1].append(table)
    return table


def color_histogram(pixels: DataFrame, key: str = "slide_id") -> DataFrame:
    """(key, r, g, b, n)."""
    return pixels.groupBy(key, *CHANNELS).agg(F.count("*").alias("n"))


def tissue_moments(hist: DataFrame, key: str = "slide_id", io: float = IO, beta: float = BETA) -> DataFrame:
    """n_tissue, mean optical densities and the six sample covariances per slide. Sums are centred on a first guess to stay exact."""
    od = hist.withColumns(od_columns(io)).where(is_tissue(beta))
    n = F.sum("n").cast("double")
    sums = {f"s_{c}": F.sum(F.col("n") * (F.col(c) - 0.5)) for c in OD}
    cross = {f"x_{k}": F.sum(F.col("n") * (F.col(OD[i]) - 0.5) * (F.col(OD[j]) - 0.5)) for k, (i, j) in COVARIANCES.items()}
    g = od.groupBy(key).agg(F.sum("n").alias("n_tissue"), n.alias("w"), *[v.alias(k) for k, v in (sums | cross).items()])
    means = [(F.col(f"s_{c}") / F.col("w") + 0.5).alias(f"mean_{c}") for c in OD]
    cov = [F.when(F.col("w") > 1, (F.col(f"x_{k}") - F.col(f"s_{OD[i]}") * F.col(f"s_{OD[j]}") / F.col("w")) / (F.col("w") - 1)).alias(k) for k, (i, j) in COVARIANCES.items()]
    return g.select(key, "n_tissue", *means, *cov)


def principal_axes(moments: DataFrame) -> DataFrame:
    """moments with the eigenvalues and the unit eigenvectors of the middle (m_) and largest (t_) one."""
    c = [F.col(k) for k in ("c_rr", "c_rg", "c_rb", "c_gg", "c_gb", "c_bb")]
    low, mid, top = symmetric_eigenvalues(*c)
    out = moments.withColumns({"l_low": low, "l_mid": mid, "l_top": top})
    for name in ("mid", "top"):
        v = eigenvector(*c, F.col(f"l_{name}"))
        out = out.withColumns({f"{name}_{x}": v[k] for k, x in enumerate(CHANNELS)})
        flip = F.when(sum((F.col(f"{name}_{x}") * F.col(f"mean_od_{x}") for x in CHANNELS), F.lit(0.0)) < 0, -1.0).otherwise(1.0)
        out = out.withColumn("flip", flip).withColumns({f"{name}_{x}": F.col(f"{name}_{x}") * F.col("flip") for x in CHANNELS}).drop("flip")
    return out


#: Steps of one that approximate percentiles tell apart.
GRID = 4096


def percentile(value: Column, q: float | list[float], exact: bool = True) -> Column:
    """Weighted by the column n, with linear interpolation. Approximate: of values rounded to 1 / GRID, so the error is at most
    half a step and a group holds no more values than its range has steps."""
    return F.percentile(value if exact else F.round(value * GRID) / GRID, q, F.col("n"))


def _angles(hist: DataFrame, axes: DataFrame, key: str, alpha: float, io: float, beta: float, exact: bool) -> DataFrame:
    od = hist.withColumns(od_columns(io)).where(is_tissue(beta)).join(axes, key)
    x, y = (sum((F.col(o) * F.col(f"{name}_{c}") for o, c in zip(OD, CHANNELS, strict=True)), F.lit(0.0)) for name in ("mid", "top"))
    rows = od.select(key, F.atan2(y, x).alias("phi"), "n")
    return rows.groupBy(key).agg(percentile(F.col("phi"), [alpha / 100, 1 - alpha / 100], exact).alias("phi"))


def stain_vectors(hist: DataFrame, key: str = "slide_id", io: float = IO, beta: float = BETA, alpha: float = ALPHA, exact: bool = True) -> DataFrame:
    """key, n_tissue, he_r1 ... he_b2: the stain with more red first."""
    axes = _kept(principal_axes(tissue_moments(hist, key, io, beta)))
    ends = axes.join(_angles(hist, axes, key, alpha, io, beta, exact), key, "left")
    out = ends.select(key, "n_tissue", *[(F.col(f"mid_{c}") * F.cos(F.col("phi")[k]) + F.col(f"top_{c}") * F.sin(F.col("phi")[k])).alias(f"v{k}_{c}") for k in (0, 1) for c in CHANNELS])
    first = F.col("v0_r") > F.col("v1_r")
    ordered = [F.when(first, F.col(f"v0_{c}")).otherwise(F.col(f"v1_{c}")).alias(f"he_{c}1") for c in CHANNELS]
    ordered += [F.when(first, F.col(f"v1_{c}")).otherwise(F.col(f"v0_{c}")).alias(f"he_{c}2") for c in CHANNELS]
    return out.select(key, "n_tissue", *ordered)


def concentrations(hist: DataFrame, vectors: DataFrame, key: str = "slide_id", io: float = IO, lasso: float | None = None) -> DataFrame:
    """hist with c_h and c_e of every colour, tissue or not. Slides without vectors get nulls."""
    rows = hist.withColumns(od_columns(io)).join(vectors.select(key, *HE), key, "left")
    h1, h2, x = ([F.col(c) for c in cols] for cols in (HE[:3], HE[3:], OD))
    c = solve_two(h1, h2, x) if lasso is None else lasso_two(h1, h2, x, lasso)
    return rows.select(key, *CHANNELS, "n", c[0].alias("c_h"), c[1].alias("c_e"))


def max_concentrations(conc: DataFrame, key: str = "slide_id", exact: bool = True) -> DataFrame:
    return conc.groupBy(key).agg(percentile(F.col("c_h"), 0.99, exact).alias("maxc_h"), percentile(F.col("c_e"), 0.99, exact).alias("maxc_e"))


@dataclass(frozen=True)
class StainModel:
    """A fitted reference: eight numbers, small enough to travel as literals."""

    he: tuple[tuple[float, float], ...] = HE_REF
    maxc: tuple[float, float] = MAXC_REF
    exact: bool = True

    def lut(self, hist: DataFrame, key: str = "slide_id", io: float = IO, beta: float = BETA, alpha: float = ALPHA) -> DataFrame:
        """(key, r, g, b, n) -> nr, ng, nb and normalised: the colour table of each slide."""
        hist = _kept(hist)
        return self._recolour(hist, stain_statistics(hist, key, io, beta, alpha, self.exact), key, io)

    def _recolour(self, rows: DataFrame, statistics: DataFrame, key: str, io: float) -> DataFrame:
        """rows(key, r, g, b, ...) with nr, ng, nb and normalised, from the eight numbers of their slide."""
        wide = rows.withColumns(od_columns(io)).join(statistics.select(key, *HE, "maxc_h", "maxc_e"), key, "left")
        c_h, c_e = solve_two(*([F.col(c) for c in cols] for cols in (HE[:3], HE[3:], OD)))
        wide = wide.withColumns({"c_h": c_h, "c_e": c_e})
        ok = (F.col("maxc_h") > 0) & (F.col("maxc_e") > 0) & F.col("c_h").isNotNull()
        c1, c2 = F.try_divide("c_h", F.col("maxc_h") / F.lit(self.maxc[0])), F.try_divide("c_e", F.col("maxc_e") / F.lit(self.maxc[1]))
        new = [F.coalesce(F.when(ok, F.least(F.lit(255.0), io * F.exp(-(self.he[k][0] * c1 + self.he[k][1] * c2))).cast("int")), F.col(c)).alias(f"n{c}") for k, c in enumerate(CHANNELS)]
        return wide.select(*rows.columns, *new, F.coalesce(ok, F.lit(False)).alias("normalised"))

    def transform(self, pixels: DataFrame, key: str = "slide_id", io: float = IO, beta: float = BETA, alpha: float = ALPHA) -> DataFrame:
        """pixels with nr, ng, nb and normalised. Colours are counted for the statistics; the pixels themselves meet only one row per slide."""
        return self._recolour(pixels, stain_statistics(_kept(color_histogram(pixels, key)), key, io, beta, alpha, self.exact), key, io)


def stain_statistics(hist: DataFrame, key: str = "slide_id", io: float = IO, beta: float = BETA, alpha: float = ALPHA, exact: bool = True) -> DataFrame:
    """One row per slide: n_tissue, the stain vectors and the maximal concentrations."""
    vectors = _kept(stain_vectors(hist, key, io, beta, alpha, exact))
    return vectors.join(max_concentrations(concentrations(hist, vectors, key, io), key, exact), key, "left")


def normalise_patches(patches: DataFrame, statistics: DataFrame, model: StainModel, key: str = "slide_id", io: float = IO) -> DataFrame:
    """patches with normalized: packed patches recoloured by the eight numbers of their slide, once per distinct colour.

    The join carries eight doubles per patch. Patches of slides without statistics pass through.
    """
    ref, maxc = np.array(model.he), np.array(model.maxc)

    @F.pandas_udf("binary")
    def recolour(rgb: pd.Series, stats: pd.DataFrame) -> pd.Series:
        def one(data: bytes | None, he: np.ndarray, c: np.ndarray) -> bytes | None:
            if data is None or not np.isfinite(he).all() or not (c > 0).all():
                return data
            px = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int64)
            code, back = np.unique(px[:, 0] << 16 | px[:, 1] << 8 | px[:, 2], return_inverse=True)
            od = -np.log((np.stack([code >> 16, code >> 8 & 255, code & 255]) + 1) / io)
            h = he.reshape(2, 3).T
            conc = np.linalg.solve(h.T @ h, h.T @ od) / (c / maxc)[:, None]
            new = np.minimum(255, io * np.exp(-(ref @ conc))).astype(np.uint8)
            return new.T[back].tobytes()

        he, c = stats[HE].to_numpy(float), stats[["maxc_h", "maxc_e"]].to_numpy(float)
        return pd.Series([one(d, he[i], c[i]) for i, d in enumerate(rgb)], dtype=object)

    wide = patches.join(statistics.select(F.col(key), F.struct(*HE, "maxc_h", "maxc_e").alias("stain_stats")), key, "left")
    return wide.withColumn("normalized", recolour("rgb", "stain_stats")).drop("stain_stats")


def patch_statistics(patches: DataFrame, exact: bool = True) -> DataFrame:
    """stain_statistics of packed patches, kept: the patches are counted once, whatever number of outputs needs the result."""
    return _kept(stain_statistics(_kept(packed_histogram(patches)), exact=exact))


class StainNormalizer:
    """Estimator: fit() on the pixels of one reference image gives a StainModel."""

    def __init__(self, exact: bool = True):
        self.exact = exact

    def fit(self, pixels: DataFrame, io: float = IO, beta: float = BETA, alpha: float = ALPHA) -> StainModel:
        one = pixels.select(F.lit(0).alias("slide_id"), *CHANNELS)
        hist = color_histogram(one)
        vectors = _kept(stain_vectors(hist, "slide_id", io, beta, alpha, self.exact))
        row = vectors.join(max_concentrations(concentrations(hist, vectors, "slide_id", io), "slide_id", self.exact), "slide_id").head()
        if row is None or row.he_r1 is None:
            raise ValueError("the reference has too little tissue")
        return StainModel(tuple((row[a], row[b]) for a, b in zip(HE[:3], HE[3:], strict=True)), (row.maxc_h, row.maxc_e), self.exact)


# --- the variant with brightness and non-negative concentrations --------------------------------------------------------


def standardise_brightness(hist: DataFrame, key: str = "slide_id") -> DataFrame:
    """hist with sr, sg, sb: channels over the slide's 90th percentile of all channel values, times 255, clipped."""
    values = hist.select(key, "n", F.explode(F.array(*CHANNELS)).alias("v"))
    p90 = values.groupBy(key).agg(F.percentile("v", 0.9, F.col("n")).alias("p90"))
    return hist.join(p90, key).withColumns({f"s{c}": clip255(F.coalesce(F.try_divide(F.col(c) * 255.0, F.col("p90")), F.lit(0.0))).cast("int") for c in CHANNELS}).drop("p90")


def any_channel_tissue(beta: float = BETA) -> Column:
    """The variant's tissue rule: any channel above beta."""
    return (F.col("od_r") > beta) | (F.col("od_g") > beta) | (F.col("od_b") > beta)


def sparse_stain_vectors(hist: DataFrame, key: str = "slide_id", beta: float = BETA, alpha: float = ALPHA) -> DataFrame:
    """Unit stain vectors of the variant: density over 255, any-channel tissue, axes with positive first component."""
    od = hist.withColumns({f"od_{c}": optical_density_255(F.col(c)) for c in CHANNELS}).where(any_channel_tissue(beta))
    n = F.sum("n").cast("double")
    g = od.groupBy(key).agg(n.alias("w"), *[F.sum(F.col("n") * F.col(o)).alias(f"s_{o}") for o in OD], *[F.sum(F.col("n") * F.col(OD[i]) * F.col(OD[j])).alias(f"x_{k}") for k, (i, j) in COVARIANCES.items()])
    cov = g.select(key, *[(F.col(f"s_{o}") / F.col("w")).alias(f"mean_{o}") for o in OD], *[F.when(F.col("w") > 1, (F.col(f"x_{k}") - F.col(f"s_{OD[i]}") * F.col(f"s_{OD[j]}") / F.col("w")) / (F.col("w") - 1)).alias(k) for k, (i, j) in COVARIANCES.items()])
    axes = principal_axes(cov)
    for name in ("mid", "top"):
        s = F.when(F.col(f"{name}_r") < 0, -1.0).otherwise(1.0)
        axes = axes.withColumn("s", s).withColumns({f"{name}_{c}": F.col(f"{name}_{c}") * F.col("s") for c in CHANNELS}).drop("s")
    dot = lambda name: sum((F.col(o) * F.col(f"{name}_{c}") for o, c in zip(OD, CHANNELS, strict=True)), F.lit(0.0))
    phi = od.join(axes.select(key, *[f"{a}_{c}" for a in ("mid", "top") for c in CHANNELS]), key).select(key, F.atan2(dot("mid"), dot("top")).alias("phi"), "n")
    ends = phi.groupBy(key).agg(F.percentile("phi", [alpha / 100, 1 - alpha / 100], F.col("n")).alias("phi"))
    out = axes.join(ends, key).select(key, *[(F.col(f"top_{c}") * F.cos(F.col("phi")[k]) + F.col(f"mid_{c}") * F.sin(F.col("phi")[k])).alias(f"v{k}_{c}") for k in (0, 1) for c in CHANNELS])
    first = F.col("v0_r") > F.col("v1_r")
    for k, names in ((0, HE[:3]), (1, HE[3:])):
        pick = {n: F.when(first, F.col(f"v{k}_{c}")).otherwise(F.col(f"v{1 - k}_{c}")) for n, c in zip(names, CHANNELS, strict=True)}
        out = out.withColumns(pick)
        norm = F.sqrt(sum((F.col(n) * F.col(n) for n in names), F.lit(0.0)))
        out = out.withColumn("norm", norm).withColumns({n: F.col(n) / F.col("norm") for n in names}).drop("norm")
    return out.select(key, *HE)


def sparse_transform(hist: DataFrame, vectors: DataFrame, target: tuple[tuple[float, float], ...], key: str = "slide_id", lam: float = 0.01) -> DataFrame:
    """nr, ng, nb = 255 exp(-C S) with non-negative lasso concentrations C and the target's stain matrix S."""
    rows = hist.withColumns({f"od_{c}": optical_density_255(F.col(c)) for c in CHANNELS}).join(vectors, key)
    c1, c2 = lasso_two([F.col(c) for c in HE[:3]], [F.col(c) for c in HE[3:]], [F.col(c) for c in OD], lam)
    new = {f"n{c}": clip255(255.0 * F.exp(-(target[k][0] * c1 + target[k][1] * c2))).cast("int") for k, c in enumerate(CHANNELS)}
    return rows.withColumns({"c_h": c1, "c_e": c2}).withColumns(new).select(key, *CHANNELS, "n", "c_h", "c_e", *new)


@dataclass(frozen=True)
class SparseStainModel:
    """The variant's normaliser: fitted to one target, then applied to any slides."""

    target: tuple[tuple[float, float], ...] = HE_REF

    @staticmethod
    def fit(hist: DataFrame, key: str = "slide_id") -> SparseStainModel:
        """The stain matrix of a target of one slide, after its brightness is standardised."""
        row = sparse_stain_vectors(_bright(hist, key), key).head()
        if row is None or row[HE[0]] is None:
            raise ValueError("the target has too little tissue")
        return SparseStainModel(tuple((row[a], row[b]) for a, b in zip(HE[:3], HE[3:], strict=True)))

    def transform(self, hist: DataFrame, key: str = "slide_id") -> DataFrame:
        """Standardised colours with nr, ng, nb."""
        bright = _bright(hist, key)
        return sparse_transform(bright, sparse_stain_vectors(bright, key), self.target, key)


def _bright(hist: DataFrame, key: str) -> DataFrame:
    h = standardise_brightness(hist, key)
    return h.groupBy(key, *[F.col(f"s{c}").alias(c) for c in CHANNELS]).agg(F.sum("n").alias("n"))
