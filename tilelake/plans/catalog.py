"""Registered queries, one or more for each operator, and their oracle SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions import color, metadata
from tilelake.operators import arrays, embed, foreground, raster, sinks, stain, swin
from tilelake.plans import config, fixtures, preprocess
from tilelake.plans import oracles as o
from tilelake.plans.shipping import ship
from tilelake.sources import slides, tiles

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


def _r(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; a temporary one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tilelake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hist(spark: SparkSession, d: str) -> DataFrame:
    return stain.color_histogram(fixtures.pixels(spark, d))


# --- colours and stains ------------------------------------------------------------------------------------------------


@_query(o.OD_TISSUE_STATS)
def od_tissue_stats(spark: SparkSession, d: str) -> DataFrame:
    m = stain.tissue_moments(_hist(spark, d))
    return m.select("slide_id", F.col("n_tissue").cast("long").alias("n_tissue"), *[_r(f"mean_{c}").alias(f"mean_{c}") for c in stain.OD], *[_r(k, 8).alias(k) for k in stain.COVARIANCES])


@_query(o.COLOR_HISTOGRAM)
def color_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _hist(spark, d)


@_query(o.COLOR_HISTOGRAM)
def packed_color_histogram(spark: SparkSession, d: str) -> DataFrame:
    return raster.packed_histogram(fixtures.packed(spark, d)).select(F.col("slide_id").cast("int").alias("slide_id"), "r", "g", "b", "n")


@_query(o.LINEITEM_PERCENTILES)
def lineitem_color_percentiles(spark: SparkSession, d: str) -> DataFrame:
    li = fixtures.table(spark, d, "lineitem")
    px = li.select((F.col("l_quantity") * 5).cast("int").alias("r"), (F.round(F.col("l_discount") * 100) * 25).cast("int").alias("g"), (F.round(F.col("l_tax") * 100) * 31).cast("int").alias("b"), F.lit(0).alias("slide_id"))
    h = stain.color_histogram(px)
    return h.agg(*[_r(F.percentile(color.optical_density(F.col(c)), q / 100, F.col("n"))).alias(f"{c}_p{q}") for c in "rgb" for q in (1, 50, 99)], F.sum("n").alias("n"))


@_query(o.OD_PERCENTILES)
def od_percentiles_exact(spark: SparkSession, d: str) -> DataFrame:
    h = _hist(spark, d)
    return h.groupBy("slide_id").agg(*[_r(F.percentile(color.optical_density(F.col(c)), q / 100, F.col("n"))).alias(f"{c}_p{q}") for c in "rgb" for q in (1, 99)])


@_query(o.OD_PERCENTILES_APPROX)
def od_percentiles_approx(spark: SparkSession, d: str) -> DataFrame:
    h = _hist(spark, d).withColumns(color.od_columns())
    return h.groupBy("slide_id").agg(*[_r(stain.percentile(F.col(c), 0.99, exact=False)).alias(f"{c}_p99") for c in stain.OD])


@_query(o.stain("axes"))
def tissue_eigenvalues(spark: SparkSession, d: str) -> DataFrame:
    axes = stain.principal_axes(stain.tissue_moments(_hist(spark, d)))
    return axes.select("slide_id", *[_r(c, 8).alias(c) for c in ("l_low", "l_mid", "l_top")])


@_query(o.stain("vectors"))
def stain_matrix(spark: SparkSession, d: str) -> DataFrame:
    v = stain.stain_vectors(_hist(spark, d))
    return v.select("slide_id", F.col("n_tissue").cast("long").alias("n_tissue"), *[_r(c).alias(c) for c in stain.HE])


@_query(o.stain("vectors", exact=False))
def stain_matrix_approx(spark: SparkSession, d: str) -> DataFrame:
    v = stain.stain_vectors(_hist(spark, d), exact=False)
    return v.select("slide_id", F.col("n_tissue").cast("long").alias("n_tissue"), *[_r(c).alias(c) for c in stain.HE])


@_query(o.stain("conc"))
def stain_concentrations(spark: SparkSession, d: str) -> DataFrame:
    h = _hist(spark, d)
    c = stain.concentrations(h, stain.stain_vectors(h))
    return c.select("slide_id", "r", "g", "b", "n", _r("c_h").alias("c_h"), _r("c_e").alias("c_e"))


@_query(o.stain("maxc"))
def stain_maxc(spark: SparkSession, d: str) -> DataFrame:
    h = _hist(spark, d)
    m = stain.max_concentrations(stain.concentrations(h, stain.stain_vectors(h)))
    return m.select("slide_id", _r("maxc_h").alias("maxc_h"), _r("maxc_e").alias("maxc_e"))


@_query(o.stain("lut"))
def stain_normalize(spark: SparkSession, d: str) -> DataFrame:
    return stain.StainModel().lut(_hist(spark, d)).select("slide_id", "r", "g", "b", "n", "nr", "ng", "nb")


@_query(o.stain("pixels"))
def stain_normalize_pixels(spark: SparkSession, d: str) -> DataFrame:
    return stain.StainModel().transform(fixtures.pixels(spark, d)).select("slide_id", "patch_id", "pos", "nr", "ng", "nb")


@_query(o.stain("pixels_packed"))
def stain_normalize_packed(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.packed(spark, d)
    out = stain.normalise_patches(p, stain.patch_statistics(p), stain.StainModel())
    return out.select(F.col("slide_id").cast("int").alias("slide_id"), "patch_id", F.hex("normalized").alias("normalized"))


@_query(o.stain("reference"))
def stain_fit_reference(spark: SparkSession, d: str) -> DataFrame:
    """The fitted reference of slide 0."""
    h = stain.color_histogram(fixtures.pixels(spark, d).where("slide_id = 0"))
    s = stain.stain_statistics(h)
    return s.select(*[_r(c).alias(c) for c in stain.HE], _r("maxc_h").alias("maxc_h"), _r("maxc_e").alias("maxc_e"))


@_query(o.stain("fitted"))
def stain_normalize_fitted(spark: SparkSession, d: str) -> DataFrame:
    """All slides to the fitted reference of slide 0."""
    model = stain.StainNormalizer().fit(fixtures.pixels(spark, d).where("slide_id = 0"))
    return model.lut(_hist(spark, d)).select("slide_id", "r", "g", "b", "n", "nr", "ng", "nb")


@_query(o.BRIGHTNESS)
def brightness_standardize(spark: SparkSession, d: str) -> DataFrame:
    return stain.standardise_brightness(_hist(spark, d)).select("slide_id", "r", "g", "b", "n", "sr", "sg", "sb")


@_query(o.sparse("vectors"))
def sparse_stain_matrix(spark: SparkSession, d: str) -> DataFrame:
    return stain.sparse_stain_vectors(_hist(spark, d)).select("slide_id", *[_r(c).alias(c) for c in stain.HE])


@_query(o.sparse("lasso"))
def sparse_stain_normalize(spark: SparkSession, d: str) -> DataFrame:
    h = _hist(spark, d)
    out = stain.sparse_transform(h, stain.sparse_stain_vectors(h), color.HE_REF)
    return out.select("slide_id", "r", "g", "b", "n", _r("c_h").alias("c_h"), _r("c_e").alias("c_e"), "nr", "ng", "nb")


# --- patches -----------------------------------------------------------------------------------------------------------


@_query(o.PATCH_COORDS)
def patch_coords(spark: SparkSession, d: str) -> DataFrame:
    return raster.patch_coordinates(fixtures.patches(spark, d), 224).select("slide_id", "row", "col", "x", "y")


@_query(o.PATCH_FLATTEN)
def patch_flatten(spark: SparkSession, d: str) -> DataFrame:
    sizes = fixtures.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("slide_id"), (F.col("s_suppkey") % 7 * 100 + 230).cast("int").alias("width"), (F.col("s_suppkey") % 5 * 150 + 100).cast("int").alias("height"))
    return raster.patch_grid(sizes, 224)


@_query(o.PATCHIFY)
def patchify_pixels(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.pixels(spark, d).select("slide_id", "patch_id", (F.col("pos") % 8).alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"), "r")
    return raster.patch_of_pixel(p, 4).select("slide_id", "patch_id", "row", "col", "dx", "dy", "r")


@_query(o.RGB_TO_GRAY)
def rgb_to_gray(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.pixels(spark, d)
    return p.select("slide_id", "patch_id", "pos", color.gray(F.col("r"), F.col("g"), F.col("b")).alias("gray"))


@_query(o.CHANNEL_SWAP)
def channel_swap(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.pixels(spark, d).select("slide_id", "patch_id", "pos", F.array("b", "g", "r")[0].alias("c0"), F.reverse(F.array("r", "g", "b"))[2].alias("c2"))


@_query(o.CHANNEL_NORMALIZE)
def channel_normalize(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.pixels(spark, d).select("slide_id", "patch_id", "pos", *[_r(color.channel_normalised(c)).alias(f"{c}_norm") for c in "rgb"])


@_query(o.FOREGROUND_FILTER)
def foreground_filter(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.patches(spark, d).where("is_foreground").select("slide_id", "row", "col")


@_query(o.PATCH_INDEX_GRID)
def patch_index_grid(spark: SparkSession, d: str) -> DataFrame:
    return raster.patch_index_grid(fixtures.patches(spark, d)).select("slide_id", "row", "col", "patch_index")


@_query(o.MOSAIC_BOUNDS)
def mosaic_bounds(spark: SparkSession, d: str) -> DataFrame:
    return raster.mosaic_bounds(raster.patch_coordinates(fixtures.patches(spark, d), 224), 224)


@_query(o.MOSAIC_PIXELS)
def mosaic_pixels(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.pixels(spark, d).withColumns({"row": F.floor(F.col("patch_id") / 16).cast("int"), "col": (F.col("patch_id") % 16).cast("int"), "dx": F.col("pos") % 8, "dy": F.floor(F.col("pos") / 8).cast("int")})
    return raster.mosaic_pixels(raster.patch_coordinates(p, 8), 8)


@_query(o.GRADIENT)
def gradient_magnitude(spark: SparkSession, d: str) -> DataFrame:
    """|dx| + |dy| of the strongest channel at every pixel of the packed patches."""
    p = fixtures.packed(spark, d)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for s, i, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                m = foreground.strongest_gradient(np.frombuffer(data, np.uint8).reshape(8, 8, 3))[2].reshape(-1)
                yield pa.RecordBatch.from_pydict({"slide_id": pa.array([s] * 64, pa.int32()), "patch_id": pa.array([i] * 64, pa.int64()), "pos": pa.array(range(64), pa.int32()), "magnitude": pa.array(m.astype(np.int32))})

    return p.mapInArrow(run, "slide_id int, patch_id long, pos int, magnitude int")


@_query(o.CANNY)
def foreground_mask(spark: SparkSession, d: str) -> DataFrame:
    return foreground.foreground_mask(fixtures.packed(spark, d), patch=8).select("slide_id", "patch_id", "edge_px", "is_foreground")


@_query(o.RESAMPLE)
def resample(spark: SparkSession, d: str) -> DataFrame:
    """Packed 8 x 8 patches as tiles, resampled to 2 x 2 patches of 6 pixels."""
    t = fixtures.packed(spark, d).select(F.col("slide_id").cast("string").alias("slide_id"), F.floor(F.col("patch_id") / 16).cast("int").alias("tile_y"), (F.col("patch_id") % 16).cast("int").alias("tile_x"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.col("rgb").alias("data"), F.lit(None).cast("string").alias("error"))
    return raster.tiles_to_patches(t, patch=6, per_side=2).select("slide_id", "row", "col", "x", "y", F.hex("rgb").alias("rgb"), F.col("error").isNull().alias("ok"))


@_query(o.EMBEDDING)
def embed_patches(spark: SparkSession, d: str) -> DataFrame:
    out = embed.extract_features(fixtures.packed(spark, d), patch=8)
    return out.select("slide_id", "patch_id", F.transform("embedding", lambda x: _r(x.cast("double"), 4)).alias("embedding"))


@_query(o.ZARR_GROUPS)
def zarr_groups(spark: SparkSession, d: str) -> DataFrame:
    """Kept patches written as a Zarr group for each slide, and read back."""
    out = _folder(spark, "zarr")
    places = fixtures.patches(spark, d).withColumn("slide_id", F.concat(F.lit("s"), "slide_id"))
    grid = raster.patch_index_grid(places)
    pixels = fixtures.packed(spark, d).select(F.concat(F.lit("s"), "slide_id").alias("slide_id"), F.floor(F.col("patch_id") / 16).cast("int").alias("row"), (F.col("patch_id") % 16).cast("int").alias("col"), "rgb")
    arrays.write_zarr(pixels, grid, out, {"patches": ("rgb", [8, 8, 3], "|u1")})
    return arrays.read_zarr(spark, out, "patches").select("stem", "idx", F.hex("data").alias("pixels"))


def _per_patch(spark: SparkSession, d: str, schema: str, rows: Callable) -> DataFrame:
    """rows(8 x 8 x 3 pixels) of each patch, as arrays of equal lengths."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            for slide, patch, rgb in zip(b["slide_id"], b["patch_id"], b["rgb"], strict=True):
                out = rows(np.frombuffer(rgb, np.uint8).reshape(1, 8, 8, 3))
                yield pd.DataFrame({"slide_id": slide, "patch_id": patch, **dict(zip(names, out, strict=True))})

    return fixtures.packed(spark, d).mapInPandas(run, f"slide_id int, patch_id long, {schema}")


@_query(o.WINDOW_TOKENS)
def window_tokens(spark: SparkSession, d: str) -> DataFrame:
    def rows(x):
        t = swin.windows(x, 4, 2)[0]
        assert np.array_equal(swin.unwindows(t[None], 8, 8, 4, 2), x)
        window, token = np.divmod(np.arange(64), 16)
        return [window, token, *t.reshape(64, 3).T]

    return _per_patch(spark, d, "window int, token int, r int, g int, b int", rows)


@_query(o.MERGED_TOKENS)
def merged_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _per_patch(spark, d, "token int, channels array<int>", lambda x: [np.arange(16), list(swin.merge_tokens(x)[0].reshape(16, 12))])


@_query(o.POOLED_TOKENS)
def pooled_tokens(spark: SparkSession, d: str) -> DataFrame:
    out = _per_patch(spark, d, "r double, g double, b double", lambda x: swin.pool(x.astype(float)).T)
    return out.select("slide_id", "patch_id", *[_r(c).alias(c) for c in "rgb"])


@_query(o.LAYER_NORM)
def layer_norm(spark: SparkSession, d: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def norm(s: pd.Series) -> pd.Series:
        return pd.Series([swin.layer_norm(np.asarray(x, float), np.float64(2), np.float64(0.5)) for x in s])

    return fixtures.table(spark, d, "embeddings").select("vec_id", F.transform(norm("embedding"), lambda x: _r(x, 4)).alias("normed"))


@_query(o.RELATIVE_INDEX)
def relative_position_index(spark: SparkSession, d: str) -> DataFrame:
    at = swin.relative_index(7)
    return spark.createDataFrame([(i, j, int(at[i, j])) for i in range(49) for j in range(49)], "a int, b int, bias_row int")


@_query(o.SHIFT_MASK)
def shift_mask(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(int(w), int(a), int(b)) for w, a, b in np.argwhere(swin.shift_mask(14, 7, 3) == 0)], "window int, a int, b int")


@_query()
def swin_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of a small untrained network; tests hold its parts against loops."""
    small = swin.Variant(16, (2, 2), window=4, side=32, head_width=8)

    def load() -> embed.Embedder:
        net = swin.network(small, swin.initial(small, 1))
        return lambda batch: net(embed.normalise(batch.repeat(4, 1).repeat(4, 2)))

    embed.register_embedder("small", load)
    return embed.extract_features(fixtures.packed(spark, d), "small", patch=8)


@_query(o.RECONSTRUCT)
def reconstruct_mosaic(spark: SparkSession, d: str) -> DataFrame:
    p = fixtures.packed(spark, d).withColumns({"row": F.floor(F.col("patch_id") / 16).cast("int"), "col": (F.col("patch_id") % 16).cast("int")})
    m = raster.reconstruct(raster.patch_coordinates(p, 8), 8)
    return m.select("slide_id", "width", "height", F.length("rgb").cast("long").alias("bytes"))


# --- slides ------------------------------------------------------------------------------------------------------------


def _slides(spark: SparkSession, d: str) -> DataFrame:
    orders = fixtures.table(spark, d, "orders")
    return orders.select(F.concat(F.lit("in/s"), F.col("o_orderkey"), F.lit(".svs")).alias("path"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))


@_query(o.MPP_CHAIN)
def mpp_chain(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame(fixtures.MPP_CASES, "name string, props map<string,string>")
    m = metadata.mpp(F.col("props"))
    return df.select("name", _r(m).alias("mpp"), F.when(m.isNull(), "mpp_extraction_error").otherwise("ok").alias("status"), metadata.resolution_differs(F.col("props")).alias("differs"))


@_query(o.BEST_LEVEL)
def best_level(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    levels = F.array(F.lit(1.0), (k % 3 + 2).cast("double"), (k % 5 + 6).cast("double"))
    s = _slides(spark, d).select("k", levels.alias("ds"), (0.25 + k % 4 * 0.25).alias("mpp"))
    best = metadata.best_level_for_mpp(F.col("ds"), F.col("mpp"), F.lit(2.0))
    asked = F.when(F.col("k") % 4 > 0, (F.col("k") % 4 - 1).cast("int"))
    return s.select("k", best.alias("proposed"), metadata.resolve_level(asked, best).alias("level"), metadata.level_clamped(asked, best).alias("clamped"))


@_query(o.TILE_SIZE)
def tile_size(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    s = _slides(spark, d).select("k", ((0.25 + k % 7 * 0.05) * F.pow(F.lit(2.0), k % 3)).alias("level_mpp"))
    size = metadata.tile_size(F.col("level_mpp"))
    padded = metadata.pad_dimension((F.col("k") % 9000 + 1).cast("int"), size)
    return s.select("k", size.alias("tile"), _r(metadata.effective_mpp(size, F.col("level_mpp"))).alias("effective_mpp"), padded.alias("padded"), metadata.reference_position(F.col("k") % 11, F.pow(F.lit(2.0), F.col("k") % 3), size).alias("ref_x"))


@_query(o.CHUNK_KEYS)
def parse_chunk_key(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    key = F.when(k % 10 == 0, F.concat(F.lit("bad/"), k.cast("string"))).otherwise(F.concat_ws("", (k % 4).cast("string"), F.lit("/"), (k % 13).cast("string"), F.lit("."), (k % 17).cast("string"), F.lit(".0")))
    s = _slides(spark, d).select("k", key.alias("key"))
    parts = metadata.parse_chunk_key(F.col("key"))
    levels = F.array(*[F.struct(F.lit(w).alias("width"), F.lit(w).alias("height")) for w in (100, 50, 25)])
    return s.select("k", *[F.coalesce(v, F.lit(-1)).alias(n) for n, v in parts.items()], metadata.has_chunk(parts["level"], parts["y"], parts["x"], levels, F.lit(10)).alias("present"))


@_query(o.STEMS)
def slide_stems(spark: SparkSession, d: str) -> DataFrame:
    return _slides(spark, d).select("path", metadata.stem(F.col("path")).alias("stem"))


@_query(o.MULTISCALE)
def multiscale_attributes(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame([("a", [4, 2]), ("b", [1])], "name string, w array<int>")
    return df.select("name", metadata.multiscale_metadata(F.transform("w", lambda w: F.struct(w.alias("width")))).alias("attrs"))


@_query(o.PENDING)
def pending_slides(spark: SparkSession, d: str) -> DataFrame:
    s = _slides(spark, d)
    return sinks.pending(s, s.where("status <> 'O'").select("path", "status")).select("path")


@_query(o.PENDING_RETRY)
def pending_slides_retry(spark: SparkSession, d: str) -> DataFrame:
    s = _slides(spark, d)
    done = s.where("status <> 'O'").select("path", F.when(F.col("status") == "F", "done").otherwise("load_error").alias("status"))
    return sinks.pending(s, done, retry_failed=True).select("path")


@_query(o.STATUS_SUMMARY)
def status_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _slides(spark, d).select("path", F.col("status"), F.when(F.col("status") != "P", F.col("k") % 100 * 0.5).alias("elapsed_s"))
    return sinks.summary(s).select("status", "n", _r("mean_elapsed_s").alias("mean_elapsed_s"))


@_query(o.TILE_SCAN)
def tile_scan(spark: SparkSession, d: str) -> DataFrame:
    """Tiles of a synthetic two-level slide through the data source."""
    df = tiles.read_tiles(spark, ["synthetic://100x70?levels=2&seed=3"], tile=32)
    return df.select("level", "tile_y", "tile_x", "height", "width", F.length("data").cast("long").alias("bytes"), F.col("error").isNull().alias("ok"))


@_query(o.SLIDE_HEADERS)
def slide_headers(spark: SparkSession, d: str) -> DataFrame:
    """Headers, resolution, level and tile of synthetic slides, one without a resolution and one that can't be opened."""
    found = slides.plan_levels(slides.open_headers(slides.slides_from_paths(spark, [p for p, *_ in o.SLIDES])), 2.0, None, 8)
    return found.select("path", "mpp", "level", "tile", F.coalesce("status", F.lit("ok")).alias("status"))


@_query(o.PROCESS_SLIDES)
def process_slides(spark: SparkSession, d: str) -> DataFrame:
    """The whole plan over the same slides: status log, grid, and whether features, patches, normalised patches and coordinates hold the same patches."""
    out = _folder(spark, "process")
    settings = config.Config(output=config.OutputConfig(path=out), patch_size=8, target_mpp=2.0)
    preprocess.run(spark, settings, slides.slides_from_paths(spark, [p for p, *_ in o.SLIDES]))
    grid = sinks.read_results(spark, out, "patch_index_grid")
    cells = grid.groupBy("slide_id").agg(F.count("*").alias("grid_cells"), F.count_if(F.col("patch_index") >= 0).alias("kept"))
    for t in ("features", "patches", "normalized_patches", "coords"):
        cells = cells.join(sinks.read_results(spark, out, t).groupBy("slide_id").agg(F.count("*").alias(t)), "slide_id", "left")
    agree = F.lit(True)
    for t in ("features", "patches", "normalized_patches", "coords"):
        agree = agree & (F.coalesce(t, F.lit(0)) == F.coalesce("kept", F.lit(0)))
    status = sinks.read_status(spark, out).select("path", "status")
    return status.join(cells.withColumnRenamed("slide_id", "path"), "path", "left").select("path", "status", F.coalesce("grid_cells", F.lit(0)).alias("grid_cells"), agree.alias("tables_agree"))


def queries() -> dict[str, Query]:
    def run(f: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return query

    return {name: run(f) for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
