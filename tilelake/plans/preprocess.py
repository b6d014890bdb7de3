"""The whole preprocessing plan: slides to patches, coordinates, grids, normalised patches and features.

All pending slides of a batch go through one plan; parallelism comes from tiles. Patches are kept once (persisted to
disk where memory is short) because three consumers need them: the grid, the colour statistics and the outputs. Slides
that fail to open or have no resolution get a status and no data; tiles that fail are logged and leave their slide
without a 'done'.

    python -m tilelake.plans.preprocess input.path=... output.path=... [key=value ...] [--print-config]
"""

from __future__ import annotations

import logging
import sys
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.operators import embed, foreground, raster, sinks, stain
from tilelake.plans.config import Config, override, show
from tilelake.plans.shipping import ship
from tilelake.sources import slides as slide_source
from tilelake.sources import tiles as tile_source

log = logging.getLogger("tilelake")


def fit_reference(spark: SparkSession, config: Config) -> stain.StainModel:
    if config.stain.template is None:
        return stain.StainModel(exact=config.stain.exact)
    return stain.StainNormalizer(config.stain.exact).fit(slide_source.template_pixels(spark, config.stain.template))


def patch_table(spark: SparkSession, planned: list, config: Config) -> DataFrame:
    """All patches of the planned slides with edge_px and is_foreground; the tiles' errors are rows too."""
    tiles = tile_source.read_tiles(spark, [r.path for r in planned], [r.tile for r in planned], [r.level for r in planned], config.input.backend)
    return foreground.foreground_mask(raster.tiles_to_patches(tiles, config.patch_size), config.patch_size, config.foreground_mode)


def finish(kept: DataFrame, config: Config, model: stain.StainModel) -> DataFrame:
    """Foreground patches with normalized and embedding, as configured."""
    source = "rgb"
    if config.stain.enabled:
        kept, source = stain.normalise_patches(kept, stain.patch_statistics(kept, model.exact), model), "normalized"
    if config.features.enabled:
        kept = embed.extract_features(kept, config.features.model, config.patch_size, config.features.batch_size, source)
    return kept


def run_batch(spark: SparkSession, batch: DataFrame, config: Config, model: stain.StainModel) -> DataFrame:
    """Processes slides (path, stem) and returns their status rows, already logged."""
    began = time.time()
    planned = slide_source.plan_levels(slide_source.open_headers(batch, config.input.backend), config.target_mpp, config.input.level, config.patch_size).collect()  # a row per slide
    good = [r for r in planned if r.status is None]
    for r in planned:
        if r.level_clamped:
            log.warning("%s: the requested level is coarser than level %s for the target resolution", r.path, r.level)
    failed: set[str] = set()
    if good:
        spark.sparkContext.setJobDescription(f"{len(good)} slides")
        all_patches = patch_table(spark, good, config).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            failed = {r.slide_id for r in all_patches.where("error is not null").select("slide_id").distinct().collect()}
            whole = all_patches.where("error is null")
            grid = raster.patch_index_grid(whole.select("slide_id", "row", "col", "is_foreground"))
            with stain.holding():
                sinks.write_outputs(finish(whole.where("is_foreground"), config, model), grid, config.output.path, config.output, patch=config.patch_size, width=config.features.width)
        finally:
            all_patches.unpersist()
            spark.sparkContext.setJobDescription(None)
    each = (time.time() - began) / max(1, len(planned))
    rows = [(r.path, r.stem, r.status or (sinks.LOAD_ERROR if r.path in failed else sinks.DONE), None if r.status else each) for r in planned]
    status = spark.createDataFrame(rows, sinks.STATUS)
    sinks.append_status(status, config.output.path)
    if config.output.status_markers:
        sinks.write_status_markers(status, config.output.status_markers)
    return status


def run(spark: SparkSession, config: Config, slides: DataFrame | None = None) -> DataFrame:
    """Processes all pending slides and returns the summary of the status log."""
    ship(spark)
    config.validate()
    if slides is None:
        slides = slide_source.find_slides(spark, config.input.path, config.input.glob)
    todo = sinks.pending(slides, sinks.read_status(spark, config.output.path), config.retry_failed)
    if config.input.num_slides is not None:
        todo = todo.limit(config.input.num_slides)
    paths = todo.select("path", "stem").collect()  # names only, a row per slide
    if not paths:
        log.warning("no slides to process")
    with stain.holding():
        model = fit_reference(spark, config)
    step = config.slides_per_batch or max(1, spark.sparkContext.defaultParallelism // 16)  # a batch's patches are held together
    for i in range(0, len(paths), step):
        run_batch(spark, spark.createDataFrame(paths[i : i + step], "path string, stem string"), config, model)
    return sinks.summary(sinks.read_status(spark, config.output.path))


def main(args: list[str]) -> None:
    config = override(Config(), *[a for a in args if not a.startswith("--")])
    if "--print-config" in args:
        print(show(config))
        return
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    run(SparkSession.builder.appName("tilelake").getOrCreate(), config).show()


if __name__ == "__main__":
    main(sys.argv[1:])
