import json
import os
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.functions import metadata
from tilelake.operators import sinks
from tilelake.plans import preprocess
from tilelake.plans.config import Config, override, show
from tilelake.sources import slides, tiles
from tilelake.sources.readers import open_slide, pyramid
from tilelake.streaming.incremental import run_incremental


def test_read_region_contract(tmp_path):
    a = np.random.default_rng(0).integers(0, 255, (40, 60, 3)).astype(np.uint8)
    (tmp_path / "a.ppm").write_bytes(b"P6\n# c\n60 40\n255\n" + a.tobytes())
    with open_slide(str(tmp_path / "a.ppm")) as s:
        assert s.level_dimensions == [(60, 40), (30, 20), (15, 10)] and s.best_level_for_downsample(3.0) == 1
        got = s.read_region((10, 5), 0, (20, 30))
        assert got.shape == (30, 20, 3) and got.dtype == np.uint8 and (got == a[5:35, 10:30]).all()
        edge = s.read_region((50, 30), 0, (20, 20))
        assert (edge[:10, :10] == a[30:, 50:]).all() and not edge[10:].any() and not edge[:, 10:].any()
        with pytest.raises(ValueError):
            s.read_region((0, 0), 0, (-1, 5))
        with pytest.raises(ValueError):
            s.read_region((0, 0), 3, (1, 1))
    with pytest.raises(ValueError):
        open_slide("x", "nothing")


def test_library_backends_with_stand_ins(monkeypatch):
    """The libraries are absent here: modules of their interface take their place."""
    a = np.random.default_rng(1).integers(0, 256, (8, 8, 4), dtype=np.uint8)

    class Slide:
        level_dimensions, level_downsamples, properties = ((8, 8),), (1.0,), {"openslide.mpp-x": "0.5"}
        resolutions = {"level_dimensions": ((8, 8),), "level_downsamples": (1.0,)}

        def __init__(self, path):
            self.path = path

        def read_region(self, location, level, size):
            (x, y), (w, h) = location, size
            return a[y : y + h, x : x + w]

        def close(self):
            pass

    monkeypatch.setitem(sys.modules, "openslide", types.SimpleNamespace(OpenSlide=Slide))
    monkeypatch.setitem(sys.modules, "cucim", types.SimpleNamespace(CuImage=Slide))
    for backend in ("openslide", "cucim"):
        with open_slide("x.svs", backend) as s:
            assert s.properties["openslide.mpp-x"] == "0.5" and s.level_dimensions == [(8, 8)] and s.best_level_for_downsample(4.0) == 0
            assert np.array_equal(s.read_region((1, 2), 0, (3, 4)), a[2:6, 1:4, :3])
            with pytest.raises(ValueError, match="negative"):
                s.read_region((0, 0), 0, (1, -1))


def test_tiles_cover_the_level(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 255, (50, 70, 3)).astype(np.uint8)
    os.makedirs(tmp_path / "s")
    for i, level in enumerate(pyramid(a, 2)):
        np.save(tmp_path / "s" / f"level_{i}.npy", level)
    rows = tiles.read_tiles(spark, [str(tmp_path / "s"), str(tmp_path / "none.ppm")], 16, 0).collect()
    good = [r for r in rows if r.error is None]
    assert len(good) == 4 * 5 and [r.slide_id for r in rows if r.error] == [str(tmp_path / "none.ppm")]
    canvas = np.zeros((64, 80, 3), np.uint8)
    for r in good:
        canvas[r.tile_y * 16 : r.tile_y * 16 + 16, r.tile_x * 16 : r.tile_x * 16 + 16] = np.frombuffer(r.data, np.uint8).reshape(16, 16, 3)
        assert r.is_padded == (r.tile_y == 3 or r.tile_x == 4)
    assert (canvas[:50, :70] == a).all() and not canvas[50:].any()


def test_level_filter_is_pushed_down(spark):
    df = tiles.read_tiles(spark, ["synthetic://64x64?levels=3"], 16).where("level = 2")
    assert df.count() == 1
    assert "level" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("requested,proposed,level,clamped", [(None, 2, 2, False), (0, 2, 0, False), (2, 2, 2, False), (3, 1, 1, True)])
def test_levels(spark, requested, proposed, level, clamped):
    r = spark.range(1).select(metadata.resolve_level(F.lit(requested).cast("int"), F.lit(proposed)).alias("l"), metadata.level_clamped(F.lit(requested).cast("int"), F.lit(proposed)).alias("c")).head()
    assert (r.l, r.c) == (level, clamped)


def test_best_level_takes_the_first_of_equals(spark):
    assert spark.range(1).select(metadata.best_level(F.array(F.lit(1.0), F.lit(3.0), F.lit(9.0)), F.lit(2.0)).alias("b")).head().b == 0


def test_config():
    c = override(Config(), "target_mpp=256/224", "input.num_slides=3", "stain.exact=false", "input.level=null", "output.normalized_patches=false", "stain.enabled=false")
    assert c.target_mpp == 256 / 224 and c.input.num_slides == 3 and not c.stain.exact and c.input.level is None
    assert "num_slides: 3" in show(c)
    for bad in ("output.format=zip", "stain.method=other", "stain.enabled=false", "nothing=1", "input=1", "patch_size=0", "stain.exact=maybe"):
        with pytest.raises(ValueError):
            override(Config(), bad)


def _slide(folder, name, seed, mpp="2.0"):
    os.makedirs(folder, exist_ok=True)
    s = open_slide(f"synthetic://200x150?levels=1&seed={seed}")
    path = os.path.join(folder, name)
    os.makedirs(path)
    np.save(os.path.join(path, "level_0.npy"), s.read_region((0, 0), 0, (200, 150)))
    if mpp:
        json.dump({"openslide.mpp-x": mpp}, open(os.path.join(path, "properties.json"), "w"))
    return path


def test_preprocess_end_to_end(spark, tmp_path):
    paths = [_slide(str(tmp_path / "in"), f"s{i}", i, "2.0" if i < 2 else None) for i in range(3)] + [str(tmp_path / "in" / "gone.ppm")]
    found = slides.slides_from_paths(spark, paths)
    config = override(Config(), f"output.path={tmp_path}/out", "patch_size=8", "target_mpp=2", "slides_per_batch=3", f"output.status_markers={tmp_path}/st")
    got = {r.status: r.n for r in preprocess.run(spark, config, found).collect()}
    assert got == {"done": 2, "mpp_extraction_error": 1, "load_error": 1}
    assert sorted(os.listdir(tmp_path / "st")) == ["gone.done", "s0.done", "s1.done", "s2.done"]
    grid = sinks.read_results(spark, config.output.path, "patch_index_grid")
    feats = sinks.read_results(spark, config.output.path, "features")
    kept = grid.where("patch_index >= 0").count()
    assert grid.count() == 2 * 2 * 2 * 256 and 0 < kept < grid.count()
    for t in ("features", "coords", "patches", "normalized_patches"):
        assert sinks.read_results(spark, config.output.path, t).count() == kept
    assert feats.where("size(embedding) = 768").count() == kept
    before = sinks.read_status(spark, config.output.path).count()
    preprocess.run(spark, config, found)  # nothing is pending
    assert sinks.read_status(spark, config.output.path).count() == before
    retry = override(config, "retry_failed=true")
    preprocess.run(spark, retry, found)
    assert sinks.read_status(spark, config.output.path).count() == before + 2


def test_incremental_run(spark, tmp_path):
    a = open_slide("synthetic://64x64?levels=1").read_region((0, 0), 0, (64, 64))
    os.makedirs(tmp_path / "in")
    for i in range(3):
        (tmp_path / "in" / f"a{i}.ppm").write_bytes(b"P6 64 64 255\n" + a.tobytes())
    config = override(Config(), f"input.path={tmp_path}/in", "input.glob=*.ppm", f"output.path={tmp_path}/out", "patch_size=8")
    for _ in range(2):
        run_incremental(spark, config, str(tmp_path / "cp"), per_batch=2).awaitTermination(120)
    assert {r.status: r.n for r in sinks.summary(sinks.read_status(spark, config.output.path)).collect()} == {"mpp_extraction_error": 3}


def test_find_slides_and_hash(spark, tmp_path):
    for n in ("b.svs", "a.svs", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert [r.stem for r in slides.find_slides(spark, str(tmp_path)).collect()] == ["a", "b"]
    assert slides.find_slides(spark, str(tmp_path), limit=1).count() == 1
    assert slides.file_sha256(spark, str(tmp_path / "a.svs")).head().sha256 == "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
