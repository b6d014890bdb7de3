import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.operators import arrays, sinks, stain
from tilelake.plans import fixtures, preprocess
from tilelake.plans.config import Config, override
from tilelake.sources import slides

DIR = "/root/testdata/sf0.001"


def test_png_is_read_by_spark(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 256, (5, 7, 3), dtype=np.uint8)
    df = spark.createDataFrame([(1, a.tobytes(), 5, 7), (2, a.tobytes(), 5, 8), (3, None, 5, 7)], "i int, rgb binary, h int, w int")
    got = {r.i: r.png for r in df.select("i", arrays.to_png("rgb", "h", "w").alias("png")).collect()}
    assert got[2] is None and got[3] is None
    (tmp_path / "a.png").write_bytes(got[1])
    im = spark.read.format("image").load(str(tmp_path / "a.png")).head().image
    assert (im.height, im.width) == (5, 7) and np.array_equal(np.frombuffer(im.data, np.uint8).reshape(5, 7, 3)[:, :, ::-1], a)


def test_zarr_round_trip(spark, tmp_path):
    side, out = 5, str(tmp_path / "out")
    cells = [(s, y, x, (y * x + len(s)) % 3 > 0) for s in ("/in/a.svs", "/in/bb.svs") for y in range(side) for x in range(side)] + [("/in/none.svs", 0, 0, False)]
    data = {(s, y, x): bytes([len(s), y, x] * 4) for s, y, x, _ in cells}
    flags = spark.createDataFrame(cells, "slide_id string, row int, col int, fg boolean")
    from tilelake.operators import raster

    grid = raster.patch_index_grid(flags, "fg")
    patches = spark.createDataFrame([(s, y, x, data[s, y, x], [float(y), x + 0.5]) for s, y, x, f in cells if f], "slide_id string, row int, col int, rgb binary, v array<float>")
    for _ in range(2):  # the second time replaces the first
        arrays.write_zarr(patches, grid, out, {"patches": ("rgb", [2, 2, 3], "|u1"), "features": ("v", [2], "<f4")}, chunk=4)
    kept = {s: [(y, x) for t, y, x, f in cells if f and t == s] for s in {c[0] for c in cells}}
    got = {(r.stem, r.idx): bytes(r.data) for r in arrays.read_zarr(spark, out, "patches").collect()}
    assert got == {(os.path.basename(s)[:-4], i): data[s, y, x] for s, places in kept.items() for i, (y, x) in enumerate(places)}
    feats = {(r.stem, r.idx): list(np.frombuffer(r.data, "<f4")) for r in arrays.read_zarr(spark, out, "features").collect()}
    assert feats["a", 0] == [float(kept["/in/a.svs"][0][0]), kept["/in/a.svs"][0][1] + 0.5] and len(feats) == len(got)
    head = json.load(open(f"{out}/bb.zarr/patches/.zarray"))
    assert head["shape"] == [len(kept["/in/bb.svs"]), 2, 2, 3] and head["chunks"] == [4, 2, 2, 3]
    assert json.load(open(f"{out}/none.zarr/patches/.zarray"))["shape"][0] == 0
    index = np.stack([np.frombuffer(r.data, "<i4") for r in arrays.read_zarr(spark, out, "patch_index_grid").where("stem = 'a'").orderBy("idx").collect()])
    assert [tuple(p) for p in np.argwhere(index >= 0)] == kept["/in/a.svs"] and index.max() + 1 == len(kept["/in/a.svs"])


def test_plan_writes_groups(spark, tmp_path):
    found = slides.slides_from_paths(spark, ["synthetic://64x64?seed=3&levels=1&mpp=2.0"])
    base = override(Config(), "patch_size=8", "target_mpp=2")
    for kind in ("parquet", "zarr"):
        got = preprocess.run(spark, override(base, f"output.path={tmp_path}/{kind}", f"output.format={kind}"), found).collect()
        assert [(r.status, r.n) for r in got] == [("done", 1)]
    for name, column in (("patches", "rgb"), ("normalized_patches", "normalized"), ("features", "embedding")):
        want = [r[0] for r in sinks.read_results(spark, f"{tmp_path}/parquet", name).orderBy("row", "col").select(column).collect()]
        have = [r.data for r in arrays.read_zarr(spark, f"{tmp_path}/zarr", name).orderBy("idx").collect()]
        assert len(want) and [bytes(h) for h in have] == [np.asarray(w, "<f4").tobytes() if isinstance(w, list) else bytes(w) for w in want]


def test_variant_fit(spark):
    hist = stain.color_histogram(fixtures.pixels(spark, DIR)).where("slide_id = 1")
    model = stain.SparseStainModel.fit(hist)
    assert np.allclose(np.linalg.norm(np.array(model.target), axis=0), 1) and model.target != stain.HE_REF
    out = model.transform(hist)
    assert out.agg(F.sum("n")).head()[0] == hist.agg(F.sum("n")).head()[0]
    far = out.select((F.abs(F.col("nr") - F.col("r")) + F.abs(F.col("ng") - F.col("g")) + F.abs(F.col("nb") - F.col("b"))).alias("d"), "n").agg((F.sum(F.col("d") * F.col("n")) / F.sum("n"))).head()[0]
    assert far < 30  # its own target leaves colours about where they were
    with pytest.raises(ValueError, match="tissue"):
        stain.SparseStainModel.fit(hist.where("n < 0"))
