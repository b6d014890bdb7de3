import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilelake.operators import embed, foreground, raster
from tilelake.operators.raster import resample, split_patches


def slow_canny(image, low, high):
    """The same rules pixel by pixel."""
    h, w, n = image.shape
    px = lambda y, x, c: int(image[min(max(y, 0), h - 1), min(max(x, 0), w - 1), c])
    g = np.zeros((h + 2, w + 2, 3), int)
    for y in range(h):
        for x in range(w):
            best = (-1, 0, 0)
            for c in range(n):
                dx = sum(k * (px(y + d, x + 1, c) - px(y + d, x - 1, c)) for d, k in ((-1, 1), (0, 2), (1, 1)))
                dy = sum(k * (px(y + 1, x + d, c) - px(y - 1, x + d, c)) for d, k in ((-1, 1), (0, 2), (1, 1)))
                if abs(dx) + abs(dy) > best[0]:
                    best = (abs(dx) + abs(dy), dx, dy)
            g[y + 1, x + 1] = best
    keep = np.zeros((h, w), bool)
    for y in range(1, h + 1):
        for x in range(1, w + 1):
            m, dx, dy = map(int, g[y, x])
            if m <= low:
                continue
            t, ay = abs(dx) * 13573, abs(dy) << 15
            if ay < t:
                ok = m > g[y, x - 1, 0] and m >= g[y, x + 1, 0]
            elif ay > t + (abs(dx) << 16):
                ok = m > g[y - 1, x, 0] and m >= g[y + 1, x, 0]
            else:
                s = -1 if (dx ^ dy) < 0 else 1
                ok = m > g[y - 1, x - s, 0] and m > g[y + 1, x + s, 0]
            keep[y - 1, x - 1] = ok
    todo = [(y, x) for y in range(h) for x in range(w) if keep[y, x] and g[y + 1, x + 1, 0] > high]
    out = np.zeros((h, w), bool)
    while todo:
        y, x = todo.pop()
        if 0 <= y < h and 0 <= x < w and keep[y, x] and not out[y, x]:
            out[y, x] = True
            todo += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(3, 20), st.integers(3, 20), st.sampled_from([1, 3]))
def test_canny_against_the_slow_form(seed, h, w, c):
    rng = np.random.default_rng(seed)
    image = (rng.integers(0, 4, (h, w, c)) * rng.integers(5, 60)).astype(np.uint8)
    assert (foreground.canny(image) == slow_canny(image, 40, 100)).all()


def test_flat_images_have_no_edges():
    for v in (0, 128, 255):
        assert not foreground.canny(np.full((9, 9, 3), v, np.uint8)).any()


def test_threshold_at_two_percent(spark):
    df = spark.createDataFrame([(3010,), (3011,), (0,), (None,)], "n int").select("n", foreground.is_background(F.col("n"), 224).alias("b"))
    assert {r.n: r.b for r in df.collect()} == {3010: True, 3011: False, 0: True, None: None}


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(1, 6))
def test_split_and_paste(rows, cols, p):
    image = np.random.default_rng(rows * 31 + cols).integers(0, 255, (rows * p, cols * p, 3)).astype(np.uint8)
    cut = split_patches(image, p)
    out = np.zeros_like(image)
    for i in range(rows):
        for j in range(cols):
            out[i * p : (i + 1) * p, j * p : (j + 1) * p] = cut[i, j]
    assert (out == image).all()


def test_resample():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 255, (7, 9, 3)).astype(np.uint8)
    assert (resample(a, 7, 9) == a).all()
    assert (resample(np.full((5, 5, 3), 77, np.uint8), 13, 11) == 77).all()
    want = np.zeros((14, 18, 3))
    for y in range(14):
        for x in range(18):
            fy, fx = (y + 0.5) / 2 - 0.5, (x + 0.5) / 2 - 0.5
            y0, x0 = int(np.floor(fy)), int(np.floor(fx))
            g = lambda i, j: a[min(max(i, 0), 6), min(max(j, 0), 8)].astype(float)
            want[y, x] = (g(y0, x0) * (1 - fx + x0) + g(y0, x0 + 1) * (fx - x0)) * (1 - fy + y0) + (g(y0 + 1, x0) * (1 - fx + x0) + g(y0 + 1, x0 + 1) * (fx - x0)) * (fy - y0)
    assert np.abs(resample(a, 14, 18) - want).max() <= 1


def test_tiles_to_patches_and_back(spark):
    rng = np.random.default_rng(3)
    tiles = {(y, x): rng.integers(0, 255, (12, 12, 3)).astype(np.uint8) for y in range(2) for x in range(3)}
    rows = [("s", y, x, 12, 12, bytearray(t.tobytes()), None) for (y, x), t in tiles.items()] + [("bad", 0, 0, 12, 12, None, "lost")]
    df = spark.createDataFrame(rows, "slide_id string, tile_y int, tile_x int, height int, width int, data binary, error string")
    patches = raster.tiles_to_patches(df, patch=3, per_side=4)
    assert patches.where("error is not null").collect()[0].slide_id == "bad"
    whole = raster.reconstruct(patches.where("error is null"), 3).head()
    want = np.concatenate([np.concatenate([tiles[y, x] for x in range(3)], axis=1) for y in range(2)])
    assert (np.frombuffer(whole.rgb, np.uint8).reshape(24, 36, 3) == want).all()
    hist = {(r.r, r.g, r.b): r.n for r in raster.packed_histogram(patches.where("error is null")).collect()}
    assert sum(hist.values()) == 24 * 36
    grid = raster.patch_index_grid(patches.where("error is null").withColumn("is_foreground", (F.col("row") + F.col("col")) % 3 != 0)).collect()
    kept = sorted((r.row, r.col, r.patch_index) for r in grid if r.patch_index >= 0)
    assert [k for *_, k in kept] == list(range(len(kept))) and sum(r.patch_index == -1 for r in grid) == len(grid) - len(kept)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = [(i, bytearray(rng.integers(0, 255, 16 * 16 * 3).astype(np.uint8).tobytes())) for i in range(7)] + [(7, None)]
    df = spark.createDataFrame(rows, "i int, rgb binary")
    got = {r.i: r.embedding for r in embed.extract_features(df, patch=16, batch_size=3).collect()}
    assert got[7] is None and all(len(got[i]) == embed.WIDTH for i in range(7)) and got[0] != got[1]
    batch = np.frombuffer(rows[0][1], np.uint8).reshape(1, 16, 16, 3)
    assert np.allclose(embed.EMBEDDERS["histogram"]()(batch)[0], got[0], atol=1e-5)
    try:
        embed.extract_features(df, "unknown")
    except ValueError:
        return
    raise AssertionError
