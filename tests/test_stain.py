import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.functions.color import HE_REF, MAXC_REF
from tilelake.operators import raster, stain


def numpy_statistics(px, io=240.0, beta=0.15, alpha=1.0):
    od = -np.log((px.astype(float) + 1) / io)
    tissue = od[(od >= beta).all(axis=1)]
    _, v = np.linalg.eigh(np.cov(tissue.T))
    v = v[:, 1:3] * np.where(tissue.mean(axis=0) @ v[:, 1:3] < 0, -1, 1)
    phi = np.arctan2(*(tissue @ v).T[::-1])
    ends = [v @ [np.cos(a), np.sin(a)] for a in np.percentile(phi, [alpha, 100 - alpha])]
    he = np.array(ends if ends[0][0] > ends[1][0] else ends[::-1]).T
    c = np.linalg.lstsq(he, od.T, rcond=None)[0]
    return he, c, np.percentile(c, 99, axis=1)


def numpy_normalise(px, ref=HE_REF, maxc_ref=MAXC_REF):
    he, c, maxc = numpy_statistics(px)
    return np.minimum(255, 240 * np.exp(-np.array(ref) @ (c / (maxc / np.array(maxc_ref))[:, None]))).T.astype(np.uint8)


def image(seed, n):
    rng = np.random.default_rng(seed)
    c = rng.gamma(2.0, 0.4, (2, n)) * rng.choice([0.05, 1.0], (1, n))
    noise = rng.normal(0, 0.01, (3, n))
    return np.clip(240 * np.exp(-(np.array(HE_REF) @ c + noise)), 0, 255).astype(np.uint8).T


@pytest.fixture(scope="module")
def slides(spark):
    images = {k: image(k, 3000 + 500 * k) for k in range(3)}
    rows = [(k, *map(int, p)) for k, im in images.items() for p in im]
    return images, spark.createDataFrame(rows, "slide_id int, r int, g int, b int").cache()


def test_statistics_equal_numpy(slides):
    images, px = slides
    hist = stain.color_histogram(px)
    for r in stain.stain_statistics(hist).collect():
        he, _, maxc = numpy_statistics(images[r.slide_id])
        assert np.allclose(np.array([r[c] for c in stain.HE]).reshape(2, 3).T, he)
        assert np.allclose([r.maxc_h, r.maxc_e], maxc)


def test_pixels_equal_numpy_and_packed(spark, slides):
    images, px = slides
    got = stain.StainModel().transform(px).select("slide_id", "r", "g", "b", "nr", "ng", "nb").distinct().collect()
    table = {(r.slide_id, r.r, r.g, r.b): (r.nr, r.ng, r.nb) for r in got}
    packed = spark.createDataFrame([(k, bytearray(im.tobytes())) for k, im in images.items()], "slide_id int, rgb binary")
    new = {r.slide_id: np.frombuffer(r.normalized, np.uint8).reshape(-1, 3) for r in stain.normalise_patches(packed, stain.stain_statistics(raster.packed_histogram(packed)), stain.StainModel()).collect()}
    for k, im in images.items():
        want = numpy_normalise(im)
        mine = np.array([table[k, *map(int, p)] for p in im])
        assert np.abs(mine - want.astype(int)).max() <= 1 and (mine != want).mean() < 1e-3
        assert np.abs(new[k].astype(int) - want).max() <= 1


def test_approximate_is_close(slides):
    images, px = slides
    hist = stain.color_histogram(px)
    for r in stain.stain_statistics(hist, exact=False).collect():
        he, _, maxc = numpy_statistics(images[r.slide_id])
        assert np.allclose(np.array([r[c] for c in stain.HE]).reshape(2, 3).T, he, atol=0.1)
        assert np.allclose([r.maxc_h, r.maxc_e], maxc, atol=0.1)


def test_fit_and_own_reference(slides):
    images, px = slides
    one = px.where("slide_id = 1")
    model = stain.StainNormalizer().fit(one)
    assert np.array(model.he).shape == (3, 2) and len(model.maxc) == 2
    same = model.transform(one).agg(F.avg(F.abs(F.col("r") - F.col("nr"))).alias("d")).head().d
    assert same < 3


def test_degenerate_slides_pass_through(spark):
    rows = [(0, 255, 255, 255)] * 9 + [(1, 120, 60, 130)] * 5 + [(2, 120, 60, 130)] + [(2, 250, 250, 250)] * 3
    px = spark.createDataFrame(rows, "slide_id int, r int, g int, b int")
    got = stain.StainModel().lut(stain.color_histogram(px)).collect()
    assert {(r.slide_id, r.r, r.nr, r.normalised) for r in got if r.slide_id != 1} == {(0, 255, 255, False), (2, 120, 120, False), (2, 250, 250, False)}
    with pytest.raises(ValueError):
        stain.StainNormalizer().fit(px.where("slide_id = 0"))


def test_lasso_against_enumeration(spark, slides):
    from tilelake.functions.linalg import lasso_two

    rng = np.random.default_rng(4)
    h = np.abs(rng.normal(size=(2, 3)))
    h /= np.linalg.norm(h, axis=1)[:, None]
    x = rng.normal(size=(200, 3))
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double, c double")
    c = lasso_two([F.lit(float(v)) for v in h[0]], [F.lit(float(v)) for v in h[1]], [F.col(v) for v in "abc"], 0.01)
    cost = lambda p, v: 0.5 * ((v - p @ h) ** 2).sum() + 0.01 * p.sum()
    for r in df.select("*", c[0].alias("p"), c[1].alias("q")).collect():
        v, p = np.array([r.a, r.b, r.c]), np.array([r.p, r.q])
        assert (p >= 0).all()
        for _ in range(20):
            assert cost(p, v) <= cost(np.maximum(0, p + rng.normal(size=2) * 0.05), v) + 1e-12
