import hashlib
import math

import numpy as np
import pytest

from tilelake.operators import embed, swin

SMALL = swin.Variant(16, (2, 2), window=4, side=32, head_width=8)


def weights(v, seed=3):
    rng = np.random.default_rng(seed)
    return {k: (rng.normal(size=s) * 0.3 + (1 if k.endswith(("norm.weight", "norm1.weight", "norm2.weight")) else 0)).astype(np.float32) if "running_var" not in k else rng.uniform(0.5, 2, s).astype(np.float32) for k, s in swin.shapes(v).items()}


def test_gelu_is_within_bounds():
    x = np.linspace(-6, 6, 1001)
    want = [0.5 * v * (1 + math.erf(v / math.sqrt(2))) for v in x]
    assert np.abs(swin.gelu(x) - want).max() < 1e-6


def test_convolution_by_loops():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(2, 6, 6, 3)), rng.normal(size=(5, 3, 3, 3))
    got = swin.convolve(x, w, 2, 1)
    assert got.shape == (2, 3, 3, 5)
    for n, y, z, o in np.ndindex(got.shape):
        want = sum(x[n, 2 * y + a - 1, 2 * z + b - 1] @ w[o, :, a, b] for a in range(3) for b in range(3) if 0 <= 2 * y + a - 1 < 6 and 0 <= 2 * z + b - 1 < 6)
        assert abs(got[n, y, z, o] - want) < 1e-9


@pytest.mark.parametrize("shift", [0, 2])
def test_block_by_loops(shift):
    """Each token attends to those that share its window and its part of the image, in places of the original image."""
    w, at, side, size, c, heads = {k: a.astype(float) for k, a in weights(SMALL).items()}, "layers.0.blocks.1", 8, 4, 16, 2
    x = np.random.default_rng(1).normal(size=(1, side, side, c))
    norm = lambda v, k: (v - v.mean()) / math.sqrt(v.var() + 1e-5) * w[f"{at}.{k}.weight"] + w[f"{at}.{k}.bias"]
    qkv = {p: w[f"{at}.attn.qkv.weight"] @ norm(x[0][p], "norm1") + w[f"{at}.attn.qkv.bias"] for p in np.ndindex(side, side)}
    cell = lambda p: tuple(((k - shift) % side) // size for k in p)
    wraps = lambda p: tuple(k < shift for k in p)
    want = np.empty_like(x)
    for p in np.ndindex(side, side):
        near = [q for q in np.ndindex(side, side) if cell(q) == cell(p) and wraps(q) == wraps(p)]
        out = []
        for h in range(heads):
            part = lambda v, k: v[k * c + h * 8 : k * c + h * 8 + 8]  # noqa: B023, E731
            dist = [[(p[k] - shift) % side - (q[k] - shift) % side for k in (0, 1)] for q in near]
            s = np.array([part(qkv[p], 0) @ part(qkv[q], 1) / math.sqrt(8) + w[f"{at}.attn.relative_position_bias_table"][(a + 3) * 7 + b + 3, h] for q, (a, b) in zip(near, dist, strict=True)])
            e = np.exp(s - s.max())
            out.append(sum(f * part(qkv[q], 2) for f, q in zip(e / e.sum(), near, strict=True)))
        y = x[0][p] + w[f"{at}.attn.proj.weight"] @ np.concatenate(out) + w[f"{at}.attn.proj.bias"]
        hidden = w[f"{at}.mlp.fc1.weight"] @ norm(y, "norm2") + w[f"{at}.mlp.fc1.bias"]
        hidden = np.array([0.5 * v * (1 + math.erf(v / math.sqrt(2))) for v in hidden])
        want[0][p] = y + w[f"{at}.mlp.fc2.weight"] @ hidden + w[f"{at}.mlp.fc2.bias"]
    assert np.allclose(swin.block(x, w, at, heads, size, shift), want, atol=1e-5)


@pytest.mark.parametrize("stem", ["conv", "patch"])
def test_network_does_not_mix_images(stem):
    v = swin.Variant(16, (2, 2), window=4, side=32, head_width=8, stem=stem)
    net, x = swin.network(v, weights(v)), np.random.default_rng(2).normal(size=(3, 3, 32, 32)).astype(np.float32)
    all_, one = net(x), np.concatenate([net(x[i : i + 1]) for i in range(3)])
    assert all_.shape == (3, 32) and np.isfinite(all_).all() and np.allclose(all_, one, atol=1e-4) and not np.allclose(all_[0], all_[1])


def test_published_size():
    v = swin.VARIANTS["tiny"]
    assert v.features == embed.WIDTH and [s for s, *_ in v.stages()] == [56, 28, 14, 7] and [h for *_, h, _ in v.stages()] == [3, 6, 12, 24]
    out = swin.network(v, swin.initial(v, 0))(np.zeros((1, 3, 224, 224), np.float32))
    assert out.shape == (1, 768) and out.dtype == np.float32
    with pytest.raises(ValueError, match="divide"):
        swin.Variant(96, (2, 2), side=100).stages()


def test_weights_file(tmp_path, spark):
    w = weights(SMALL) | {"head.weight": np.zeros((2, 2)), "layers.0.blocks.0.attn.relative_position_index": np.zeros(1)}
    path = tmp_path / "w.npz"
    np.savez(path, **w)
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    embed.register_embedder("file", embed.swin_embedder(str(path), digest, SMALL))
    batch = np.random.default_rng(4).integers(0, 256, (3, 32, 32, 3), dtype=np.uint8)
    df = spark.createDataFrame([(i, batch[i].tobytes()) for i in range(3)] + [(3, None)], "i int, rgb binary")
    got = {r.i: r.embedding for r in embed.extract_features(df, "file", patch=32, batch_size=2).collect()}
    want = swin.forward(embed.normalise(batch), SMALL, w)
    assert got[3] is None and np.allclose([got[i] for i in range(3)], want, atol=1e-4)
    with pytest.raises(ValueError, match="SHA-256"):
        swin.load(str(path), "0" * 64, SMALL)
    with pytest.raises(ValueError, match="norm.bias"):
        swin.network(SMALL, {k: a for k, a in w.items() if k != "norm.bias"})
