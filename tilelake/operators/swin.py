"""A vision transformer with shifted windows (Liu et al., 2021), forward pass in NumPy, for workers without torch.

A network is a Variant and a dict of arrays under the names of published checkpoints. Tokens are (n, h, w, c). The stem is
three convolutions ('conv') or one of 4 x 4 pixels ('patch'). Dropout and stochastic depth do nothing in inference and
are left out; the classifier's head is dropped, so features are the pooled, normalised tokens of the last stage.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

EPS = 1e-5
#: What is added to the score of two tokens that are neighbours only because of the shift (fixed value).
FAR = -100.0
_PIXELS = 1 << 19  # pixels of one pass: bounds the memory of the widest layer to about 50 MB
_IGNORED = ("relative_position_index", "attn_mask", "num_batches_tracked")


@dataclass(frozen=True)
class Variant:
    width: int
    depths: tuple[int, ...]
    window: int = 7
    side: int = 224
    stem: str = "conv"
    head_width: int = 32

    @property
    def features(self) -> int:
        return self.width << (len(self.depths) - 1)

    def stages(self) -> list[tuple[int, int, int, int]]:
        """Side in tokens, width, heads and window of each stage. A stage smaller than the window is one window."""
        out = []
        for i in range(len(self.depths)):
            side, width = self.side >> (2 + i), self.width << i
            window = min(self.window, side)
            if self.side % (4 << i) or not side or side % window or width % self.head_width:
                raise ValueError(f"stage {i}: {side} tokens a side and {width} channels don't divide into windows and heads")
            out.append((side, width, width // self.head_width, window))
        return out


#: Published sizes (fixed values).
VARIANTS = {
    "tiny": Variant(96, (2, 2, 6, 2)),
    "small": Variant(96, (2, 2, 18, 2)),
    "base": Variant(128, (2, 2, 18, 2)),
    "large": Variant(192, (2, 2, 18, 2)),
}


def shapes(v: Variant) -> dict[str, tuple[int, ...]]:
    """Name and shape of every array that a network of this variant has."""
    out: dict[str, tuple[int, ...]] = {}

    def pair(name: str, weight: tuple[int, ...], bias: bool = True) -> None:
        out[f"{name}.weight"] = weight
        if bias:
            out[f"{name}.bias"] = weight[:1]

    if v.stem == "conv":
        n = v.width // 8
        for k, (a, b) in ((0, (3, n)), (3, (n, 2 * n))):
            pair(f"patch_embed.proj.{k}", (b, a, 3, 3), bias=False)
            pair(f"patch_embed.proj.{k + 1}", (b,))
            out |= {f"patch_embed.proj.{k + 1}.running_{s}": (b,) for s in ("mean", "var")}
        pair("patch_embed.proj.6", (v.width, 2 * n, 1, 1))
    else:
        pair("patch_embed.proj", (v.width, 3, 4, 4))
    pair("patch_embed.norm", (v.width,))
    for i, (_, c, heads, window) in enumerate(v.stages()):
        for j in range(v.depths[i]):
            at = f"layers.{i}.blocks.{j}"
            out[f"{at}.attn.relative_position_bias_table"] = ((2 * window - 1) ** 2, heads)
            for name, weight in (("norm1", (c,)), ("attn.qkv", (3 * c, c)), ("attn.proj", (c, c)), ("norm2", (c,)), ("mlp.fc1", (4 * c, c)), ("mlp.fc2", (c, 4 * c))):
                pair(f"{at}.{name}", weight)
        if i + 1 < len(v.depths):
            pair(f"layers.{i}.downsample.norm", (4 * c,))
            pair(f"layers.{i}.downsample.reduction", (2 * c, 4 * c), bias=False)
    pair("norm", (v.features,))
    return out


def initial(v: Variant, seed: int) -> dict[str, np.ndarray]:
    """Untrained weights: normal with deviation 0.02, none beyond two deviations; norms are the identity."""
    rng, out = np.random.default_rng(seed), {}
    for name, shape in shapes(v).items():
        if len(shape) == 1:
            one = name.endswith(("weight", "running_var"))
            out[name] = np.full(shape, float(one), np.float32)
            continue
        x = rng.normal(size=shape)
        while (far := np.abs(x) > 2).any():
            x[far] = rng.normal(size=int(far.sum()))
        out[name] = (0.02 * x).astype(np.float32)
    return out


def check(v: Variant, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays that the network uses. Missing, unknown and misshapen ones are an error."""
    used = {k: a for k, a in weights.items() if not k.startswith("head.") and not k.endswith(_IGNORED)}
    want = shapes(v)
    wrong = sorted(set(used) ^ set(want)) + sorted(k for k in set(used) & set(want) if used[k].shape != want[k])
    if wrong:
        raise ValueError(f"weights don't fit the variant: {', '.join(wrong[:5])}")
    return used


def layer_norm(x: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    d = x - x.mean(-1, keepdims=True)
    return d / np.sqrt((d * d).mean(-1, keepdims=True) + EPS) * weight + bias


def gelu(x: np.ndarray) -> np.ndarray:
    """x times the normal distribution function, by a rational form of erf that is within 2e-7."""
    z = np.abs(x) * 0.7071067811865476
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return (0.5 * x * (1 + np.sign(x) * (1 - poly * np.exp(-z * z)))).astype(x.dtype)


def windows(x: np.ndarray, size: int, shift: int = 0) -> np.ndarray:
    """(n, h, w, c) to (n, windows, size * size, c), row by row, of the image rolled back by shift."""
    x = np.roll(x, (-shift, -shift), (1, 2))
    n, h, w, c = x.shape
    return np.einsum("nyaxbc->nyxabc", x.reshape(n, h // size, size, w // size, size, c)).reshape(n, -1, size * size, c)


def unwindows(t: np.ndarray, h: int, w: int, size: int, shift: int = 0) -> np.ndarray:
    n, c = len(t), t.shape[-1]
    x = np.einsum("nyxabc->nyaxbc", t.reshape(n, h // size, w // size, size, size, c)).reshape(n, h, w, c)
    return np.roll(x, (shift, shift), (1, 2))


def relative_index(size: int) -> np.ndarray:
    """Row of the bias table for each pair of tokens of a window: their distance in rows, then in columns."""
    y, x = np.divmod(np.arange(size * size), size)
    return (y[:, None] - y + size - 1) * (2 * size - 1) + x[:, None] - x + size - 1


def shift_mask(side: int, size: int, shift: int) -> np.ndarray:
    """(windows, tokens, tokens): FAR where two tokens of a window come from parts of the image that do not touch."""
    part = np.searchsorted([side - size, side - shift], np.arange(side), side="right")
    region = windows((3 * part[:, None] + part)[None, :, :, None], size)[0, :, :, 0]
    return np.where(region[:, :, None] == region[:, None, :], 0.0, FAR).astype(np.float32)


def merge_tokens(x: np.ndarray) -> np.ndarray:
    """Four neighbours side by side: upper left, lower left, upper right, lower right."""
    return np.concatenate([x[:, a::2, b::2] for b in (0, 1) for a in (0, 1)], -1)


def attend(t: np.ndarray, w: dict[str, np.ndarray], at: str, heads: int, size: int, mask: np.ndarray | None) -> np.ndarray:
    """Self-attention within each window of (n, windows, tokens, c)."""
    n, k, tokens, c = t.shape
    q, key, value = np.moveaxis((t @ w[f"{at}.qkv.weight"].T + w[f"{at}.qkv.bias"]).reshape(n, k, tokens, 3, heads, c // heads), (3, 4), (0, 3))
    score = q @ np.swapaxes(key, -1, -2) * (c // heads) ** -0.5
    score += np.moveaxis(w[f"{at}.relative_position_bias_table"][relative_index(size)], -1, 0)
    if mask is not None:
        score += mask[:, None]
    e = np.exp(score - score.max(-1, keepdims=True))
    out = np.swapaxes(e / e.sum(-1, keepdims=True) @ value, 2, 3).reshape(n, k, tokens, c)
    return out @ w[f"{at}.proj.weight"].T + w[f"{at}.proj.bias"]


def block(x: np.ndarray, w: dict[str, np.ndarray], at: str, heads: int, size: int, shift: int) -> np.ndarray:
    side = x.shape[1]
    norm = lambda y, k: layer_norm(y, w[f"{at}.{k}.weight"], w[f"{at}.{k}.bias"])
    mask = shift_mask(side, size, shift) if shift else None
    x = x + unwindows(attend(windows(norm(x, "norm1"), size, shift), w, f"{at}.attn", heads, size, mask), side, side, size, shift)
    hidden = gelu(norm(x, "norm2") @ w[f"{at}.mlp.fc1.weight"].T + w[f"{at}.mlp.fc1.bias"])
    return x + hidden @ w[f"{at}.mlp.fc2.weight"].T + w[f"{at}.mlp.fc2.bias"]


def convolve(x: np.ndarray, weight: np.ndarray, stride: int, pad: int) -> np.ndarray:
    """(n, h, w, c) with weight (out, c, k, k)."""
    k = weight.shape[-1]
    x = np.pad(x, ((0, 0), (pad, pad), (pad, pad), (0, 0)))
    seen = np.lib.stride_tricks.sliding_window_view(x, (k, k), (1, 2))[:, ::stride, ::stride]
    return np.tensordot(seen, weight, ((3, 4, 5), (1, 2, 3)))


def stem(x: np.ndarray, v: Variant, w: dict[str, np.ndarray]) -> np.ndarray:
    """(n, side, side, 3) to tokens of 4 x 4 pixels."""
    at = "patch_embed.proj"
    if v.stem == "conv":
        for k in (0, 3):
            x = convolve(x, w[f"{at}.{k}.weight"], 2, 1)
            scale = w[f"{at}.{k + 1}.weight"] / np.sqrt(w[f"{at}.{k + 1}.running_var"] + EPS)
            x = np.maximum((x - w[f"{at}.{k + 1}.running_mean"]) * scale + w[f"{at}.{k + 1}.bias"], 0)
        x = convolve(x, w[f"{at}.6.weight"], 1, 0) + w[f"{at}.6.bias"]
    else:
        x = convolve(x, w[f"{at}.weight"], 4, 0) + w[f"{at}.bias"]
    return layer_norm(x, w["patch_embed.norm.weight"], w["patch_embed.norm.bias"])


def pool(x: np.ndarray) -> np.ndarray:
    """Mean of all tokens."""
    return x.mean((1, 2))


def forward(x: np.ndarray, v: Variant, w: dict[str, np.ndarray]) -> np.ndarray:
    """(n, 3, side, side) normalised channels to (n, features)."""
    x = stem(np.moveaxis(x, 1, -1), v, w)
    for i, (side, _, heads, size) in enumerate(v.stages()):
        for j in range(v.depths[i]):
            x = block(x, w, f"layers.{i}.blocks.{j}", heads, size, size // 2 if j % 2 and size < side else 0)
        if i + 1 < len(v.depths):
            at = f"layers.{i}.downsample"
            x = layer_norm(merge_tokens(x), w[f"{at}.norm.weight"], w[f"{at}.norm.bias"]) @ w[f"{at}.reduction.weight"].T
    return pool(layer_norm(x, w["norm.weight"], w["norm.bias"]))


def network(v: Variant, weights: dict[str, np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """(n, 3, side, side) to (n, features), as many images at once as memory is meant for."""
    weights = check(v, weights)
    most = max(1, _PIXELS // v.side**2)
    return lambda x: np.concatenate([forward(x[k : k + most], v, weights) for k in range(0, len(x), most)])


def load(path: str, sha256: str, v: Variant) -> Callable[[np.ndarray], np.ndarray]:
    """A network from an .npz file of arrays by name, verified before it is read. The path must be readable on workers."""
    with open(path, "rb") as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() != sha256:
        raise ValueError("the weights file does not have the expected SHA-256")
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        return network(v, {k: z[k] for k in z.files})
