"""Patch embeddings: a registry of embedders and one Arrow UDF that loads a model once per worker.

'histogram' is a deterministic NumPy embedder (768 numbers from pooled, normalised channels and colour counts). A torch
module is used when torch can be imported, the NumPy transformer of swin.py anywhere; both need a weights file with the
expected SHA-256. Without one the name is refused, never silently replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.functions.color import IMAGENET_MEAN, IMAGENET_STD
from tilelake.operators import swin

WIDTH = 768


class Embedder(Protocol):
    def __call__(self, batch: np.ndarray) -> np.ndarray: ...


def normalise(batch: np.ndarray) -> np.ndarray:
    """(n, h, w, 3) levels to (n, 3, h, w) floats, over 255, less mean, by deviation."""
    x = (batch.astype(np.float32) / 255.0 - np.array(IMAGENET_MEAN, np.float32)) / np.array(IMAGENET_STD, np.float32)
    return np.moveaxis(x, -1, 1)


def _histogram() -> Embedder:
    def embed(batch: np.ndarray) -> np.ndarray:
        n, h, w, _ = batch.shape
        ys, xs = (np.linspace(0, s, 9).astype(int) for s in (h, w))
        # whole sums of 8 x 8 cells; a cell without rows or columns of its own takes the next one, as reduceat does
        sums = np.add.reduceat(np.add.reduceat(batch, ys[:-1], axis=1, dtype=np.int64), xs[:-1], axis=2)
        tall, wide = (np.maximum(np.diff(s), 1) for s in (ys, xs))
        pooled = np.moveaxis(normalise(sums / (tall[:, None] * wide)[:, :, None]), 1, -1)
        counts = np.zeros((n, WIDTH - 192), np.float32)
        for i, flat in enumerate(batch.reshape(n, -1, 3)):  # a patch at a time, to bound the copies
            code = (flat[:, 0] >> 5) * np.int16(72) + (flat[:, 1] >> 5) * np.int16(9) + flat[:, 2] // 29
            counts[i] = np.bincount(np.minimum(code, WIDTH - 193), minlength=WIDTH - 192)[: WIDTH - 192] / len(flat)
        return np.concatenate([pooled.reshape(n, -1), counts], axis=1).astype(np.float32)

    return embed


def sha256_of(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(65536):
            h.update(block)
    return h.hexdigest()


def torch_embedder(path: str, sha256: str) -> Callable[[], Embedder]:
    """A loader for a TorchScript module of (n, 3, h, w) to (n, 768); the file is verified before it is opened."""

    def load() -> Embedder:
        import torch

        if sha256_of(path) != sha256:
            raise ValueError("the weights file does not have the expected SHA-256")
        model = torch.jit.load(path).eval()

        def embed(batch: np.ndarray) -> np.ndarray:
            with torch.no_grad():
                return model(torch.from_numpy(normalise(batch))).cpu().numpy()

        return embed

    return load


def swin_embedder(path: str, sha256: str, variant: swin.Variant = swin.VARIANTS["tiny"]) -> Callable[[], Embedder]:
    """A loader for the transformer with the weights of an .npz file; the file is verified before it is read."""

    def load_network() -> Embedder:
        net = swin.load(path, sha256, variant)
        return lambda batch: net(normalise(batch))

    return load_network


EMBEDDERS: dict[str, Callable[[], Embedder]] = {"histogram": _histogram}
_LOADED: dict[str, Embedder] = {}


def register_embedder(name: str, load: Callable[[], Embedder]) -> None:
    EMBEDDERS[name] = load


def extract_features(patches: DataFrame, model: str = "histogram", patch: int = 224, batch_size: int = 256, rgb: str = "rgb") -> DataFrame:
    """patches with embedding ARRAY<FLOAT>, of 768 numbers but for other networks; null patches have null embeddings."""
    if model not in EMBEDDERS:
        raise ValueError(f"unknown model {model!r}; registered: {sorted(EMBEDDERS)}")
    load = EMBEDDERS[model]

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if model not in _LOADED:
            _LOADED[model] = load()
        net = _LOADED[model]
        for s in batches:
            out: list = [None] * len(s)
            have = [i for i, b in enumerate(s) if b is not None]
            for k in range(0, len(have), batch_size):
                part = have[k : k + batch_size]
                x = np.stack([np.frombuffer(s.iloc[i], np.uint8).reshape(patch, patch, 3) for i in part])
                for i, v in zip(part, net(x), strict=True):
                    out[i] = v
            yield pd.Series(out, dtype=object)

    return patches.withColumn("embedding", embed(F.col(rgb)))
