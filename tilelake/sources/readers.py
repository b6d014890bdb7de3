"""Slide readers: a small protocol, a registry of backends, and readers that need nothing but NumPy.

A reader gives the pyramid (sizes, downsamples), the properties and regions as (h, w, 3) bytes. Backends: 'synthetic'
(deterministic images by URL), 'ppm' (binary PPM; coarser levels by averaging), 'npy' (a folder level_0.npy, level_1.npy,
... with properties.json), and 'openslide' where that library can be imported. 'auto' goes by name.
"""

from __future__ import annotations

import json
import os
from abc import ABC, abstractmethod
from collections.abc import Callable
from urllib.parse import parse_qs, urlparse

import numpy as np


class SlideReader(ABC):
    level_dimensions: list[tuple[int, int]]
    level_downsamples: list[float]
    properties: dict[str, str]

    @abstractmethod
    def _region(self, x: int, y: int, level: int, w: int, h: int) -> np.ndarray: ...

    @property
    def level_count(self) -> int:
        return len(self.level_dimensions)

    def read_region(self, loc: tuple[int, int], level: int, size: tuple[int, int]) -> np.ndarray:
        """loc: level-0 position (x, y); size: (w, h) at the level. Beyond the edge the image is black."""
        if min(size) < 0:
            raise ValueError("sizes can't be negative")
        if not 0 <= level < self.level_count:
            raise ValueError(f"there is no level {level}")
        ds = self.level_downsamples[level]
        return self._region(int(loc[0] / ds), int(loc[1] / ds), level, *size)

    def best_level_for_downsample(self, target: float) -> int:
        return min(range(self.level_count), key=lambda i: abs(self.level_downsamples[i] - target))

    def close(self) -> None:
        pass

    def __enter__(self) -> SlideReader:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def _crop(image: np.ndarray, x: int, y: int, w: int, h: int) -> np.ndarray:
    out = np.zeros((h, w, 3), np.uint8)
    part = image[max(y, 0) : max(y + h, 0), max(x, 0) : max(x + w, 0)]
    out[max(-y, 0) : max(-y, 0) + part.shape[0], max(-x, 0) : max(-x, 0) + part.shape[1]] = part
    return out


class ArrayReader(SlideReader):
    def __init__(self, levels: list[np.ndarray], properties: dict[str, str] | None = None):
        self.levels, self.properties = levels, properties or {}
        self.level_dimensions = [(a.shape[1], a.shape[0]) for a in levels]
        self.level_downsamples = [levels[0].shape[1] / a.shape[1] for a in levels]

    def _region(self, x: int, y: int, level: int, w: int, h: int) -> np.ndarray:
        return _crop(self.levels[level], x, y, w, h)


def halve(a: np.ndarray) -> np.ndarray:
    a = a[: a.shape[0] // 2 * 2, : a.shape[1] // 2 * 2].astype(np.uint16)
    return ((a[::2, ::2] + a[1::2, ::2] + a[::2, 1::2] + a[1::2, 1::2] + 2) // 4).astype(np.uint8)


def pyramid(image: np.ndarray, levels: int) -> list[np.ndarray]:
    out = [image]
    while len(out) < levels and min(out[-1].shape[:2]) >= 2:
        out.append(halve(out[-1]))
    return out


class SyntheticReader(SlideReader):
    """synthetic://<w>x<h>?levels=2&seed=0&mpp=0.5: computed per region, so slides of any size cost nothing to open."""

    def __init__(self, url: str):
        u = urlparse(url)
        w, h = map(int, u.netloc.split("x"))
        q = {k: v[0] for k, v in parse_qs(u.query).items()}
        n = int(q.get("levels", 1))
        self.seed = int(q.get("seed", 0))
        self.level_dimensions = [(max(1, w >> i), max(1, h >> i)) for i in range(n)]
        self.level_downsamples = [float(1 << i) for i in range(n)]
        self.properties = {"openslide.mpp-x": q["mpp"]} if "mpp" in q else {}

    def _region(self, x: int, y: int, level: int, w: int, h: int) -> np.ndarray:
        full_w, full_h = self.level_dimensions[level]
        xs, ys = np.arange(x, x + w), np.arange(y, y + h)
        gx, gy = np.meshgrid(xs << level, ys << level)
        spot = ((gx // 16 + gy // 16 * 7 + self.seed) % 5 == 0) * 60
        out = np.stack([(gx * 3 + gy + self.seed * 17) % 180 + spot, (gx + gy * 2 + self.seed * 5) % 150 + spot, (gx + gy) % 200 + spot // 2], axis=2).astype(np.uint8)
        out[(ys < 0) | (ys >= full_h)] = 0
        out[:, (xs < 0) | (xs >= full_w)] = 0
        return out


def read_ppm(data: bytes) -> np.ndarray:
    """A binary PPM (P6, 8 bits) as (h, w, 3)."""
    fields, at = [], 0
    while len(fields) < 4:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while not data[end : end + 1].isspace():
            end += 1
        fields.append(data[at:end])
        at = end
    if fields[0] != b"P6" or fields[3] != b"255":
        raise ValueError("not an 8-bit binary PPM")
    w, h = int(fields[1]), int(fields[2])
    return np.frombuffer(data, np.uint8, w * h * 3, at + 1).reshape(h, w, 3)


def _ppm(path: str) -> SlideReader:
    with open(path, "rb") as f:
        return ArrayReader(pyramid(read_ppm(f.read()), 3))


def _npy(path: str) -> SlideReader:
    names = sorted((n for n in os.listdir(path) if n.startswith("level_")), key=lambda n: int(n[6:-4]))
    meta = os.path.join(path, "properties.json")
    props = json.load(open(meta)) if os.path.exists(meta) else {}
    return ArrayReader([np.load(os.path.join(path, n), mmap_mode="r") for n in names], props)


def _openslide(path: str) -> SlideReader:
    import openslide

    class Reader(SlideReader):
        def __init__(self) -> None:
            self.s = openslide.OpenSlide(path)
            self.level_dimensions, self.level_downsamples = list(self.s.level_dimensions), list(self.s.level_downsamples)
            self.properties = dict(self.s.properties)

        def read_region(self, loc: tuple[int, int], level: int, size: tuple[int, int]) -> np.ndarray:
            if min(size) < 0:
                raise ValueError("sizes can't be negative")
            return np.asarray(self.s.read_region(loc, level, size))[..., :3]

        def _region(self, x: int, y: int, level: int, w: int, h: int) -> np.ndarray:
            raise NotImplementedError

        def close(self) -> None:
            self.s.close()

    return Reader()


def _cucim(path: str) -> SlideReader:
    """Pixels by cuCIM, resolution and properties by OpenSlide of the same file."""
    from cucim import CuImage

    class Reader(SlideReader):
        def __init__(self) -> None:
            self.image = CuImage(path)
            levels = self.image.resolutions
            self.level_dimensions, self.level_downsamples = [tuple(d) for d in levels["level_dimensions"]], list(levels["level_downsamples"])
            with _openslide(path) as other:
                self.properties = other.properties

        def read_region(self, loc: tuple[int, int], level: int, size: tuple[int, int]) -> np.ndarray:
            if min(size) < 0:
                raise ValueError("sizes can't be negative")
            return np.asarray(self.image.read_region(location=loc, size=size, level=level))[..., :3]

        def _region(self, x: int, y: int, level: int, w: int, h: int) -> np.ndarray:
            raise NotImplementedError

        def close(self) -> None:
            self.image.close()

    return Reader()


BACKENDS: dict[str, Callable[[str], SlideReader]] = {"synthetic": SyntheticReader, "ppm": _ppm, "npy": _npy, "openslide": _openslide, "cucim": _cucim}


def open_slide(path: str, backend: str = "auto") -> SlideReader:
    if backend == "auto":
        name = path.rstrip("/").lower()
        backend = "synthetic" if name.startswith("synthetic://") else "ppm" if name.endswith((".ppm", ".pnm")) else "npy" if os.path.isdir(path) else "openslide"
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend!r}; there are {sorted(BACKENDS)}")
    return BACKENDS[backend](path)
