"""Output as files that other tools read: a Zarr (version 2) group for each slide, and PNG images.

Patches are dealt by slide and chunk of consecutive ordinals; one task writes one chunk file under a temporary name and
renames it, so a task that runs again writes the same file. The path must be one that all executors mount.
"""

from __future__ import annotations

import glob
import json
import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 256
WRITTEN = "slide_id string, files long"


def _put(path: str, data: bytes) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with open(aside, "wb") as f:
        f.write(data)
    os.replace(aside, path)


def _header(shape: list[int], chunks: list[int], dtype: str) -> bytes:
    return json.dumps({"zarr_format": 2, "shape": shape, "chunks": chunks, "dtype": dtype, "order": "C", "fill_value": 0, "filters": None, "compressor": {"id": "zlib", "level": 1}}).encode()


def mounted(path: str) -> str:
    """A path for the file system's own calls."""
    plain = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"{path}: groups are written to mounted folders only")
    return plain.rstrip("/")


def group_path(out: str, slide_id: str) -> str:
    return f"{out}/{os.path.splitext(os.path.basename(slide_id.rstrip('/')))[0]}.zarr"


def write_zarr(patches: DataFrame, grid: DataFrame, out: str, columns: dict[str, tuple[str, list[int], str]], chunk: int = CHUNK, with_grid: bool = True) -> None:
    """A group <out>/<stem>.zarr for each slide of grid (slide_id, row, col, patch_index), replacing what is there.

    columns: array name -> (column of patches, shape of one row, dtype); binary columns hold the bytes of a row, others
    its numbers. patches must hold all kept places of the grid. Arrays are ordered by patch_index.
    """
    out = mounted(out)
    sizes = grid.groupBy("slide_id").agg(F.max("row").alias("rows"), F.max("col").alias("cols"), (F.max("patch_index") + 1).alias("n"))

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                g = group_path(out, r.slide_id)
                shutil.rmtree(g, ignore_errors=True)
                _put(f"{g}/.zgroup", b'{"zarr_format": 2}')
                for name, (_, shape, dtype) in columns.items():
                    _put(f"{g}/{name}/.zarray", _header([int(r.n), *shape], [chunk, *shape], dtype))
                if with_grid:
                    whole = [int(r.rows) + 1, int(r.cols) + 1]
                    _put(f"{g}/patch_index_grid/.zarray", _header(whole, whole, "<i4"))
            yield pd.DataFrame({"slide_id": b["slide_id"], "files": 1 + len(columns) + with_grid})

    def write_chunk(b: pd.DataFrame) -> pd.DataFrame:
        slide, k = b["slide_id"].iloc[0], int(b["patch_index"].iloc[0]) // chunk
        at = b["patch_index"].to_numpy() % chunk
        for name, (column, shape, dtype) in columns.items():
            a = np.zeros((chunk, *shape), dtype)
            for i, v in zip(at, b[column], strict=True):
                a[i] = (np.frombuffer(v, dtype) if isinstance(v, bytes | bytearray) else np.asarray(v, dtype)).reshape(shape)
            _put(f"{group_path(out, slide)}/{name}/{'.'.join([str(k)] + ['0'] * len(shape))}", zlib.compress(a.tobytes(), 1))
        return pd.DataFrame({"slide_id": [slide], "files": [len(columns)]})

    def write_grid(b: pd.DataFrame) -> pd.DataFrame:
        a = np.full((int(b["row"].max()) + 1, int(b["col"].max()) + 1), -1, "<i4")
        a[b["row"], b["col"]] = b["patch_index"]
        slide = b["slide_id"].iloc[0]
        _put(f"{group_path(out, slide)}/patch_index_grid/0.0", zlib.compress(a.tobytes(), 1))
        return pd.DataFrame({"slide_id": [slide], "files": [1]})

    def go(df: DataFrame) -> None:
        df.agg(F.sum("files")).collect()  # one number

    go(sizes.mapInPandas(begin, WRITTEN))
    if with_grid:
        go(grid.select("slide_id", "row", "col", "patch_index").groupBy("slide_id").applyInPandas(write_grid, WRITTEN))
    if columns:
        wanted = sorted({c for c, _, _ in columns.values()})
        kept = patches.select("slide_id", "row", "col", *wanted).join(grid.where("patch_index >= 0").select("slide_id", "row", "col", "patch_index"), ["slide_id", "row", "col"])
        go(kept.groupBy("slide_id", F.floor(F.col("patch_index") / chunk)).applyInPandas(write_chunk, WRITTEN))


def read_zarr(spark: SparkSession, out: str, name: str) -> DataFrame:
    """stem, idx, data: each row of an array of all groups under out, as its bytes. One task reads one chunk at a time."""
    out = mounted(out)
    files = [(os.path.basename(os.path.dirname(os.path.dirname(p)))[:-5], os.path.dirname(p), os.path.basename(p)) for p in sorted(glob.glob(f"{out}/*.zarr/{name}/[0-9]*"))]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                head = json.loads(open(f"{r.folder}/.zarray", "rb").read())
                k = int(r.file.split(".")[0])
                if head["compressor"] != {"id": "zlib", "level": 1} or r.file != ".".join([str(k)] + ["0"] * (len(head["shape"]) - 1)):
                    raise ValueError(f"{r.folder}/{r.file}: not a chunk of whole rows in zlib")
                a = np.frombuffer(zlib.decompress(open(f"{r.folder}/{r.file}", "rb").read()), head["dtype"]).reshape(head["chunks"])
                n = min(len(a), head["shape"][0] - k * len(a))
                yield pd.DataFrame({"stem": r.stem, "idx": k * len(a) + np.arange(n), "data": [row.tobytes() for row in a[:n]]})

    names = spark.createDataFrame(files, "stem string, folder string, file string")
    return names.repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))).mapInPandas(read, "stem string, idx long, data binary")


def png_bytes(pixels: np.ndarray) -> bytes:
    """An (h, w, 3) image in 8 bits as a PNG file."""
    h, w, _ = pixels.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(pixels, np.uint8).reshape(h, -1)], 1)
    parts = ((b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)), (b"IDAT", zlib.compress(rows.tobytes())), (b"IEND", b""))
    return b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d)) for t, d in parts)


def to_png(rgb: str, height: str, width: str) -> Column:
    """The packed pixels of a row as a PNG file; null for null or wrong sizes."""

    @F.pandas_udf("binary")
    def encode(s: pd.Series, hs: pd.Series, ws: pd.Series) -> pd.Series:
        fits = lambda v, h, w: v is not None and pd.notna(h) and pd.notna(w) and min(h, w) > 0 and len(v) == h * w * 3
        return pd.Series([png_bytes(np.frombuffer(v, np.uint8).reshape(int(h), int(w), 3)) if fits(v, h, w) else None for v, h, w in zip(s, hs, ws, strict=True)], dtype=object)

    return encode(F.col(rgb), F.col(height), F.col(width))
