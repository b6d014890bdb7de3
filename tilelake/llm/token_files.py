"""Operator 5, token ids on disk: bit-plane shuffled blocks.

Documents are dealt out by ranges of doc_id and sorted, so that the files in order of their part number hold ascending
ids. A file is a run of chunks; a chunk is a block of block_ids ids as little-endian uint32, transposed into byte planes
(or bit planes), each plane compressed with zstandard on its own. A table of documents (id, null flag, length), an index
of chunks (place, ids, bytes of each plane) and a trailer follow. A task writes its file under a name of its own and
moves it into place at the end, so a repeated task leaves one whole file. Reading takes one task per file.

Defined results: null text is empty, so the document is its end id alone; null doc_ids come first; rows that repeat a
doc_id are ordered by text and each kept; an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, scratch_path, tidy
from .tokens import encoder

MAGIC = b"TLTOKEN1"
END_ID = 0


# --- planes ------------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, j]).tobytes() for j in range(4)]
    flat = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(flat[:, j], bitorder="little").tobytes() for j in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
        return np.ascontiguousarray(raw).view("<u4").reshape(-1)
    flat = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(flat, axis=1, bitorder="little").view("<u4").reshape(-1)


class TokenFileWriter:
    def __init__(self, out, block_ids: int = 65536, bits: bool = False, level: int = 3):
        self.out, self.block, self.bits = out, block_ids, bits
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.wait, self.waiting, self.chunks, self.at = [], 0, [], len(MAGIC)
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document; ids: its little-endian uint32 ids, end id included."""
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.wait.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.wait), "<u4")
        upto = len(ids) if last else len(ids) // self.block * self.block
        for i in range(0, upto, self.block):
            block = ids[i : min(i + self.block, upto)]
            planes = [self.zstd.compress(p) for p in to_planes(block, self.bits)]
            self.chunks.append([self.at, len(block), [len(p) for p in planes]])
            for p in planes:
                self.out.write(p)
                self.at += len(p)
        rest = ids[upto:].tobytes()
        self.wait, self.waiting = ([rest] if rest else []), len(rest) // 4

    def close(self) -> None:
        self._flush(True)
        nulls = np.array([i is None for i in self.ids], np.uint8)
        docs = np.array([i or 0 for i in self.ids], "<i8").tobytes() + nulls.tobytes() + np.array(self.lengths, "<i8").tobytes()
        packed = self.zstd.compress(docs)
        index = json.dumps({"docs": [self.at, len(packed), len(self.ids)], "chunks": self.chunks}).encode()
        packed_index = self.zstd.compress(index)
        self.out.write(packed + packed_index + struct.pack("<Q", len(packed_index)) + MAGIC)


class TokenFileReader:
    """Random access to a file object: chunks by number, documents in order."""

    def __init__(self, f):
        self.f, self.zstd = f, zstandard.ZstdDecompressor()
        f.seek(0, io.SEEK_END)
        size = f.tell()
        f.seek(size - 16)
        tail = f.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or not a whole one")
        (n,) = struct.unpack("<Q", tail[:8])
        f.seek(size - 16 - n)
        index = json.loads(self.zstd.decompress(f.read(n)))
        self.chunks = index["chunks"]
        at, length, k = index["docs"]
        f.seek(at)
        docs = self.zstd.decompress(f.read(length))
        self.doc_ids = np.frombuffer(docs, "<i8", k)
        self.null = np.frombuffer(docs, np.uint8, k, 8 * k).astype(bool)
        self.lengths = np.frombuffer(docs, "<i8", k, 9 * k)

    def chunk(self, i: int) -> np.ndarray:
        at, n, sizes = self.chunks[i]
        self.f.seek(at)
        data, planes, k = self.f.read(sum(sizes)), [], 0
        for s in sizes:
            planes.append(self.zstd.decompress(data[k : k + s]))
            k += s
        return from_planes(planes, n)

    def documents(self) -> Iterator[bytes]:
        """Little-endian ids of each document; holds a chunk and a document at a time."""
        have, nxt = b"", 0
        for n in self.lengths:
            need, parts = int(n) * 4, [have]
            got = len(have)
            while got < need:
                parts.append(self.chunk(nxt).tobytes())
                got += len(parts[-1])
                nxt += 1
            data = b"".join(parts) if len(parts) > 1 else have
            yield data[:need]
            have = data[need:]


# --- the operator ------------------------------------------------------------------------------------------------------


def _store(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, block_ids: int = 65536, bits: bool = False) -> DataFrame:
    """part, path, n_docs, n_ids of each file."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, writer = encoder(vocabulary), TaskContext.get().partitionId(), None
        fs, root = _store(folder)
        end = struct.pack("<I", END_ID)
        for df in frames:
            if writer is None:
                fs.create_dir(root, recursive=True)
                own = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
                sink = fs.open_output_stream(own)
                out = io.BufferedWriter(_Raw(sink), 1 << 20)
                writer = TokenFileWriter(out, block_ids, bits)
            for doc_id, text in zip(df["doc_id"], df["text"], strict=True):
                writer.add(None if pd.isna(doc_id) else int(doc_id), enc.encode(text) + end)
        if writer is not None:
            writer.close()
            out.flush()
            sink.close()
            path = f"{root}/part-{part:06d}.tok"
            fs.move(own, path)
            yield pd.DataFrame({"part": [part], "path": [f"{folder}/part-{part:06d}.tok"], "n_docs": [len(writer.ids)], "n_ids": [sum(writer.lengths)]})

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(dealt.mapInPandas(run, "part int, path string, n_docs long, n_ids long"), "token-files")


class _Raw(io.RawIOBase):
    """A pyarrow stream as a raw file."""

    def __init__(self, sink):
        self.sink = sink

    def writable(self) -> bool:
        return True

    def write(self, b) -> int:
        self.sink.write(bytes(b))
        return len(b)


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for path, base in zip(df["path"], df["base"], strict=True):
                fs, at = _store(path)
                with fs.open_input_file(at) as f:
                    r = TokenFileReader(f)
                    starts = int(base) + np.concatenate([[0], np.cumsum(r.lengths)[:-1]])
                    crcs = np.fromiter((zlib.crc32(d) for d in r.documents()), np.int64, len(r.lengths))
                    yield pd.DataFrame({"doc_id": pd.Series(r.doc_ids).astype("Int64").mask(r.null), "start": starts, "n_tokens": r.lengths, "ids_crc32": crcs})

    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    placed = files.select("part", "path", F.coalesce(before, F.lit(0)).alias("base"))
    return placed.repartition(max(1, files.count())).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, vocabulary: str, folder: str | None = None, block_ids: int = 65536, bits: bool = False) -> DataFrame:
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, vocabulary, block_ids, bits))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(documents(spark, sf_dir), "byte_bpe_50k.json")
