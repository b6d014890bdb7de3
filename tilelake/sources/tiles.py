"""Tiles of slides as a Spark data source.

One input partition is a run of tiles of one level of one slide, so scans scale with tiles, not with slides: at most
PER_PARTITION tiles, and fewer where there would be fewer runs than the option tasks asks for. level,
tile_y and tile_x can be pushed down: partitions outside a pushed level are never planned. A tile that can't be read is
a row with null data and the reason in error; a slide that can't be opened is one such row. The source is read-only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from tilelake.sources.readers import open_slide

SCHEMA = "slide_id string, level int, tile_y int, tile_x int, height int, width int, data binary, is_padded boolean, error string"
PER_PARTITION = 16


@dataclass
class TileRange(InputPartition):
    """Everything a task needs; tiles first to last (exclusive) of a level, in row-major order."""

    path: str
    level: int
    first: int
    last: int
    columns: int
    tile: int
    backend: str
    error: str = ""

    def __init__(self, path: str, level: int, first: int, last: int, columns: int, tile: int, backend: str, error: str = ""):
        super().__init__(None)
        self.path, self.level, self.first, self.last, self.columns, self.tile, self.backend, self.error = path, level, first, last, columns, tile, backend, error


class TileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"])
        self.tiles = json.loads(options["tiles"])  # side per slide
        self.levels = json.loads(options["levels"])  # level per slide, null for all
        self.backend = options.get("backend", "auto")
        self.tasks = int(options.get("tasks", "1"))
        self.only: int | None = None

    def pushFilters(self, filters):  # noqa: N802, ANN001, ANN201
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("level",):
                self.only = f.value
            yield f  # still checked above the scan

    def partitions(self) -> list[TileRange]:
        out, found = [], []
        for path, tile, level in zip(self.paths, self.tiles, self.levels, strict=True):
            try:
                with open_slide(path, self.backend) as s:
                    sizes = s.level_dimensions
            except Exception as e:  # noqa: BLE001  any reason a slide can't be opened becomes a row
                out.append(TileRange(path, level if level is not None else -1, 0, 1, 1, tile, self.backend, f"{type(e).__name__}: {e}"[:300]))
                continue
            for i, (w, h) in enumerate(sizes):
                if (level is not None and i != level) or (self.only is not None and i != self.only):
                    continue
                found.append((path, i, math.ceil(w / tile), math.ceil(w / tile) * math.ceil(h / tile), tile))
        step = max(1, min(PER_PARTITION, sum(total for *_, total, _ in found) // self.tasks))
        for path, i, columns, total, tile in found:
            out += [TileRange(path, i, k, min(k + step, total), columns, tile, self.backend) for k in range(0, total, step)]
        return out or [TileRange("", -1, 0, 0, 1, 1, self.backend)]

    def read(self, p: TileRange) -> Iterator[tuple]:
        if p.error:
            yield (p.path, p.level, None, None, None, None, None, None, p.error)
            return
        if p.first == p.last:
            return
        with open_slide(p.path, p.backend) as s:
            ds, (w, h) = s.level_downsamples[p.level], s.level_dimensions[p.level]
            for k in range(p.first, p.last):
                y, x = divmod(k, p.columns)
                try:
                    data, error = s.read_region((int(x * ds * p.tile), int(y * ds * p.tile)), p.level, (p.tile, p.tile)).tobytes(), None
                except Exception as e:  # noqa: BLE001
                    data, error = None, f"{type(e).__name__}: {e}"[:300]
                yield (p.path, p.level, y, x, p.tile, p.tile, data, (x + 1) * p.tile > w or (y + 1) * p.tile > h, error)


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tilelake_tiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TileReader:  # noqa: ANN001
        return TileReader(self.options)


def read_tiles(spark: SparkSession, paths: list[str], tile: int | list[int], level: int | None | list[int | None] = None, backend: str = "auto") -> DataFrame:
    """Tiles of slides at their levels; tile and level may be given per slide."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TileSource)
    tiles = tile if isinstance(tile, list) else [tile] * len(paths)
    levels = level if isinstance(level, list) else [level] * len(paths)
    return spark.read.format("tilelake_tiles").options(paths=json.dumps(paths), tiles=json.dumps(tiles), levels=json.dumps(levels), backend=backend, tasks=str(spark.sparkContext.defaultParallelism)).load()
