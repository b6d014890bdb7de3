"""Operator 8, media columns: TIFF files to pages.

decode_pages walks the image file directories of a classic TIFF (either byte order), decodes strips or tiles stored raw,
with PackBits, LZW or deflate, undoes the horizontal predictor and gives one entry per page; tiff_pages explodes these to
one row per page. encode_tiff writes such files. The query stores each document's bytes as 8-bit samples, one page for
every PAGE_ROWS rows of 64 samples, reads the pages back and derives its digests from them.

Defined results: null text is empty, its payload is 64 zero bytes; equal texts give equal files; repeated rows are
reported each; an empty table gives an empty result; a file that can't be decoded, whatever is wrong with it, gives one
row with page null and the reason in error; sizes that a file's strips can't fill are refused before anything is
allocated, and decoders stop at the size that is expected; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, tidy

# Fixed values of the format.
NONE, LZW, DEFLATE_ADOBE, PACKBITS, DEFLATE = 1, 5, 8, 32773, 32946
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, FILL_ORDER, PLANAR = 317, 322, 323, 324, 325, 266, 284
_TYPES = {1: ("B", 1), 2: ("c", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4)}
NAMES = {NONE: "raw", LZW: "lzw", DEFLATE_ADOBE: "deflate", PACKBITS: "packbits", DEFLATE: "deflate"}

#: The most bytes that one byte of a strip can decode to; an LZW code of 12 bits stands for 4096 bytes at most.
EXPANSION = {NONE: 1, PACKBITS: 64, LZW: 2731, DEFLATE: 1032, DEFLATE_ADOBE: 1032}

PAGE_ROWS = 16384  # rows of a page: 1 MB of samples


# --- codecs ------------------------------------------------------------------------------------------------------------


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < size:
        c = data[i]
        i += 1
        if c < 128:
            out += data[i : i + c + 1]
            i += c + 1
        elif c > 128:
            out += data[i : i + 1] * (257 - c)
            i += 1
    return bytes(out)


def packbits_encode(data: bytes) -> bytes:
    if not data:
        return b""
    a = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(a)) + 1
    starts = np.concatenate([[0], edges])
    lengths = np.diff(np.concatenate([starts, [len(a)]]))
    out, literal_from = bytearray(), 0

    def literals(upto: int) -> None:
        for i in range(literal_from, upto, 128):
            part = data[i : min(i + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    for k in np.flatnonzero(lengths >= 3):
        s, n = int(starts[k]), int(lengths[k])
        literals(s)
        while n > 0:
            run = min(n, 128)
            if run == 1:
                out += bytes((0, data[s]))
            else:
                out += bytes((257 - run, data[s]))
            n -= run
        literal_from = s + int(lengths[k])
    literals(len(data))
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first, code width growing one code early, as TIFF has it."""
    acc = n_bits = 0
    out = bytearray()
    table: dict[bytes, int] = {}
    width, nxt = 9, 258

    def put(code: int) -> None:
        nonlocal acc, n_bits
        acc = (acc << width) | code
        n_bits += width
        while n_bits >= 8:
            n_bits -= 8
            out.append((acc >> n_bits) & 255)
        acc &= (1 << n_bits) - 1

    put(256)
    w = b""
    for i in range(len(data)):
        wc = w + data[i : i + 1]
        if len(wc) == 1 or wc in table:
            w = wc
            continue
        put(w[0] if len(w) == 1 else table[w])
        table[wc] = nxt
        nxt += 1
        if nxt == 4094:
            put(256)
            table, width, nxt = {}, 9, 258
        elif nxt in (512, 1024, 2048):
            width += 1
        w = wc[-1:]
    if w:
        put(w[0] if len(w) == 1 else table[w])
        nxt += 1
        if nxt == 4094:
            put(256)
            width = 9
        elif nxt in (512, 1024, 2048):
            width += 1
    put(257)
    if n_bits:
        out.append((acc << (8 - n_bits)) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    base = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, width, old = list(base), 9, None
    acc = n_bits = i = 0
    out: list[bytes] = []
    total = 0
    while total < size:
        while n_bits < width:
            if i >= len(data):
                return b"".join(out)
            acc = ((acc & ((1 << n_bits) - 1)) << 8) | data[i]
            n_bits += 8
            i += 1
        n_bits -= width
        code = (acc >> n_bits) & ((1 << width) - 1)
        if code == 256:
            table, width, old = list(base), 9, None
            continue
        if code == 257:
            break
        if old is None:
            entry = table[code]
        else:
            if code > len(table):
                raise ValueError("bad LZW code")
            entry = table[code] if code < len(table) else old + old[:1]
            table.append(old + entry[:1])
            if len(table) in (511, 1023, 2047):
                width += 1
        out.append(entry)
        total += len(entry)
        old = entry
    return b"".join(out)


def _decode(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return packbits_decode(data, size)
    if compression == LZW:
        return lzw_decode(data, size)
    if compression in (DEFLATE, DEFLATE_ADOBE):
        return zlib.decompressobj().decompress(data, max(1, size))
    raise ValueError(f"compression {compression} is not supported")


def _encode(data: bytes, compression: int) -> bytes:
    return {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE_ADOBE: lambda d: zlib.compress(d, 1)}[compression](data)


# --- files -------------------------------------------------------------------------------------------------------------


def encode_tiff(pages: list[np.ndarray], compression: int = DEFLATE_ADOBE, predictor: int = 1, tile: int = 0, strip_rows: int = 4096, order: str = "<") -> bytes:
    """A classic TIFF of 8-bit pages (rows, columns[, samples])."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4  # where the offset of the next directory goes
    for page in pages:
        a = page if page.ndim == 3 else page[:, :, None]
        h, w, c = a.shape
        if tile:
            blocks = [np.pad(b, ((0, tile - b.shape[0]), (0, tile - b.shape[1]), (0, 0))) for y in range(0, h, tile) for x in range(0, w, tile) for b in [a[y : y + tile, x : x + tile]]]
        else:
            blocks = [a[y : y + strip_rows] for y in range(0, h, strip_rows)]
        offsets, counts = [], []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], np.diff(b, axis=1)], axis=1)
            data = _encode(np.ascontiguousarray(b).tobytes(), compression)
            offsets.append(len(out))
            counts.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        tags = [(WIDTH, 4, [w]), (LENGTH, 4, [h]), (BITS, 3, [8] * c), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [2 if c == 3 else 1]), (SAMPLES, 3, [c]), (PREDICTOR, 3, [predictor])]
        if tile:
            tags += [(TILE_WIDTH, 4, [tile]), (TILE_LENGTH, 4, [tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        else:
            tags += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [strip_rows]), (STRIP_COUNTS, 4, counts)]
        entries = bytearray()
        for tag, kind, values in sorted(tags):
            code, size = _TYPES[kind]
            data = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(data) <= 4:
                data = data.ljust(4, b"\0")
            else:
                at = len(out)
                out += data + b"\0" * (len(data) % 2)
                data = struct.pack(order + "I", at)
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + data
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directories(data: bytes) -> Iterator[tuple[str, dict[int, list[int]]]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen:  # so there are fewer pages than bytes
            raise ValueError("directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        tags: dict[int, list[int]] = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind not in _TYPES or kind == 2:
                continue
            code, size = _TYPES[kind]
            where = at + 10 + 12 * i
            if size * count > 4:
                (where,) = struct.unpack_from(order + "I", data, where)
            tags[tag] = list(struct.unpack_from(f"{order}{count}{code}", data, where))
        yield order, tags
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def decode_pages(data: bytes) -> Iterator[dict]:
    """page, width, height, samples, compression, predictor, pixels of every directory, in order."""
    for page, (_, tags) in enumerate(_directories(data)):
        one = lambda tag, default=None, tags=tags: tags.get(tag, [default])[0]
        w, h, c, comp, pred = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, NONE), one(PREDICTOR, 1)
        if any(b != 8 for b in tags.get(BITS, [8])):
            raise ValueError("only 8-bit samples are supported")
        if pred not in (1, 2):
            raise ValueError(f"predictor {pred} is not supported")
        if one(FILL_ORDER, 1) != 1 or (one(PLANAR, 1) != 1 and c != 1):
            raise ValueError("reversed bits and separate planes are not supported")
        tiled = TILE_OFFSETS in tags
        tw, th = (one(TILE_WIDTH), one(TILE_LENGTH)) if tiled else (w, min(one(ROWS_PER_STRIP, h), h))
        if min(w, h, c, tw, th) <= 0:
            raise ValueError("a size is not positive")
        parts = list(zip(tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_COUNTS if tiled else STRIP_COUNTS], strict=True))
        across = -(-w // tw)
        if len(parts) != across * -(-h // th):
            raise ValueError("strips or tiles do not cover the page")
        if any(at < 0 or n < 0 or at + n > len(data) for at, n in parts):
            raise ValueError("a strip or tile lies outside the file")
        sizes = [(th if tiled else min(th, h - k * th)) * tw * c for k in range(len(parts))]
        if any(size > EXPANSION.get(comp, 1) * n + 64 for size, (_, n) in zip(sizes, parts, strict=True)):
            raise ValueError("a strip or tile is too short for its size")
        pixels = np.zeros((h, w, c), np.uint8)
        for k, (at, n) in enumerate(parts):
            y, x = k // across * th, k % across * tw
            rows = th if tiled else min(th, h - y)
            block = np.frombuffer(_decode(data[at : at + n], comp, rows * tw * c), np.uint8)[: rows * tw * c].reshape(rows, tw, c)
            if pred == 2:
                block = np.cumsum(block, axis=1, dtype=np.uint8)
            pixels[y : y + rows, x : x + tw] = block[: h - y, : w - x]
        yield {"page": page, "width": w, "height": h, "samples": c, "compression": NAMES.get(comp, str(comp)), "predictor": pred, "pixels": pixels.tobytes()}


# --- columns -----------------------------------------------------------------------------------------------------------

_PAGE = "struct<page:int,width:int,height:int,samples:int,compression:string,predictor:int,pixels:binary,error:string>"


def _page_arrays(media: pd.Series) -> pd.Series:
    def of(data: bytes | None) -> list[dict]:
        try:
            return [{**p, "error": None} for p in decode_pages(data or b"")]
        except (ValueError, ArithmeticError, LookupError, TypeError, MemoryError, struct.error, zlib.error) as e:
            return [{"page": None, "width": None, "height": None, "samples": None, "compression": None, "predictor": None, "pixels": None, "error": str(e)[:200]}]

    return media.map(of)


def page_arrays(media: str):
    return F.pandas_udf(_page_arrays, f"array<{_PAGE}>")(F.col(media))


def tiff_pages(df: DataFrame, media: str) -> DataFrame:
    """df without the media column, with one row per page: page, width, height, samples, compression, predictor, pixels, error."""
    rest = [c for c in df.columns if c != media]
    return df.select(*rest, F.explode(page_arrays(media)).alias("p")).select(*rest, "p.*")


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))


def store_text(text: str | None) -> tuple[int, bytes]:
    """A document's bytes as a TIFF of rows of 64 samples. Codec and predictor follow from the bytes: short payloads use
    PackBits or LZW in turn, longer ones deflate; the last payload byte before padding decides the predictor."""
    n, payload = payload_of(text)
    a = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    crc = zlib.crc32(payload)
    comp = DEFLATE_ADOBE if len(payload) > 512 else (PACKBITS, LZW)[crc & 1]
    return n, encode_tiff([a[i : i + PAGE_ROWS] for i in range(0, len(a), PAGE_ROWS)], comp, predictor=1 + (crc >> 1 & 1))


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: one TIFF per document."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for i in range(0, len(df), 256):
                part = df.iloc[i : i + 256]
                made = [store_text(t) for t in part["text"]]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "n_bytes": [n for n, _ in made], "media": [m for _, m in made]})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, n_bytes long, media binary")


def text_media(docs: DataFrame) -> DataFrame:
    """Stores every text as a TIFF, reads its pages back and returns digests of what was read."""
    stored = store_texts(docs).select("*", page_arrays("media").alias("pages"))
    payload = F.expr("aggregate(transform(pages, p -> p.pixels), cast('' as binary), (a, b) -> concat(a, b))")
    out = stored.select("doc_id", "n_bytes", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), payload.alias("payload"), "pages")
    first = F.col("pages")[0]
    feature = F.concat_ws(
        ";", F.concat(F.lit("pages="), F.size("pages")), F.concat(F.lit("size="), first["width"], F.lit("x"), F.aggregate(F.transform("pages", lambda p: p["height"]), F.lit(0), lambda a, b: a + b)),
        F.concat(F.lit("codec="), first["compression"]), F.concat(F.lit("predictor="), first["predictor"]), F.concat(F.lit("crc="), F.crc32("payload")),
    )
    return out.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, length(payload) - 63, 64)")).cast("long").alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"),
    )


def op8_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(documents(spark, sf_dir))
