import hashlib
import itertools
import struct
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilelake.llm import media
from tilelake.llm.media import (
    DEFLATE_ADOBE, LZW, NONE, PACKBITS, decode_pages, encode_tiff, lzw_decode, lzw_encode, packbits_decode, packbits_encode, payload_of, text_media, tiff_pages,
)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.binary(max_size=400), st.lists(st.tuples(st.integers(0, 3), st.integers(1, 300)), max_size=12).map(lambda x: b"".join(bytes([b]) * n for b, n in x))))
def test_codecs(data):
    assert packbits_decode(packbits_encode(data), len(data)) == data
    assert lzw_decode(lzw_encode(data), len(data)) == data


def test_lzw_over_table_resets():
    data = np.random.default_rng(0).integers(0, 200, 60000).astype(np.uint8).tobytes()
    assert lzw_decode(lzw_encode(data), len(data)) == data
    for n in range(3700, 4000):
        assert lzw_decode(lzw_encode(data[:n]), n) == data[:n]


def test_known_bytes():
    assert packbits_decode(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA"), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    assert lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == bytes.fromhex("8001E0408044080C06808" + "0")


@pytest.mark.parametrize("comp,pred,tile,order", list(itertools.product([NONE, PACKBITS, LZW, DEFLATE_ADOBE], [1, 2], [0, 32], "<>")))
def test_files(comp, pred, tile, order):
    rng = np.random.default_rng(2)
    pages = [rng.integers(0, 9, (50, 70, 3)).astype(np.uint8), rng.integers(0, 255, (33, 17)).astype(np.uint8)]
    got = list(decode_pages(encode_tiff(pages, comp, pred, tile, 16, order)))
    assert [(p["height"], p["width"], p["samples"]) for p in got] == [(50, 70, 3), (33, 17, 1)]
    assert [p["pixels"] for p in got] == [p.tobytes() for p in pages]


def test_texts(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(100 + i, "word " * i) for i in (13, 100, 300000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = text_media(docs).collect()
    want = []
    for d, t in rows:
        n, p = payload_of(t)
        want.append((d, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got))) == sorted(map(repr, want))
    assert {r.feature.split(";")[0] for r in got} >= {"pages=1", "pages=2"}
    assert text_media(odd_docs.limit(0)).count() == 0


def test_bad_files_give_an_error_row(spark):
    good = encode_tiff([np.zeros((3, 4), np.uint8)] * 2)
    df = spark.createDataFrame([(1, good), (2, b"II"), (3, None), (4, good[:-9])], "id int, media binary")
    got = tiff_pages(df, "media").collect()
    assert sorted((r.id, r.page) for r in got if r.error is None) == [(1, 0), (1, 1)]
    assert {r.id for r in got if r.error} == {2, 3, 4}


def test_bad_files_become_error_rows(spark):
    """Every tag of a file set to every odd value, and random bytes changed: an entry with a reason or pages, never a crash or a huge array."""
    rng = np.random.default_rng(5)
    whole = media.encode_tiff([rng.integers(0, 255, (40, 33, 3), np.uint8)], media.DEFLATE_ADOBE, 2, tile=16)
    files = [b"", b"II", whole[:50], whole]
    (at,) = struct.unpack_from("<I", whole, 4)
    (n,) = struct.unpack_from("<H", whole, at)
    for i in range(n):
        for value in (0, 1, 3, 70_000, 2**31, 2**32 - 1):
            b = bytearray(whole)
            struct.pack_into("<I", b, at + 10 + 12 * i, value)
            files.append(bytes(b))
            b = bytearray(whole)
            struct.pack_into("<I", b, at + 6 + 12 * i, min(value, 100_000))
            files.append(bytes(b))
    for _ in range(300):
        b = bytearray(whole)
        for k in rng.integers(0, len(b), 3):
            b[k] = rng.integers(0, 256)
        files.append(bytes(b))
    tracemalloc.start()
    got = media._page_arrays(pd.Series(files))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50_000_000 and all((p["error"] is None) == (p["pixels"] is not None) for x in got for p in x)
    assert got[3][0]["error"] is None and all(x[0]["error"] for x in got[:3])
    rows = media.tiff_pages(spark.createDataFrame([(i, f) for i, f in enumerate(files[:60])], "id int, media binary"), "media")
    assert rows.select("id").distinct().count() == 60


def test_planes_are_refused_and_many_pages_are_read():
    pages = [np.full((1, 64), i % 251, np.uint8) for i in range(66_000)]
    assert sum(1 for _ in media.decode_pages(media.encode_tiff(pages, media.NONE))) == 66_000
