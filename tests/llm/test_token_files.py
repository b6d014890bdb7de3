import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tilelake.llm.token_files import TokenFileReader, TokenFileWriter, from_planes, to_planes, token_store


@pytest.mark.parametrize("bits", [False, True])
def test_round_trip(bits):
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 2**32, 1003, dtype=np.uint32)
    assert (from_planes(to_planes(ids, bits), len(ids)) == ids).all()
    docs = [(i if i % 5 else None, rng.integers(0, 50257, n, dtype=np.uint32).astype("<u4").tobytes()) for i, n in enumerate([1, 0, 700, 64, 3000, 1, 128, 63])]
    f = io.BytesIO()
    w = TokenFileWriter(f, 64, bits)
    for d in docs:
        w.add(*d)
    w.close()
    r = TokenFileReader(f)
    assert list(r.documents()) == [d for _, d in docs]
    assert [None if n else int(i) for i, n in zip(r.doc_ids, r.null, strict=True)] == [i for i, _ in docs]
    assert np.concatenate([r.chunk(i) for i in range(len(r.chunks))]).tobytes() == b"".join(d for _, d in docs)
    with pytest.raises(ValueError):
        TokenFileReader(io.BytesIO(f.getvalue()[:-1]))


@pytest.mark.parametrize("bits", [False, True])
def test_operator(spark, odd_docs, bits):
    docs = odd_docs.union(odd_docs.limit(1).selectExpr("cast(null as long)", "'no id'", *odd_docs.columns[2:]))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, at = [], 0
    for d, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = [tuple(r) for r in token_store(docs, "byte_bpe_50k.json", block_ids=1000, bits=bits).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_store(odd_docs.limit(0), "byte_bpe_50k.json").count() == 0
