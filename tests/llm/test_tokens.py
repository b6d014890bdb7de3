import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tilelake.llm import tokens
from tilelake.llm.tokens import encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PLAIN = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}  # as the library gives it


def same(f, text):
    assert np.frombuffer(encoder(f).encode(text), "<u4").tolist() == PLAIN[f].encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("f", FILES)
@settings(max_examples=1500, deadline=None)
@given(text=st.one_of(st.text(max_size=40), st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40), st.text(alphabet="ab's '1\n\t  É.!İıſ<|endoftext>\x1c\x85\xa0ͅΣσ", max_size=40)))
def test_random_texts(f, text):
    same(f, text)


@pytest.mark.parametrize("f", FILES)
def test_every_latin_character(f):
    for c in range(0x260):
        same(f, f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}B")


@pytest.mark.parametrize("f", FILES)
def test_special_strings(f):
    for t in ("hello <|endoftext|> world", "it's <|endoftext|> x<|startoftext|>", "<|endoftext|>", " <|EndOfText|> <|endoftext", "a<|startoftext|><|endoftext|>é"):
        same(f, t)
    assert len(np.frombuffer(encoder(f).encode("hello <|endoftext|> world"), "<u4")) < 6


@pytest.mark.parametrize("f", FILES)
def test_bounded_table(f):
    enc = tokens.FastEncoder(public_tokenizers.path(f), 20_000)
    for i in range(60):
        t = " ".join(f"w{i * j}q" for j in range(200 if i == 30 else 12))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == PLAIN[f].encode(t, add_special_tokens=False).ids
        assert all(sum(tokens._ENTRY + len(p) + len(x) for p, x in table.items()) <= 40_000 for table in (enc.known, enc.older))


@pytest.mark.parametrize("f", FILES)
def test_documents(f):
    for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()[:300]:
        same(f, t)
