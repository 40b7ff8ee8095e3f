import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import Utf8Stream, codec, decode_text, encode_documents, load_ranks
from tidemark.llm.queries import queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = load_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, text):
    coder = codec(PATH, PATTERN)
    assert coder.encode(text) == library.encode_ordinary(text)
    assert "".join(decode_text(coder, coder.encode_chunks(text))) == text


def test_token_strings(library):
    """Texts glued from vocabulary tokens, where many readings stay open."""
    coder, pick = codec(PATH, PATTERN), random.Random(5)
    tokens = list(load_ranks(PATH))
    for _ in range(3000):
        text = b"".join(pick.choices(tokens, k=pick.randint(1, 9))).decode("utf-8", "ignore")
        assert coder.encode(text) == library.encode_ordinary(text)


def test_long_match_and_windows(library):
    coder = codec(PATH, PATTERN)
    for text in ("ab" * 60_000, ("Wörter und  Räume\n\n " * 80_000) + "ende"):
        assert coder.encode(text) == library.encode_ordinary(text)


def test_utf8_across_chunks():
    text = "aé日😀\n" * 3
    data = text.encode()
    for size in range(1, 8):
        stream = Utf8Stream()
        assert "".join(stream.feed(data[i : i + size]) for i in range(0, len(data), size)) == text
        stream.close()
    for bad in (b"\x80", b"\xc0\xaf", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xc3a", b"\xff"):
        with pytest.raises(ValueError):
            stream = Utf8Stream()
            stream.feed(bad)
            stream.close()
    stream = Utf8Stream()
    stream.feed(b"\xe6\x97")
    with pytest.raises(ValueError):
        stream.close()


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "Ein Satz.", "x"), (4, "w" * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in encode_documents(docs, PATH, PATTERN).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {(1, 0, sha("")), (2, 0, sha(""))} < got and len(got) == 4
    assert any(r[0] is None and r[2] == sha("Ein Satz.") for r in got)
    assert encode_documents(docs, PATH, PATTERN).count() == 5
    assert encode_documents(docs.where("false"), PATH, PATTERN).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries()["op2_byte_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for doc in docs.collect():
        ids = np.array(library.encode_ordinary(doc.text), "<u4")
        row = got.pop(doc.doc_id)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()
    assert not got
