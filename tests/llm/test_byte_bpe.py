import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from wapspark.llm import byte_bpe as B
from llm_fixtures import docs  # noqa: F401

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.load_ranks(PATH),
                             special_tokens={})


TEXTS = ["", None, "don't we'll they've I'm 'store '' 're're ' s", "  a  b\n\nc \n d\t\te   ",
         "x" * 700, " " * 50 + "a", " ''s 's's'\n's", "a​z \x1c a\x85b　c", "日本語 漢字 한국어 😀",
         "a'S b'LL c'll' l'", "123 4567 ½ ²", "!!!??? ...---===", "\r\n\r\n x", "<|endoftext|>",
         "͸ new \U0001FAE8 letters ꟱", "the " * 20000, "é" * 3000]


def ids_of(spark_frame):
    return {r["doc_id"]: list(r["ids"]) for r in spark_frame.collect()}


def test_equals_library(docs, library):
    rng = random.Random(3)
    alphabet = list("aeth 'stdrvml \n\t.,!12é漢😀ß")
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(500)]
    texts += [bytes(rng.choices(range(256), k=200)).decode("utf-8", "ignore") for _ in range(100)]
    rows = list(enumerate(texts))
    assert ids_of(B.encode(docs(rows), PATH, P.PATTERN)) == {
        i: library.encode_ordinary(t or "") for i, t in rows}


def test_digests(spark, docs, library):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r[0], r[1]) for r in d.collect()] + [(None, "a"), (None, "a"), (10**9, None)]
    got = sorted(map(tuple, B.digests(docs(rows), PATH, P.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert B.digests(docs([]), PATH, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40))
def test_transducer_equals_merging(text):
    codec = B.codec(PATH, P.PATTERN)
    assert codec.transducer.encode(text) == (B.merge(codec.transducer.ranks, text) if text else [])


def test_states_and_cache_may_be_emptied(library, monkeypatch):
    codec = B.Codec(PATH, P.PATTERN)
    monkeypatch.setattr(B, "MAX_STATES", 20)
    codec.cache.limit = 10
    import pyarrow as pa
    from wapspark.llm import words as W
    texts = [f"word{i} th{i}er ing is the of{i * 7}" for i in range(50)]
    for chunk in W.text_chunks(pa.array(texts), 100):
        ids, bounds = codec.encode_chunk(chunk)
        for r in range(chunk.rows):
            assert ids[bounds[r]:bounds[r + 1]].tolist() == library.encode_ordinary(
                texts[chunk.first + r])


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30), st.integers(1, 5))
def test_stream_equals_whole_decoding(data, step):
    stream = B.Utf8Stream()
    text = "".join(stream.push(data[i:i + step]) for i in range(0, len(data), step))
    assert text + stream.close() == data.decode("utf-8", "replace")


def test_emission_does_not_wait_for_the_end():
    """The tokens that wait stay few, however long the pre-token."""
    t = B.codec(PATH, P.PATTERN).transducer
    text = b"thatinghertion" * 200
    state = longest = 0
    for byte in text:
        step = t.next.get(state << 8 | byte) or t._step(state, byte)
        state = step[0]
        longest = max(longest, *map(len, t.states[state][2]))
    assert longest <= 16
