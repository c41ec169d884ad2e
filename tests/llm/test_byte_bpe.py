"""Byte-level BPE against the tiktoken library and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelworks.llm import byte_bpe, queries

from .test_operators import ROWS, SCHEMA

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.rank_encoder(PATH, PATTERN)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


ODD = [
    "日本語のテキスト 🙂🙃 é   x  y\x85z", "<|endoftext|> don't we'll I'M  \n\n  x\t\t", "\x00\x1c\x1f a​b",
    "=" * 5000, " " * 3000 + "x", "ab" * 4000, "\n" * 77, "a" * 100_001, "é" * 999, "﻿�\U0010ffff",
]


def test_odd_texts(encoder, reference):
    for text, packed in zip(ODD, encoder(ODD), strict=True):
        assert ids_of(packed) == reference.encode_ordinary(text)
        assert byte_bpe.decode_ids(ids_of(packed), PATH) == text.encode()


def test_runs(encoder, reference):
    rng = random.Random(1)
    units = ["a", "=", "-", " ", "ab", "\n", "é", "0", "の", "ha", "==-"]
    texts = ["".join(rng.choice(units) * rng.randint(1, 30) for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    assert [ids_of(p) for p in encoder(texts)] == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, reference, text):
    packed = encoder([text.encode("utf-8", "ignore").decode()])[0]
    assert ids_of(packed) == reference.encode_ordinary(text.encode("utf-8", "ignore").decode())


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aé🙂日 \n1!", max_size=40), st.integers(1, 5))
def test_windows_and_offsets(encoder, text, size):
    ids = np.frombuffer(encoder([text])[0], "<u4")
    windows = byte_bpe.window_texts(ids, size, PATH)
    assert "".join(windows) == text and len(windows) == -(-len(ids) // size)
    ends, first, last = byte_bpe.offsets(text, ids, PATH)
    raw, at = text.encode(), 0
    for token, end, lo, hi in zip(ids.tolist(), ends.tolist(), first.tolist(), last.tolist(), strict=True):
        assert byte_bpe.decode_ids([token], PATH) == raw[at:end]
        touched = [k for k in range(len(text)) if len(text[:k].encode()) < end and len(text[: k + 1].encode()) > at]
        assert list(range(lo, hi)) == touched
        at = end


def test_frames(spark, reference):
    rows = ROWS + [(900 + k, text, "en", "web", 1, "k", 7, 0, 0) for k, text in enumerate(ODD)]
    encoded = byte_bpe.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH, PATTERN)
    found = sorted(((r.doc_id is None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in byte_bpe.decode(encoded, PATH, "doc_id").collect()))
    want = [reference.encode_ordinary(t or "") for _, t, *_ in rows]
    packed = [np.array(w, "<u4").tobytes() for w in want]
    assert found == sorted((d is None, d or 0, p, (t or "").encode()) for (d, t, *_), p in zip(rows, packed, strict=True))
    wide = byte_bpe.encode(spark.createDataFrame(rows, SCHEMA), PATH, PATTERN, with_offsets=True).collect()
    assert all(len(r.byte_ends) == len(r.char_starts) == len(r.char_ends) == r.n_tokens for r in wide)
    pieces = byte_bpe.decode_windows(encoded.where("doc_id = 900"), PATH, 3).orderBy("window").collect()
    assert "".join(r.text for r in pieces) == ODD[0] and [r.window for r in pieces] == list(range(len(pieces)))
    empty = byte_bpe.encode(spark.createDataFrame([], SCHEMA), PATH, PATTERN)
    assert byte_bpe.decode(empty, PATH, "doc_id").count() == 0


def test_query(spark, reference):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.QUERIES["op13_byte_bpe"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
