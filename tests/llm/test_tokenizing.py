"""Cached and joined encoding gives the tokenizer's own ids."""

import random

import numpy as np
import public_tokenizers
import pytest

from parcelworks.llm import tokenizing


@pytest.mark.parametrize(("name", "encoder"), [
    ("byte_bpe_50k.json", tokenizing.byte_encoder), ("word_bpe_49k.json", tokenizing.word_encoder),
])
def test_same_ids_as_whole_texts(name, encoder):
    path = pytest.importorskip("public_tokenizers").path(name)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    rng = random.Random(6)
    parts = ["it's", "naïve", "日本語", "12345", "x_y", "<|endoftext|>", "…", "'ll", "á", " ", " z", "🙂🙂", "--", "\x00",
             "\x1c", "\x85", "WORD", "end."]
    spaces = [" ", "  ", "\n", "\n\n ", "\t", " \r\n", "\x0b", "\x0c  ", ""]
    texts = ["", " ", "\n\n", None, " lead", "trail  ", "one"]
    texts += ["".join(rng.choice(spaces) + rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    encode = encoder(path)
    for lo in (0, 0, 100):  # the second call reads the cache
        found = encode(texts[lo:])
        for text, blob in zip(texts[lo:], found, strict=True):
            assert np.frombuffer(blob, "<u4").tolist() == own.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_shared_folders_of_every_scheme():
    from parcelworks.llm.token_output import store_of

    keys = {"spark.hadoop.fs.s3a.access.key": "a", "spark.hadoop.fs.s3a.endpoint": "http://store:9000", "spark.other": "x"}
    assert store_of("s3a://bucket/x/tokens", keys) == ("s3", "bucket/x/tokens", {"access_key": "a", "endpoint_override": "http://store:9000"})
    assert store_of("file:/tmp/x", {}) == store_of("file:///tmp/x", {}) == store_of("/tmp/x", {}) == ("local", "/tmp/x", {})
    assert store_of("hdfs://node:8020/x", {}) == ("hdfs", "/x", {"host": "node", "port": 8020})
    assert store_of("gs://bucket/x", {})[:2] == ("gs", "bucket/x") and store_of("abfss://c@account/x", {})[:2] == ("uri", "abfss://c@account/x")
    with pytest.raises(ValueError, match="ftp"):
        store_of("ftp://host/x", {})


def test_words_joined_or_alone_give_the_same_ids():
    from tokenizers import Tokenizer

    from parcelworks.llm.tokenizing import word_encoder

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = ["don't I'LL \u0130stanbul \ufb01 \u00df x\x00y <|endoftext|> a<|endoftext|>b \u65e5\u672c\u8a9e \U0001f642", "\u200b \ufeff \u0391\u03a3 's 's", "", "\x1c a\x1fb", "a" * 300]
    texts += [" ".join(f"w{k * 7919 % 3001}x{k}" for k in range(1200))]
    for text, packed in zip(texts, word_encoder(path)(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "joined"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_known_piece_is_looked_up_once(name, joined, monkeypatch):
    from tokenizers import Tokenizer

    hashed = []

    class Piece(bytes):
        def __hash__(self):
            hashed.append(self)
            return bytes.__hash__(self)

        __eq__ = bytes.__eq__

    path = public_tokenizers.path(name)
    split = tokenizing._PIECE.findall if joined else bytes.split
    texts = [" ".join(f"q{k * 31 % 97}z" for k in range(n)) for n in (300, 0, 200)]

    def encode(part):
        return tokenizing._encode(path, part, lambda raw: [Piece(p) for p in split(raw)], joined)

    first = encode(texts)
    hashed.clear()
    assert encode(texts) == first and len(hashed) == sum(len(split(t.encode())) for t in texts)
    plain = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in first] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokenizing, "_PIECE_LIMIT", 10)  # what was kept is forgotten and met again
    for _ in range(2):
        assert encode(texts + ["other words"])[:3] == first
