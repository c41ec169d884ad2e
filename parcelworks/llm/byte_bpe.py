"""Byte-level BPE from a file of ranks: encoding, offsets and decoding over Arrow batches.

A rank file lists byte strings by merge order.  The tokenizers library wants
characters and merge pairs instead: every byte is written as one printable
character, and a rank becomes one merge for each way to cut its byte string
into two ranked ones.  A piece that is itself ranked is one token; other pieces
merge their lowest rank first, leftmost on ties.  ``tokenizing`` caches the ids
of pieces, so only pieces that a worker has not met reach the library.

Encoding: ``ids`` are little-endian unsigned 32-bit integers, packed; with
``offsets`` also the byte end of every token and the characters that it touches
(a token may hold a part of a character; then its neighbours touch it too).

Decoding reverses the byte table.  ``decode`` gives exact bytes.
``decode_windows`` gives text for runs of tokens; a character split between two
windows is held back and belongs to the later one, so that the windows joined
are the decoded text.

Defined results: null and empty text have no ids; repeated rows and null
doc_ids are rows like others; ids outside the rank file raise; bytes that are
no UTF-8 become U+FFFD in windows only; a text that is one long piece is one
call of the library; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import own_columns
from .tokenizing import byte_encoder, register

_BYTES: dict[str, list[bytes]] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(0x100 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _splits(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Places to cut a token into two ranked ones, in the order in which overlapping cuts apply from the left.

    Where x y z holds the token twice (x y and y z), x y must come first.
    """
    n = len(token)
    places = []
    for high in range(n - 1, (n - 1) // 2, -1):
        low = n - high
        low_first = token.startswith(token[low:]) and not token.startswith(token[high:])
        places += dict.fromkeys((low, high) if low_first else (high, low))
    return [at for at in places if token[:at] in ranks and token[at:] in ranks]


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizers object that merges the ranks inside each match of ``pattern``."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    names = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (names[token[:at]], names[token[at:]])
        for token in sorted(ranks, key=ranks.get)
        for at in _splits(token, ranks)
    ]
    tokenizer = Tokenizer(models.BPE({names[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id; ids without a rank raise when they are looked up."""
    if path not in _BYTES:
        ranks = read_ranks(path)
        table: list = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _BYTES[path] = table
    return _BYTES[path]


def rank_encoder(path: str, pattern: str):
    """Texts to packed ids; ``pattern`` must match white space only before or without other characters."""
    name = f"{path}\n{pattern}"
    register(name, lambda: build_tokenizer(read_ranks(path), pattern))
    return byte_encoder(name)


def decode_ids(ids: Iterable[int], path: str) -> bytes:
    return b"".join(map(token_bytes(path).__getitem__, ids))


def offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte end, first character, end character) of every token of a text."""
    table = token_bytes(path)
    sizes = np.array([len(table[i]) for i in ids.tolist()], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    begun = np.cumsum((raw & 0xC0) != 0x80)
    return ends, begun[ends - sizes] - 1, begun[ends - 1]


def encode(docs: DataFrame, path: str, pattern: str, with_offsets: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids; with offsets also byte_ends, char_starts, char_ends."""
    places = ["byte_ends", "char_starts", "char_ends"] if with_offsets else []

    def run(batches):
        encoder = rank_encoder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            packed = encoder(texts)
            columns = [batch["doc_id"], pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())]
            if places:
                found = [offsets(t, np.frombuffer(p, "<u4"), path) for t, p in zip(texts, packed, strict=True)]
                columns += [pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", *places])

    schema = ", ".join(["doc_id long, n_tokens long, ids binary", *(f"{p} array<long>" for p in places)])
    return own_columns(docs, "doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``encoded``, its ids, and ``decoded``: the exact bytes of the ids."""
    names = [*keep, "ids"]
    source = own_columns(encoded, *names)

    def run(batches):
        for batch in batches:
            made = [decode_ids(np.frombuffer(i, "<u4").tolist(), path) for i in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*names, "decoded"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{kinds}, decoded binary")


def window_texts(ids: np.ndarray, size: int, path: str) -> list[str]:
    """Text of every ``size`` tokens; an unfinished character waits for the window that ends it."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    starts = range(0, len(ids), size)
    return [reader.decode(decode_ids(ids[at : at + size].tolist(), path), at + size >= len(ids)) for at in starts]


def decode_windows(encoded: DataFrame, path: str, size: int) -> DataFrame:
    """doc_id, window (from 0), text: the decoded text in windows of ``size`` tokens."""

    def run(batches):
        for batch in batches:
            for doc_id, packed in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                texts = window_texts(np.frombuffer(packed, "<u4"), size, path)
                columns = [pa.array([doc_id] * len(texts), pa.int64()), pa.array(range(len(texts)), pa.int32()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "window", "text"])

    return own_columns(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, window int, text string")
