"""Exact tokenizer output at word-cache speed.

Both public tokenizers cut a text at white space before merging, so the ids of
a text are the concatenated ids of its pieces.  Each worker numbers the pieces
it has met and keeps their ids in one array, so a piece of a text costs one
look-up and the rest is array work; only new pieces reach the tokenizers
library, in one batch, ``JOINED`` at a time as one text.  For byte-level
tokenizers these are the pieces that begin with white space, and a token's
bytes say which piece it belongs to; for tokenizers that drop white space a
token's offsets do.  Texts in which non-ASCII white space could join two pieces
are encoded whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np

JOINED = 500
_PIECE_LIMIT = 1_200_000  # pieces kept per worker; memory only, never results
_LOADED: dict[str, object] = {}
_BUILDERS: dict[str, Callable[[], object]] = {}
_PIECES: dict[str, _Pieces] = {}
_TOKEN_BYTES: dict[str, np.ndarray] = {}
_OTHER_SPACE = re.compile(r"[^\S \t\n\r\f\v]")
_PIECE = re.compile(rb"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")


def register(path: str, build: Callable[[], object]) -> None:
    """Files that the library cannot read by itself: ``build`` makes the tokenizer when it is first needed."""
    _BUILDERS[path] = build


def _library(path: str):
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = _BUILDERS[path]() if path in _BUILDERS else Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[path] = tokenizer
    return _LOADED[path]


def _as_bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


def _token_bytes(path: str) -> np.ndarray:
    """Bytes of each token id; a byte-level vocabulary writes every byte as one character."""
    if path not in _TOKEN_BYTES:
        vocabulary = _library(path).get_vocab()
        table = np.zeros(max(vocabulary.values()) + 1, np.int64)
        table[list(vocabulary.values())] = [len(token) for token in vocabulary]
        _TOKEN_BYTES[path] = table
    return _TOKEN_BYTES[path]


class _Pieces(dict):
    """Number of each piece met so far; a new piece takes the next number and waits in ``new`` for its ids."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.start, self.size = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)  # in ids, by number

    def __missing__(self, piece: bytes) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number

    def forget(self) -> None:
        self.clear()
        self.used = 0

    def take_new(self) -> list[bytes]:
        found, self.new = self.new, []
        if len(self) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros(len(self), np.int64)]) for x in (self.start, self.size))
        return found

    def keep(self, pieces: list[bytes], ids: np.ndarray, stops: np.ndarray) -> None:
        """``ids`` of the pieces, one after the other; ``stops``: where each piece's end."""
        numbers = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), "<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[numbers] = np.diff(stops, prepend=0)
        self.start[numbers] = self.used + stops - self.size[numbers]
        self.used += len(ids)

    def ids_of(self, texts: list[np.ndarray]) -> list[bytes]:
        """The ids of each text, given as the numbers of its pieces."""
        numbers = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        size = self.size[numbers]
        stops = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[numbers] - stops[:-1], size) + np.arange(stops[-1])
        raw = self.ids[at].tobytes()
        edges = (4 * stops[np.cumsum([0, *map(len, texts)])]).tolist()
        return [raw[lo:hi] for lo, hi in zip(edges, edges[1:], strict=False)]


def _encode_joined(path: str, pieces: list[bytes], known: _Pieces) -> list[bytes]:
    """Keep the ids of pieces that begin with white space; returns the pieces that need a call each."""
    alone, joined = [], []
    for piece in pieces:
        (joined if piece[:1].isspace() and not piece.isspace() else alone).append(piece)
    groups = [joined[lo : lo + JOINED] for lo in range(0, len(joined), JOINED)]
    done = _library(path).encode_batch_fast([b"".join(g).decode("utf-8") for g in groups], add_special_tokens=False)
    for group, item in zip(groups, done, strict=True):
        ids = np.array(item.ids, "<u4")
        ends = np.cumsum(_token_bytes(path)[ids])
        want = np.cumsum([len(p) for p in group])
        last = np.searchsorted(ends, want)
        if last[-1] != len(ids) - 1 or (ends[last] != want).any():  # a token over two pieces
            alone += group
        else:
            known.keep(group, ids, last + 1)
    return alone


def _encode_words(path: str, words: list[bytes], known: _Pieces) -> list[bytes]:
    """Keep the ids of words, ``JOINED`` at a time as one text; returns the words that need a call each."""
    alone = []
    groups = [[w.decode("utf-8") for w in words[lo : lo + JOINED]] for lo in range(0, len(words), JOINED)]
    done = _library(path).encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
    for at, (group, item) in enumerate(zip(groups, done, strict=True)):
        own_words = words[at * JOINED : (at + 1) * JOINED]
        ids, places = np.array(item.ids, "<u4"), np.array(item.offsets, np.int64).reshape(-1, 2)
        size = np.array([len(w) for w in group])
        first = np.cumsum(size + 1) - size - 1
        own = np.searchsorted(first, places[:, 0], "right") - 1
        if (places[:, 1] > (first + size)[own]).any() or (np.diff(own) < 0).any():  # a token over two words
            alone += own_words
        else:
            known.keep(own_words, ids, np.searchsorted(own, np.arange(len(group)), "right"))
    return alone


def _encode(
    path: str, texts: Iterable[str | None], split: Callable[[bytes], list[bytes]], joined: bool = False
) -> list[bytes]:
    library, known = _library(path), _PIECES.setdefault(path, _Pieces())
    if len(known) > _PIECE_LIMIT:
        known.forget()
    number = known.__getitem__
    whole: dict[int, bytes] = {}
    found: list[np.ndarray] = []
    for at, text in enumerate(texts):
        text = text or ""
        if not text.isascii() and _OTHER_SPACE.search(text):
            whole[at] = _as_bytes(library.encode(text, add_special_tokens=False).ids)
            found.append(np.zeros(0, np.int64))
        else:
            pieces = split(text.encode("utf-8"))
            found.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
    todo = known.take_new()
    todo = _encode_joined(path, todo, known) if joined else _encode_words(path, todo, known)
    for lo in range(0, len(todo), 20_000):
        part = todo[lo : lo + 20_000]
        done = library.encode_batch_fast([p.decode("utf-8") for p in part], add_special_tokens=False)
        ids = [item.ids for item in done]
        known.keep(part, np.array([i for own in ids for i in own], "<u4"), np.cumsum([len(own) for own in ids]))
    return [whole.get(at, own) for at, own in enumerate(known.ids_of(found))]


def word_encoder(path: str) -> Callable[[Iterable[str | None]], list[bytes]]:
    """For tokenizers that drop white space: pieces are the words."""
    return lambda texts: _encode(path, texts, bytes.split)


def byte_encoder(path: str) -> Callable[[Iterable[str | None]], list[bytes]]:
    """For byte-level tokenizers: a piece is a run of white space with the word after it."""
    return lambda texts: _encode(path, texts, _PIECE.findall, joined=True)
