"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Both tokenizers cut a space and the text into runs of bytes, so a document is
two rising lists of token ends with the same last end.  Two tokens are linked
where their byte ranges overlap; an offset where a token of each ends cuts the
tokens into groups.

The ends of many documents stand in one list per tokenizer (a document's last
end closes a group, so documents never mix).  A merge of both lists is a path
through a grid; its crossing with every ``PIECE``-th diagonal is found by binary
search, for all diagonals at once.  The crossings divide the merge into pieces
of equal work whatever the documents' lengths, each of which needs only its own
two slices and the end before them: it emits the overlaps of its tokens and the
places where groups close.  A group that a piece leaves open is closed by a
later one, so the groups are stitched from the pieces' closing places.

Corpus-wide counts: a task adds up the links of each id pair over chunks of
about ``CHUNK_LINKS`` links; Spark sums the chunks' pairs, finds each second
id's highest count and sends every chunk the counts of its own pairs only.  So
what is shuffled back grows with a chunk's distinct pairs, no pair table is
broadcast, and a pair that all documents hold has one row per chunk.

Defined results: a document has no tokens where its text is null or empty or
where either tokenizer does not give back its bytes (then all its counts are
zero and it links nothing); repeated rows and null doc_ids are rows like
others; a very long text is merged in many pieces; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import byte_characters
from .common import own_columns, stored
from .tokenizing import _library, byte_encoder

PIECE = 1 << 13  # tokens of both kinds in a piece
CHUNK_LINKS = 1 << 22
_BATCH_BYTES = 1 << 22  # of texts merged at once
_TABLES: dict[str, list[bytes]] = {}
_MODELS: dict[str, object] = {}


def _sentence_model(path: str):
    if path not in _MODELS:
        import sentencepiece

        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def byte_level_bytes(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level tokenizers file."""
    if path not in _TABLES:
        value = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = _library(path).get_vocab()
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            table[number] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode("utf-8")
        _TABLES[path] = table
    return _TABLES[path]


def piece_bytes(path: str) -> list[bytes]:
    """Bytes of every id of a sentencepiece model: U+2581 is a space, a byte piece its byte."""
    if path not in _TABLES:
        model = _sentence_model(path)
        names = [model.id_to_piece(number) for number in range(model.get_piece_size())]
        _TABLES[path] = [
            bytes([int(name[3:5], 16)]) if model.is_byte(number) else name.replace("▁", " ").encode("utf-8")
            for number, name in enumerate(names)
        ]
    return _TABLES[path]


def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of a and of b lie before each ``piece``-th step of their merge (a first on ties)."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        searching = low < high
        other = np.clip(diagonal - 1 - middle, 0, max(len(b) - 1, 0))
        later = searching & (a[np.minimum(middle, len(a) - 1)] <= b[other])
        low = np.where(later, middle + 1, low)
        high = np.where(searching & ~later, middle, high)
    return low, diagonal - low


def piece_overlaps(a: np.ndarray, b: np.ndarray, first: tuple[int, int], before: int):
    """Of one piece: (a, b) numbers of its overlaps, and the numbers after which a group closes.

    ``a`` and ``b`` are the piece's slices, ``first`` the numbers of their first
    ends and ``before`` the end of a just before the slice.
    """
    order = np.argsort(np.concatenate([a, b]), kind="stable")
    is_a = order < len(a)
    at_a = np.cumsum(is_a) - is_a  # ends of a before each step
    at_b = np.arange(len(order)) - at_a
    last = np.concatenate([[before], a])[at_a]  # the latest end of a before each step
    common = np.zeros(len(order), bool)
    common[~is_a] = last[~is_a] == b[at_b[~is_a]]
    link = ~common
    closes = np.flatnonzero(common)
    return at_a[link] + first[0], at_b[link] + first[1], at_a[closes] + first[0], at_b[closes] + first[1] + 1


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """(a, b) numbers of all overlaps, and how many tokens of a and of b lie up to the end of each group."""
    if not len(a):
        return (np.zeros(0, np.int64),) * 4
    to_a, to_b = merge_path(a, b, piece)
    made = [
        piece_overlaps(a[i:i2], b[j:j2], (i, j), a[i - 1] if i else 0)
        for i, i2, j, j2 in zip(to_a[:-1], to_a[1:], to_b[:-1], to_b[1:], strict=True)
    ]
    return tuple(np.concatenate(part) for part in zip(*made, strict=True))


class Aligner:
    """Both tokenizers of a worker and the alignment of a batch of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.encode_a = byte_encoder(a_path)
        self.model_b = _sentence_model(b_path)
        self.bytes_a, self.bytes_b = byte_level_bytes(a_path), piece_bytes(b_path)
        self.size_a, self.size_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers, or None for a text that has no tokens."""
        texts = [t or "" for t in texts]
        first = [np.frombuffer(ids, "<u4") for ids in self.encode_a([" " + t for t in texts])]
        out: list = []
        for text, a, b in zip(texts, first, self.model_b.encode(texts, num_threads=1), strict=True):
            raw = b" " + text.encode("utf-8")
            same = text and self._joined(self.bytes_a, a.tolist()) == raw and self._joined(self.bytes_b, b) == raw
            out.append((a.astype(np.int64), np.array(b, np.int64)) if same else None)
        return out

    @staticmethod
    def _joined(table: list[bytes], ids: list[int]) -> bytes:
        return b"".join(map(table.__getitem__, ids))

    def align(self, texts: list[str | None], piece: int = PIECE):
        """Per text (None without tokens): ids of both, overlaps and ends of groups, numbered within the text."""
        found = self.tokens(texts)
        pairs = [f for f in found if f is not None]
        if not pairs:
            return found
        a, b = (np.concatenate(ids) for ids in zip(*pairs, strict=True))
        link_a, link_b, cut_a, cut_b = overlaps(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), piece)
        n_a, n_b = (np.cumsum([0, *(len(p[k]) for p in pairs)]) for k in (0, 1))
        links, cuts = np.searchsorted(link_a, n_a), np.searchsorted(cut_a, n_a, "right")
        made = iter(
            (
                ids_a, ids_b,
                link_a[links[k] : links[k + 1]] - n_a[k], link_b[links[k] : links[k + 1]] - n_b[k],
                cut_a[cuts[k] : cuts[k + 1]] - n_a[k], cut_b[cuts[k] : cuts[k + 1]] - n_b[k],
            )
            for k, (ids_a, ids_b) in enumerate(pairs)
        )
        return [None if f is None else next(made) for f in found]


@functools.cache
def _names(n_a: int, n_b: int) -> list[bytes]:
    """Decimal ids with what follows them: a's inside and at the end of their part of a group, then b's."""
    marks = [(n_a, b","), (n_a, b"|"), (n_b, b","), (n_b, b";")]
    return [b"%d%s" % (number, mark) for n, mark in marks for number in range(n)]


def group_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, n_a: int, n_b: int) -> bytes:
    """The groups as ``a1,a2|b1;a3|b2,b3``; n_a and n_b are the vocabularies' sizes."""
    group_a = np.searchsorted(cut_a, np.arange(len(a)), "right")
    group_b = np.searchsorted(cut_b, np.arange(len(b)), "right")
    place_a = np.arange(len(a)) + np.concatenate([[0], cut_b])[group_a]
    place_b = np.arange(len(b)) + cut_a[group_b]
    code_a, code_b = a.copy(), b + 2 * n_a
    code_a[cut_a - 1] += n_a
    code_b[cut_b - 1] += n_b
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a], codes[place_b] = code_a, code_b
    return b"".join(map(_names(n_a, n_b).__getitem__, codes.tolist()))[:-1]


def _batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (..., text) in lists of about _BATCH_BYTES of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if size >= _BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


_KEPT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_SCHEMA = f"chunk long, whole boolean, {_KEPT}, codes binary, times binary"
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
_ROWS = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in _SCHEMA.split(", "))])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, times = (np.concatenate(p) for p in zip(*parts, strict=True))
    codes, inverse = np.unique(codes, return_inverse=True)
    return codes, np.bincount(inverse, times, len(codes)).astype(np.int64)


def _packed(codes: np.ndarray, times: np.ndarray) -> dict[str, bytes]:
    return {"codes": codes.astype("<i8").tobytes(), "times": times.astype("<i8").tobytes()}


def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per document with its distinct id pairs (codes, and how many links hold each), and one per chunk (``whole``)."""

    def run(batches):
        aligner = Aligner(a_path, b_path)
        n_a, n_b = len(aligner.bytes_a), len(aligner.bytes_b)
        chunk, links, parts = None, 0, []

        def close():
            codes, times = _summed(parts)
            return pa.RecordBatch.from_pylist([{"chunk": chunk, "whole": True, **_packed(codes, times)}], _ROWS)

        for held in _batches(_rows(batches)):
            if chunk is None:
                chunk = held[0][0] << 32
            made = []
            for (_, doc_id, _), found in zip(held, aligner.align([row[-1] for row in held]), strict=True):
                if found is None:
                    none = dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), 0)
                    made.append({"chunk": chunk, "whole": False, "doc_id": doc_id, **none, "groups_sha256": "", "codes": b"", "times": b""})
                    continue
                a, b, link_a, link_b, cut_a, cut_b = found
                codes, times = np.unique(a[link_a] * n_b + b[link_b], return_counts=True)
                parts.append((codes, times))
                links += len(link_a)
                counts = {"n_a": len(a), "n_b": len(b), "n_groups": len(cut_a), "n_links": len(link_a)}
                shown = hashlib.sha256(group_text(a, b, cut_a, cut_b, n_a, n_b)).hexdigest()
                made.append({"chunk": chunk, "whole": False, "doc_id": doc_id, **counts, "groups_sha256": shown, **_packed(codes, times)})
            yield pa.RecordBatch.from_pylist(made, _ROWS)
            if links >= CHUNK_LINKS:
                yield close()
                chunk, links, parts = chunk + 1, 0, []
        if parts:
            yield close()

    own = own_columns(docs, "doc_id", "text").select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    return stored(own.mapInArrow(run, _SCHEMA), "aligned")


def _unpacked(batches):
    """(chunk, code, n) of the chunks' pairs."""
    for batch in batches:
        for chunk, codes, times in zip(*(batch[c].to_pylist() for c in ("chunk", "codes", "times")), strict=True):
            codes, times = np.frombuffer(codes, "<i8"), np.frombuffer(times, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), chunk)), pa.array(codes), pa.array(times)], ["chunk", "code", "n"])


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one chunk with their sums over links; ``right`` has the counts of the chunk's pairs."""
    order = np.argsort(right["code"].to_numpy())
    known, total, best = (right[c].to_numpy()[order] for c in ("code", "total", "best"))
    n_best, sums = [], []
    for codes, times in zip(left["codes"].to_pylist(), left["times"].to_pylist(), strict=True):
        codes, times = np.frombuffer(codes, "<i8"), np.frombuffer(times, "<i8")
        at = np.searchsorted(known, codes)
        n_best.append(int(times[best[at]].sum()) if len(at) else 0)
        sums.append(int((times * total[at]).sum()) if len(at) else 0)
    kept = left.select([c.split()[0] for c in _KEPT.split(", ")])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) for a byte-level tokenizers file and a sentencepiece model.

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has
    the highest count of its second id), count_sum (the links' counts summed),
    groups_sha256 (of the groups as ``a1,a2|b1;a3|b2``, '' without tokens).
    pairs: a_id, b_id, total (links that hold the pair), best.
    """
    found = _aligned(docs, a_path, b_path)
    n_b = F.lit(len(piece_bytes(b_path)))
    listed = found.where("whole").select("chunk", "codes", "times")
    listed = stored(listed.mapInArrow(_unpacked, "chunk long, code long, n long"), "chunk-pairs")
    totals = listed.groupBy("code").agg(F.sum("n").alias("total"))
    # at most as many rows as the first vocabulary has ids meet in one window
    highest = F.max("total").over(Window.partitionBy(F.col("code") % n_b))
    totals = stored(totals.select("code", "total", (F.col("total") == highest).alias("best")), "pair-totals")
    known = listed.select("chunk", "code").join(totals, "code")
    documents = found.where("not whole").groupBy("chunk").cogroup(known.groupBy("chunk"))
    pairs = totals.select((F.col("code") / n_b).cast("int").alias("a_id"), (F.col("code") % n_b).cast("int").alias("b_id"), "total", "best")
    return documents.applyInArrow(_scored, f"{_KEPT}, n_best long, count_sum long"), pairs


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per group: doc_id, group (from 0), byte_start, byte_end (in a space and the text), a_ids, b_ids."""

    def run(batches):
        aligner = Aligner(a_path, b_path)
        for held in _batches(_rows(batches)):
            for (doc_id, _), found in zip(held, aligner.align([row[-1] for row in held]), strict=True):
                if found is None:
                    continue
                a, b, _, _, cut_a, cut_b = found
                ends = np.cumsum(aligner.size_a[a])[cut_a - 1]
                made = [pa.array([doc_id] * len(cut_a), pa.int64()), pa.array(np.arange(len(cut_a), dtype=np.int32))]
                made += [pa.array(np.concatenate([[0], ends[:-1]]), pa.int64()), pa.array(ends, pa.int64())]
                for ids, cut in ((a, cut_a), (b, cut_b)):
                    made.append(pa.ListArray.from_arrays(np.concatenate([[0], cut]).astype(np.int32), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "group", "byte_start", "byte_end", "a_ids", "b_ids"])

    kinds = "doc_id long, group int, byte_start long, byte_end long, a_ids array<int>, b_ids array<int>"
    return own_columns(docs, "doc_id", "text").mapInArrow(run, kinds)
