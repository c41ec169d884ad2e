"""Alignment of two tokenizers against brute force."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelworks.llm import queries, token_alignment
from parcelworks.llm.token_alignment import merge_path, overlaps

from .test_byte_bpe import ODD
from .test_operators import ROWS, SCHEMA

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Brute:
    """Every result from the definition, on plain strings and sets."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.byte = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}

    def bytes_a(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, text):
        """[(id, start, end)] of both, or None."""
        if not text:
            return None
        out = []
        for ids, show in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a), (self.b.encode(text), self.bytes_b)):
            parts = [show(i) for i in ids]
            if b"".join(parts) != b" " + text.encode():
                return None
            ends = np.cumsum([len(p) for p in parts]).tolist()
            out.append(list(zip(ids, [0, *ends[:-1]], ends, strict=True)))
        return out

    def rows(self, docs):
        spans = [self.spans(text) for _, text in docs]
        links = [[] if s is None else [(x[0], y[0]) for x in s[0] for y in s[1] if x[1] < y[2] and y[1] < x[2]] for s in spans]
        count = collections.Counter(pair for own in links for pair in own)
        top = collections.defaultdict(int)
        for (_, b), n in count.items():
            top[b] = max(top[b], n)
        out = []
        for (doc_id, _), s, own in zip(docs, spans, links, strict=True):
            if s is None:
                out.append((doc_id, 0, 0, 0, 0, "", 0, 0))
                continue
            cuts = sorted({x[2] for x in s[0]} & {y[2] for y in s[1]})
            shown, low = [], 0
            for cut in cuts:
                shown.append("|".join(",".join(str(t[0]) for t in side if low <= t[1] and t[2] <= cut) for side in s))
                low = cut
            sha = hashlib.sha256(";".join(shown).encode()).hexdigest()
            best = sum(count[p] == top[p[1]] for p in own)
            out.append((doc_id, len(s[0]), len(s[1]), len(cuts), len(own), sha, best, sum(count[p] for p in own)))
        return out


@pytest.fixture(scope="module")
def brute():
    return Brute()


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, *map(str, r)))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_frames(spark, brute, monkeypatch):
    more = [t[:400] for t in ODD] + ["▁ literally", "</s><s> x", "<0x41>", " lead  and trail ", "\x00", "a\x00b"]
    rows = [r for r in ROWS if len(r[1] or "") < 3000] + [(900 + k, t, "en", "web", 1, "k", 7, 0, 0) for k, t in enumerate(more)]
    want = ordered(brute.rows([r[:2] for r in rows]))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    documents, pairs = token_alignment.align(docs, A, B)
    assert ordered(documents.select(COLUMNS).collect()) == want
    assert sum(r[4] == 0 for r in want) >= 5 and sum(r[4] > 0 for r in want) > 80
    total = sum(r.total for r in pairs.collect())
    assert total == sum(r[4] for r in want)
    parts = token_alignment.groups(docs.where("doc_id = 0"), A, B).orderBy("group").collect()
    spans = brute.spans(rows[0][1])
    assert [i for p in parts for i in p.a_ids] == [x[0] for x in spans[0]]
    assert [i for p in parts for i in p.b_ids] == [x[0] for x in spans[1]]
    assert {p.byte_end for p in parts} == {x[2] for x in spans[0]} & {x[2] for x in spans[1]}
    assert [p.byte_start for p in parts] == [0, *[p.byte_end for p in parts][:-1]]


def test_small_pieces_and_chunks(spark, brute):
    aligner = token_alignment.Aligner(A, B)
    texts = [r[1] for r in ROWS] + ODD
    whole = aligner.align(texts)
    for piece in (1, 2, 7, 64):
        for one, two in zip(whole, aligner.align(texts, piece), strict=True):
            assert (one is None) == (two is None)
            assert one is None or all((x == y).all() for x, y in zip(one, two, strict=True))


def test_empty(spark):
    documents, pairs = token_alignment.align(spark.createDataFrame([], SCHEMA), A, B)
    assert documents.count() == 0 and pairs.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 9))
def test_merge_path(a, b, piece):
    a, b = np.array(sorted(a | {61})), np.array(sorted(b | {61}))
    to_a, to_b = merge_path(a, b, piece)
    merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
    for i, j in zip(to_a.tolist(), to_b.tolist(), strict=True):
        assert merged[: i + j].count((a[i - 1] if i else -1, 0)) == (i > 0) and sum(k == 0 for _, k in merged[: i + j]) == i
    assert set(np.diff(to_a + to_b)[:-1].tolist()) <= {piece}
    link_a, link_b, cut_a, cut_b = overlaps(a, b, piece)
    starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
    assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[cut_a - 1].tolist() == common == b[cut_b - 1].tolist()


def test_query(spark, brute):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    short = [d for d in docs if len(d[1] or "") < 4000]
    found = {r.doc_id: r for r in queries.QUERIES["op12_token_alignment"](spark, folder).select(COLUMNS).collect()}
    assert len(found) == len(docs)
    for row in brute.rows(short):  # the counts of pairs are corpus-wide; compare what a document alone decides
        assert tuple(found[row[0]])[:6] == row[:6]
