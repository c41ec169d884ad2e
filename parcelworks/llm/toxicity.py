"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words (lower-cased A-Z, split at ASCII white space, ASCII punctuation removed)
are hashed into ``BUCKETS`` embeddings; a word is the sum of the embeddings of
itself and of its first 4, 5 and 6 bytes, so inflected forms share evidence.
Filters of widths 1, 2 and 3 slide over the whole text; each filter's maximum over all positions feeds a logistic
output.  Embeddings, filters and output are trained together with Adam.  The
first embedding dimension starts at the word's smoothed log-odds in the
training rows, the others at random.

Training uses every labelled row that the caller allows.  A third of them (by
a hash of doc_id) is held back for calibration; the others are dealt by hash
into blocks of about ``BLOCK_WORDS`` words.  In each of ``EPOCHS`` rounds every
block trains from the same model inside a task, and the changes are averaged
over the blocks, weighted by their texts (an embedding: over the blocks that
changed it).  Changes are summed as whole numbers, so the model does not depend
on how blocks are dealt to tasks; the driver gets one model a round, of fixed
size.  Scores are calibrated (Platt) to the natural class balance by counts of
all calibration rows; the decision thresholds are chosen on these counts, one
per language with enough rows, else one for all.  Language, source and doc_id
are never inputs of a score.

Scoring is a pandas UDF over whole texts, in blocks of bounded size.

Defined results: null counts as empty; an empty text, or one without words,
has the score of no evidence (the bias alone); repeated rows and null doc_ids
are scored like any other (a null doc_id is never held out: its held_out is null);
texts that share a doc_id train once, the one of least hash; without labels of both classes every score is the
share of label 1 (0 without any label) and nothing is rejected; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, own_columns, restored, stored

BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 6)
EPOCHS = 6
BATCH = 32
BLOCK_WORDS = 1 << 20
MIN_LANG = 40  # calibration rows of a language with both classes, for a threshold of its own
CUT = 0.3
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_BLOCK_WORDS = 100_000
_UNIT = 1 << 24  # changes of the model are summed in this fraction
_BINS = 64  # calibration logits are counted in this fraction
_CACHE_LIMIT = 300_000
_CELLS = 1 << 27  # at most so many bits tell the labelled doc_ids from the others before the texts are shuffled


PARTS = 1 + len(PREFIXES)


class Vocabulary(dict):
    """Word -> row of ``table``, which holds the buckets of the word and its prefixes."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.table = np.zeros((1 << 12, PARTS), np.int32)  # row 0 is padding; room for more words behind the last one
        self.fresh: list[int] = []  # buckets of the words that are not in the table yet

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self) + 1
        self.fresh += [1 + zlib.crc32(p) % (BUCKETS - 1) for p in (word, *(b"^" + word[:n] for n in PREFIXES))]
        return at

    def read(self, texts) -> list[np.ndarray]:
        if len(self) > _CACHE_LIMIT:  # between batches, so rows in use never change
            self.forget()
        words = [(t or "").encode("utf-8").lower().translate(None, _PUNCT).split() for t in texts]
        found = [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in words]
        end = len(self) + 1
        if end > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((end, PARTS), np.int32)])
        made = np.array(self.fresh, np.int32).reshape(-1, PARTS)
        self.table[end - len(made) : end] = made
        self.fresh = []
        return [self.table[f] for f in found]


_WORDS = Vocabulary()


def buckets_of(texts) -> list[np.ndarray]:
    """Per text, the buckets of its words: (words, PARTS)."""
    return _WORDS.read(texts)


def _join(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one row with padding between them, and where each begins."""
    pad = np.zeros((max(WIDTHS), PARTS), np.int32)
    parts, starts, at = [], [], 0
    for t in texts:
        starts.append(at)
        parts += [t, pad]
        at += len(t) + len(pad)
    return np.concatenate([*parts, pad]), np.array(starts)


def _crossing(starts: np.ndarray, width: int) -> np.ndarray:
    """The windows that begin in the padding of a text and end in the next text."""
    return (starts[1:, None] - np.arange(1, width)[None, :]).ravel()


def _vectors(embed: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return sum(embed[ids[:, k]] for k in range(PARTS))


@dataclass
class Model:
    embed: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width * DIM, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = CUT

    def pooled(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The maxima of all filters (before the bias) per text."""
        n = len(ids) - max(WIDTHS)
        found, vectors = [], _vectors(self.embed, ids).astype(float)
        for width in WIDTHS:
            weight = self.filters[width].reshape(width, DIM, FILTERS)
            value = np.zeros((n, FILTERS))
            for j in range(width):
                value += vectors[j : j + n] @ weight[j]
            value[_crossing(starts, width)] = -np.inf
            found.append(np.maximum.reduceat(value, starts, axis=0))
        return np.concatenate(found, axis=1)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), np.log(max(self.constant, 1e-9) / max(1 - self.constant, 1e-9)))
        out, lo = [], 0
        while lo < len(texts):
            hi, words = lo, 0
            while hi < len(texts) and (hi == lo or words + len(texts[hi]) <= _BLOCK_WORDS):
                words += len(texts[hi])
                hi += 1
            bias = np.concatenate([self.bias[w] for w in WIDTHS])
            hidden = np.maximum(self.pooled(*_join(texts[lo:hi])) + bias, 0)
            out.append(hidden @ self.out + self.out_bias)
            lo = hi
        # rounded, so that a text's score does not depend on the texts scored with it
        return np.round(np.concatenate(out), 9) if out else np.zeros(0)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return self.calibrated(self.logits(texts))

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -60, 60)))


def _log_odds(one: np.ndarray, all_: np.ndarray, share: float) -> np.ndarray:
    """Per bucket, from the numbers of texts of label 1 and of all texts that hold it."""
    prior = 4.0
    rate = (one + prior * share) / (all_ + prior)
    return np.log(rate / (1 - rate)) - np.log(share / (1 - share))


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, value, grad):
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-6)


def _start(log_odds: np.ndarray, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    embed[:, 0] = log_odds
    embed[0] = 0
    filters, bias = {}, {}
    for width in WIDTHS:
        f = rng.normal(0, 0.2, (width, DIM, FILTERS))
        f[:, 0] = np.abs(f[:, 0]) + 0.3  # evidence starts positive
        filters[width] = f.reshape(width * DIM, FILTERS).astype(np.float32)
        bias[width] = np.full(FILTERS, -0.5, np.float32)
    return Model(embed, filters, bias, np.full(len(WIDTHS) * FILTERS, 0.3, np.float32), -1.0)


def _parameters(model: Model) -> np.ndarray:
    """All trained numbers in rows of DIM: the embeddings, then the others."""
    rest = [*(model.filters[w].ravel() for w in WIDTHS), *(model.bias[w] for w in WIDTHS), model.out, [model.out_bias]]
    rest = np.concatenate(rest).astype(np.float32)
    return np.concatenate([model.embed, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])


def _model(parameters: np.ndarray) -> Model:
    parameters = parameters.astype(np.float32)
    rest, at = parameters[BUCKETS:].ravel(), 0

    def take(n: int) -> np.ndarray:
        nonlocal at
        at += n
        return rest[at - n : at].copy()

    filters = {w: take(w * DIM * FILTERS).reshape(w * DIM, FILTERS) for w in WIDTHS}
    bias = {w: take(FILTERS) for w in WIDTHS}
    return Model(parameters[:BUCKETS].copy(), filters, bias, take(len(WIDTHS) * FILTERS), float(take(1)[0]))


def _fit(model: Model, texts: list[np.ndarray], labels: np.ndarray, share: float, seed: int) -> Model:
    """``model`` after one pass over the texts; ``share`` is the share of label 1 among all training rows."""
    rng = np.random.default_rng(seed)
    embed, filters, bias = model.embed, model.filters, model.bias
    adams = {w: (_Adam(filters[w].shape, 0.01), _Adam(FILTERS, 0.01)) for w in WIDTHS}
    adam_out, adam_bias, adam_embed = _Adam(len(model.out), 0.01), _Adam(1, 0.01), _Adam(embed.shape, 0.005)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    order = rng.permutation(len(texts))
    for lo in range(0, len(order), BATCH):
        part = order[lo : lo + BATCH]
        ids, starts = _join([texts[i] for i in part])
        n = len(ids) - max(WIDTHS)
        where, caught, vectors = {}, [], _vectors(embed, ids)
        for width in WIDTHS:
            f = filters[width].reshape(width, DIM, FILTERS)
            value = sum(vectors[j : j + n] @ f[j] for j in range(width))
            value[_crossing(starts, width)] = -np.inf
            top = np.maximum.reduceat(value, starts, axis=0)
            ends = np.append(starts[1:], n)
            at = np.array([s + value[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
            where[width] = at
            caught.append(top + bias[width])
        pre = np.concatenate(caught, axis=1)
        hidden = np.maximum(pre, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.out_bias, -30, 30)))
        error = ((p - labels[part]) * weight[part] / len(part)).astype(np.float32)
        back = error[:, None] * model.out[None, :] * (pre > 0)
        grad_embed = np.zeros_like(embed)
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            f = filters[width].reshape(width, DIM, FILTERS)
            grad_f = np.zeros_like(f)
            for j in range(width):
                hit = where[width] + j  # (texts, FILTERS)
                grad_f[j] = np.einsum("bfd,bf->df", vectors[hit], g)
                for part_of_word in range(PARTS):
                    np.add.at(grad_embed, ids[hit, part_of_word], g[:, :, None] * f[j].T[None])
            adams[width][0].step(filters[width], grad_f.reshape(width * DIM, FILTERS) + 1e-4 * filters[width])
            adams[width][1].step(bias[width], g.sum(axis=0))
        grad_embed[0] = 0
        adam_embed.step(embed, grad_embed)
        adam_out.step(model.out, hidden.T @ error + 1e-4 * model.out)
        step = np.array([model.out_bias], np.float32)
        adam_bias.step(step, np.array([error.sum()], np.float32))
        model.out_bias = float(step[0])
    return model


def _platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit; a prior keeps the scale near 1 even for separable rows."""
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    fit, centre = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    prior = np.array([0.05, 0.001]) * weights.sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        grad = x.T @ (weights * (p - labels)) + prior * (fit - centre)
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(prior)
        step = np.clip(np.linalg.solve(curve, grad), -0.5, 0.5)
        fit = fit - step
        fit[0] = min(max(fit[0], 0.2), 3.0)
        if np.abs(step).max() < 1e-8:
            break
    return float(fit[0]), float(fit[1])


_CUTS = np.linspace(0.05, 0.95, 91)


def _best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The threshold of highest F1; on a plateau its middle."""
    best, where = -1.0, [CUT]
    for cut in _CUTS:
        hit = scores >= cut
        true = (weights * (hit & (labels == 1))).sum()
        f1 = 2 * true / max((weights * hit).sum() + (weights * labels).sum(), 1e-9)
        if f1 > best + 1e-12:
            best, where = f1, [cut]
        elif f1 > best - 1e-12:
            where.append(cut)
    return float(np.median(where))


def _labelled(docs: DataFrame, marks: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose doc_id is one of the ``n`` in ``marks``, and a few others (those that share a bit with one)."""
    if docs.schema["doc_id"].dataType != marks.schema["doc_id"].dataType:
        return docs
    cells = min(_CELLS, max(1 << 15, 1 << (16 * n).bit_length()))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells))
    # numbered from 1; cells of a bucket meet before they are combined, so a task makes no bitmap that another makes too
    places = marks.select((cell + 1).alias("cell")).select("cell", F.bitmap_bucket_number("cell").alias("bucket")).repartition("bucket")
    found = places.groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).toArrow()
    table = np.zeros((cells >> 15, 1 << 12), np.uint8)
    for bucket, bits in zip(found["bucket"].to_pylist(), found["bits"].to_pylist(), strict=True):
        table[bucket - 1] = np.frombuffer(bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.ravel())  # 16 MB at most

    @F.pandas_udf("boolean")
    def marked(cells: pd.Series) -> pd.Series:
        at = cells.to_numpy()
        return pd.Series(shared.value[at >> 3] >> (at & 7) & 1 == 1)

    return docs.where(marked(cell))


def training_blocks(docs: DataFrame, labels: DataFrame, allowed: Column) -> tuple[DataFrame | None, float]:
    """Every labelled text where ``allowed`` holds, in blocks (held, slice, words, codes, lengths, labels, langs), and the
    share of label 1 among the labels.

    ``words`` are the buckets of a block's distinct words, ``codes`` the places of its texts' words in them (zlib)."""
    marks = labels.select("doc_id", F.col("toxic").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    marks = marks.where(allowed).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    marks = stored(marks, "labels")
    totals = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(sum(totals.values()), 1)
    if len(totals) < 2:
        return None, share
    docs = docs.where(F.col("doc_id").isNotNull() & allowed)
    # about six bytes a word, and as many labelled texts as labels
    sizes = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = 1 + (sizes["bytes"] or 0) * min(sum(totals.values()), sizes["rows"]) // (max(sizes["rows"], 1) * 6 * BLOCK_WORDS)
    # of texts that share a doc_id the one with the least hash, found before the join: one row a labelled doc_id and task is shuffled
    docs = _labelled(docs, marks, sum(totals.values()))
    found = docs.groupBy("doc_id").agg(F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("one"))
    found = found.select("doc_id", "one.*").join(marks, "doc_id")
    dealt = found.select(
        (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(3)) == 2).alias("held"),
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(blocks)).alias("slice"),
        F.xxhash64("doc_id", F.lit(1)).alias("order"), "doc_id", "y", "lang", "text",
    )
    dealt = dealt.repartition(blocks, "slice").sortWithinPartitions("held", "slice", "order", "doc_id")

    def coded(batches):
        texts, labels, langs, key = [], [], [], None

        def block():
            flat = np.concatenate([np.zeros((0, PARTS), np.int32), *texts])
            words, codes = np.unique(flat.astype("<u2").view("<u8").ravel(), return_inverse=True)
            return pd.DataFrame({
                "held": [key[0]], "slice": [key[1]], "words": [words.tobytes()], "codes": [zlib.compress(codes.astype("<u4").tobytes(), 1)],
                "lengths": [[len(t) for t in texts]], "labels": [labels], "langs": [langs],
            })

        for batch in batches:
            for held, slice_, y, lang, found in zip(
                batch["held"], batch["slice"], batch["y"], batch["lang"], buckets_of(batch["text"]), strict=True
            ):
                if (held, slice_) != key:
                    if texts:
                        yield block()
                    texts, labels, langs, key = [], [], [], (held, slice_)
                texts.append(found)
                labels.append(y)
                langs.append(lang)
        if texts:
            yield block()

    made = dealt.select("held", "slice", "y", "lang", "text").mapInPandas(
        coded,
        "held boolean, slice long, words binary, codes binary, lengths array<int>, labels array<int>, langs array<string>",
    )
    return stored(made, "training-blocks"), share


def _texts(words: bytes, codes: bytes, lengths) -> list[np.ndarray]:
    table = np.frombuffer(words, "<u2").reshape(-1, PARTS).astype(np.int32)
    flat = table[np.frombuffer(zlib.decompress(codes), "<u4")]
    return np.split(flat, np.cumsum(np.asarray(lengths, np.int64))[:-1])


def _counted(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, how many texts of label 1 and how many texts hold it."""

    def count(batches):
        one, all_ = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words, codes, lengths, labels in zip(batch["words"], batch["codes"], batch["lengths"], batch["labels"], strict=True):
                for text, y in zip(_texts(words, codes, lengths), labels, strict=True):
                    seen = np.unique(text)
                    all_[seen] += 1
                    one[seen] += y
        seen = np.flatnonzero(all_)
        yield pd.DataFrame({"bucket": seen, "ones": one[seen], "n": all_[seen]})

    counts = blocks.mapInPandas(count, "bucket long, ones long, n long").groupBy("bucket")
    counts = counts.agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).toArrow()
    one, all_ = np.zeros(BUCKETS), np.zeros(BUCKETS)
    one[counts["bucket"]], all_[counts["bucket"]] = counts["ones"], counts["n"]
    return one, all_


def _round(blocks: DataFrame, start: np.ndarray, share: float, seed: int) -> np.ndarray:
    """The parameters after each block has trained from ``start``: their changes averaged."""
    shared = blocks.sparkSession.sparkContext.broadcast(start)
    columns = [f"v{k}" for k in range(DIM)]

    def fit(batches):
        start = shared.value
        total, weight = np.zeros(start.shape, np.int64), np.zeros(len(start), np.int64)
        for batch in batches:
            for slice_, words, codes, lengths, labels in zip(
                batch["slice"], batch["words"], batch["codes"], batch["lengths"], batch["labels"], strict=True
            ):
                fitted = _fit(_model(start), _texts(words, codes, lengths), np.asarray(labels, float), share, [seed, int(slice_)])
                change = np.rint((_parameters(fitted) - start).astype(float) * _UNIT).astype(np.int64)
                total += change * len(labels)
                weight += change.any(axis=1) * len(labels)
        at = np.flatnonzero(weight)
        yield pd.DataFrame({"at": at, "weight": weight[at], **{c: total[at, k] for k, c in enumerate(columns)}})

    changes = blocks.mapInPandas(fit, ", ".join(f"{c} long" for c in ("at", "weight", *columns))).groupBy("at")
    changes = changes.agg(*[F.sum(c).alias(c) for c in ("weight", *columns)]).toArrow()
    shared.destroy()
    out = start.astype(float)
    sums = np.stack([changes[c].to_numpy() for c in columns], axis=1)
    out[changes["at"].to_numpy()] += sums / _UNIT / changes["weight"].to_numpy()[:, None]
    return out.astype(np.float32)


def _histogram(blocks: DataFrame, model: Model) -> DataFrame:
    """lang, y, bin (logit * _BINS, rounded) and the number of texts."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def place(batches):
        for batch in batches:
            for words, codes, lengths, labels, langs in zip(
                batch["words"], batch["codes"], batch["lengths"], batch["labels"], batch["langs"], strict=True
            ):
                logits = shared.value.logits(_texts(words, codes, lengths))
                bins = np.rint(np.clip(logits, -60, 60) * _BINS).astype(int)
                yield pd.DataFrame({"lang": list(langs), "y": list(labels), "bin": bins})

    made = blocks.mapInPandas(place, "lang string, y int, bin int")
    return stored(made.groupBy("lang", "y", "bin").agg(F.count("*").alias("n")), "logit-counts")


def train(blocks: DataFrame | None, share: float, seed: int = 7) -> Model:
    """A model from ``training_blocks``; ``share`` is the share of label 1 among all labelled rows."""
    found: dict[tuple[bool, int], int] = {}
    if blocks is not None:
        rows = blocks.select("held", F.explode("labels").alias("y")).groupBy("held", "y").agg(F.count("*").alias("n"))
        found = {(r["held"], r["y"]): r["n"] for r in rows.collect()}
    if len({y for _, y in found}) < 2:
        none = np.zeros(0)
        return Model(none, {}, {}, none, 0.0, constant=share, threshold=2.0)
    # where a part lacks a class, all rows stand for it
    fitting, held = (
        blocks.where(F.col("held") == part) if (part, 0) in found and (part, 1) in found else blocks for part in (False, True)
    )
    parts = (False,) if fitting is not blocks else (False, True)
    ones, all_ = (sum(found.get((part, y), 0) for part in parts for y in of) for of in ((1,), (0, 1)))
    balance = ones / all_
    parameters = _parameters(_start(_log_odds(*_counted(fitting), balance), seed))
    for epoch in range(EPOCHS):
        parameters = _round(fitting, parameters, balance, seed + epoch)
    model = _model(parameters)

    counts = _histogram(held, model)
    total = counts.groupBy("y", "bin").agg(F.sum("n").alias("n")).orderBy("y", "bin").toArrow()
    y, logits, n = (total[c].to_numpy().astype(float) for c in ("y", "bin", "n"))
    logits = logits / _BINS
    mean = (n * y).sum() / n.sum()
    by_class = np.array([(1 - share) / max(1 - mean, 1e-9), share / max(mean, 1e-9)])
    weights = n * by_class[y.astype(int)]
    model.scale, model.shift = _platt(logits, y, weights)

    def scores() -> np.ndarray:
        return model.calibrated(logits)

    # the decision cut of the calibrated score is moved to CUT, so that score >= CUT is the balanced decision
    cut = min(max(_best_cut(scores(), y, weights), 1e-3), 1 - 1e-3)
    model.shift += float(np.log(CUT / (1 - CUT)) - np.log(cut / (1 - cut)))
    scale, shift = model.scale, model.shift

    @F.pandas_udf("int")
    def passed(bins: pd.Series) -> pd.Series:
        p = 1 / (1 + np.exp(-np.clip(scale * bins.to_numpy() / _BINS + shift, -60, 60)))
        return pd.Series(np.searchsorted(_CUTS, p, "right"))

    langs = counts.where("lang is not null").groupBy("lang")
    langs = langs.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("ones"))
    langs = langs.where((F.col("n") >= MIN_LANG) & (F.col("ones") >= 10) & (F.col("ones") < F.col("n"))).select("lang")
    # at most one row a class and cut of a language
    own = counts.join(langs, "lang").withColumn("cut", passed("bin")).groupBy("lang", "y", "cut").agg(F.sum("n").alias("n"))
    own = own.toPandas()
    for lang, rows in own.groupby("lang"):
        at = np.concatenate([[0.0], _CUTS])[rows["cut"].to_numpy()]
        of = rows["y"].to_numpy()
        model.thresholds[lang] = _best_cut(at, of, rows["n"].to_numpy() * by_class[of])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with _score (a column of that name is replaced); all other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: BUCKETS * DIM and the filters

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(buckets_of(texts)), dtype=float)

    return docs.withColumn("_score", scored(F.col("text")))


def decide(scored: DataFrame, model: Model) -> DataFrame:
    """Adds _rejected: the score reaches the threshold of the document's language."""
    cut = F.lit(model.threshold)
    for lang, value in model.thresholds.items():
        cut = F.when(F.col("lang") == lang, F.lit(value)).otherwise(cut)
    return scored.withColumn("_rejected", F.col("_score") >= cut)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns, whatever these are called."""
    columns, names = numbered(docs)
    plain = docs.select(*columns, F.col("text"), F.col("lang"))
    judged = decide(score(plain, model), model)
    return restored(judged.where("not coalesce(_rejected, false)"), names)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    docs = own_columns(docs, "doc_id", "text", "lang")
    return train(*training_blocks(docs, labels, ~held_out()))
