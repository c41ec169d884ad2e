"""Fuzzy line dedup: MinHash candidates, exact Jaccard, union-find, one line kept per component.

A line is the text between line feeds, white space trimmed; blank lines are
left alone.  Equal lines are one class (MD5 of the trimmed bytes).  Of each
distinct line the set of distinct ``GRAM``-byte shingles (the whole line if it
is shorter) gets a MinHash signature of BANDS * ROWS functions; two lines are
candidates when a band agrees (recall 1 - (1 - 0.8**ROWS)**BANDS = 99.7 % at
Jaccard 0.8, more above).  Candidates are verified by the exact Jaccard
similarity of their shingle sets (at least 0.8); verified links are joined into
components by distributed union-find.  Of all occurrences of a component's
lines the first (least doc_id, null last, then text hash and line number) is kept.

Defined results: null text counts as empty; a document without lines keeps
none and loses none; blank lines stay; of repeated rows (equal doc_id and text)
one keeps the lines; a very long line is one line; an empty table gives no rows;
extra columns are ignored.

No copy of the texts is stored: places of lines carry their document's id and
text hash, and the texts are read again for the candidates and for the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, stored
from .linking import distinct_lists, link_components, profiles_of

GRAM = 10
BANDS, ROWS = 8, 3
PERCENT = 80
_BLOCK = 1 << 16  # bytes of lines hashed at once, few enough for a core's cache
_BLANK = b" \t\x0b\f\r"
_BLANKS = _BLANK.decode()
_PLACES = 1 << 16  # lines a batch returns at once
_DOCUMENT = ["none", "doc", "tid"]
_ID = ["high", "low"]
_KEYS = [f"key_{band}" for band in range(BANDS)]
_RNG = np.random.default_rng(17)
_ODD = _RNG.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SQUARE, _FOURTH = (np.uint64(pow(int(_BASE), n, 1 << 64)) for n in (2, 4))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def grams_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all lines, and where each line's begin."""
    size = np.array([max(len(x), GRAM) for x in lines])
    data = np.frombuffer(b"".join(x if len(x) >= GRAM else x.ljust(GRAM, b"\0") for x in lines), np.uint8).astype(np.uint64)
    # the polynomial of GRAM = 10 bytes from those of 2, 4 and 8
    two = data[:-1] * _BASE + data[1:]
    four = two[:-2] * _SQUARE + two[2:]
    eight = four[:-4] * _FOURTH + four[4:]
    value = eight[: len(data) - GRAM + 1] * _SQUARE + two[8:]
    ends = np.cumsum(size)
    inside = np.ones(len(data), bool)
    for j in range(1, GRAM):
        inside[ends - j] = False
    counts = size - GRAM + 1
    return _mix(value[inside[: len(value)]]), np.cumsum(counts) - counts


def band_keys(lines: list[bytes]) -> np.ndarray:
    """(lines, BANDS) keys; equal keys of a band mean equal MinHash values in its rows."""
    grams, starts = grams_of(lines)
    keys = np.zeros((len(lines), BANDS), np.uint64)
    made = np.empty_like(grams)
    for band in range(BANDS):
        for row in range(ROWS):
            np.multiply(grams, _ODD[band * ROWS + row], out=made)
            least = np.minimum.reduceat(made, starts) >> np.uint64(16)
            keys[:, band] = _mix(keys[:, band] * _BASE + least)
        keys[:, band] = _mix(keys[:, band] + np.uint64(band + 1))
    return keys


def gram_sets(lines: list[str]) -> Iterator[np.ndarray]:
    """Of each line, the distinct hashes of its shingles."""
    if len(lines):
        grams, starts = grams_of([line.encode("utf-8") for line in lines])
        for found in np.split(grams, starts[1:]):
            found.sort()
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]


def shingles(line: str) -> set[bytes]:
    raw = line.encode("utf-8")
    if len(raw) < GRAM:
        raw = raw.ljust(GRAM, b"\0")
    # all shingles are GRAM bytes long, so the zero bytes that numpy leaves out at an end tell none from another
    return set(np.ndarray(len(raw) - GRAM + 1, f"S{GRAM}", raw, strides=1).tolist())


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with what tells them apart, free of nulls: none (no doc_id), doc, tid; and text."""
    rows = own_columns(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    doc = F.coalesce("doc_id", F.lit("0").cast(rows.schema["doc_id"].dataType))
    return rows.select(F.col("doc_id").isNull().alias("none"), doc.alias("doc"), F.xxhash64("text").alias("tid"), "text")


def _places(rows: DataFrame) -> DataFrame:
    """Every line that is not blank: its document and number, MD5 (in two halves) and band keys."""

    def signed(lines: list[bytes]) -> np.ndarray:
        made, part, held = [np.zeros((0, BANDS), np.uint64)], [], 0
        for number, line in enumerate(lines, 1):
            part.append(line)
            held += len(line)
            if held >= _BLOCK or number == len(lines):
                made.append(band_keys(part))
                part, held = [], 0
        return np.concatenate(made).view(np.int64)

    def lines_of(texts):
        for at, text in enumerate(texts):
            for number, raw in enumerate(text.as_py().split(b"\n")):
                line = raw.strip(_BLANK)
                if line:
                    yield at, number, line

    def sign(batches):
        for batch in batches:
            rest = lines_of(batch["text"])
            while part := list(islice(rest, _PLACES)):
                owner, numbers, lines = zip(*part, strict=True)
                found: dict[bytes, int] = {}
                which = np.array([found.setdefault(line, len(found)) for line in lines])
                halves = np.frombuffer(b"".join(hashlib.md5(line).digest() for line in found), np.int64).reshape(-1, 2)
                keys = signed(list(found))
                own = batch.select(_DOCUMENT).take(pa.array(owner, pa.int32()))
                longs = [pa.array(np.ascontiguousarray(c[which])) for c in (*halves.T, *keys.T)]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(numbers, pa.int32()), *longs], names=names)

    names = [*_DOCUMENT, "line_no", *_ID, *_KEYS]
    kind = rows.schema["doc"].dataType.simpleString()
    longs = ", ".join(f"{name} long" for name in (*_ID, *_KEYS))
    schema = f"none boolean, doc {kind}, tid long, line_no int, {longs}"
    return rows.select(*_DOCUMENT, F.col("text").cast("binary").alias("text")).mapInArrow(sign, schema)


def _contents(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, content): the text of each line of ``lines`` (number and one of its places)."""
    wanted = lines.groupBy(*_DOCUMENT).agg(F.collect_list(F.struct("line_no", "number")).alias("wanted"))
    found = rows.join(stored(wanted, "wanted-lines"), _DOCUMENT)

    def taken(parts):
        return F.transform("wanted", lambda w: F.struct(w["number"].alias("id"), F.btrim(F.get(parts, w["line_no"]), F.lit(_BLANKS)).alias("content")))

    # the array around the parts has each text split once, not once a line; rows that repeat doc_id and text give equal contents
    each = F.flatten(F.transform(F.array(F.split("text", "\n")), taken))
    return found.select(F.inline(each)).groupBy("id").agg(F.first("content").alias("content"))


def duplicate_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents: none, doc, tid, text; lines to remove: none, doc, tid, gone).

    Rows that repeat doc_id and text share their ``gone``; it is that of the one which keeps the lines."""
    rows = _numbered(docs)
    places = stored(_places(rows), "line-places", hashes=[*_ID, *_KEYS])
    lines = places.groupBy(*_ID).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (*_DOCUMENT, "line_no", *_KEYS)])
    lines = stored(lines.select(F.monotonically_increasing_id().alias("number"), "*"), "lines", hashes=["number", *_ID, *_KEYS])
    made = lines.select(F.explode(F.array(*_KEYS)).alias("key"), F.col("number").alias("id"))
    counted = made.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    listed = stored(counted.where("n > 1").select("key", "id"), "line-lists")
    involved = listed.select(F.col("id").alias("number")).distinct()
    contents = stored(_contents(rows, lines.drop(*_KEYS).join(involved, "number")), "line-texts")
    profiles = stored(profiles_of(contents, gram_sets), "line-profiles")
    postings = listed.join(distinct_lists(listed), "key").join(profiles.select("id", "size"), "id")
    roots, _ = link_components(stored(postings, "line-postings"), contents, profiles, gram_sets, shingles, PERCENT)
    # only lines that occur again or have a link can lose an occurrence
    grouped = lines.select("number", *_ID, "n").join(roots, F.col("number") == F.col("node"), "left")
    grouped = grouped.where("n > 1 or root is not null").select(*_ID, F.coalesce("root", "number").alias("group"))
    grouped = places.select(*_DOCUMENT, "line_no", *_ID).join(stored(grouped, "line-groups"), _ID).drop(*_ID)
    grouped = stored(grouped, "grouped-places")
    place = F.struct(*_DOCUMENT, "line_no")
    firsts = stored(grouped.groupBy("group").agg(F.min(place).alias("first")), "line-firsts")
    removed = grouped.join(firsts, "group").where(place != F.col("first"))
    return rows, stored(removed.groupBy(*_DOCUMENT).agg(F.collect_set("line_no").alias("gone")), "lines-removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines (not blank), n_removed, text (what is left)."""
    rows, removed = duplicate_lines(docs)
    # of rows that repeat doc_id and text, the second and later ones keep no line
    copy = F.row_number().over(Window.partitionBy(*_DOCUMENT).orderBy("tid"))
    found = rows.join(removed, _DOCUMENT, "left").withColumn("copy", copy)
    parts = F.split("text", "\n")

    def written(line):
        return F.ltrim(line, F.lit(_BLANKS)) != ""

    rest = F.filter(parts, lambda line, at: ~F.array_contains("gone", at))
    blank = F.filter(parts, lambda line: ~written(line))
    n_lines = F.size(F.filter(parts, written)).cast("long")
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return found.select(
        F.when(~F.col("none"), F.col("doc")).alias("doc_id"),
        n_lines.alias("n_lines"),
        F.when(F.col("copy") > 1, n_lines).otherwise(n_removed).alias("n_removed"),
        F.when(F.col("copy") > 1, F.array_join(blank, "\n")).otherwise(left).alias("text"),
    )
