"""Every column of the fingerprint query against brute force outside Spark."""

import collections
import hashlib

import xxhash

from parcelworks.llm import winnowing

from .test_operators import ROWS, SCHEMA

K, WINDOW, LIMIT = winnowing.K, winnowing.WINDOW, (1 << 31) - 1


def words_of(text):
    body = text.strip(winnowing.SPACE)
    if not body:
        return []
    found = []
    for word in "".join(" " if c in winnowing.SPACE else c for c in body).split(" "):
        if len(word.encode()) <= 32:
            found.append(word)
        else:
            found += [word[at : at + 16] for at in range(0, len(word), 16)]
            if len(word) % 16 == 0:
                found.append("")  # the cut after the last code point
    return found


def fingerprint(text):
    words = words_of(text)
    if not words:
        return []
    grams = []
    for at in range(max(len(words) - K, 0) + 1):
        value = 42
        for word in words[at : at + K]:
            value = xxhash.xxh64_intdigest(word.encode(), value)
        grams.append((value >> 32, LIMIT - at))
    chosen = [min(grams[at : at + WINDOW]) for at in range(max(len(grams) - WINDOW, 0) + 1)]
    return [(h << 31) | place for h, place in dict.fromkeys(chosen)]


def likeness(x, y):
    x, y = ({g >> 31 for g in f} for f in (x, y))
    return len(x & y) / len(x | y) if x | y else 1.0


def signed(gram):
    return gram - (1 << 64) if gram >= 1 << 63 else gram


def shown(grams):
    return "[" + ", ".join(str(signed(g)) for g in grams) + "]"


def test_every_column(spark):
    more = ["x" * 48, "one", "one two", "a  b\tc\n\nd  e f g h i j k l m n o", "word " * 40, "日本語" * 12 + " tail of words here", "é" * 17]
    rows = ROWS + [(900 + k, text, "en", "web", 1, "k", 7, 0, 0) for k, text in enumerate(more)]
    order = sorted(
        {(d, t or "") for d, t, *_ in rows},
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()), reverse=True,
    )
    after = {r: order[(i + 1) % len(order)][1] for i, r in enumerate(order)}
    want = collections.Counter()
    for d, t, *_ in rows:
        t = t or ""
        third, following = len(t) // 3, after[(d, t)]
        edited = t[: len(t) - third] + following[:third]
        own, other, theirs = fingerprint(t), fingerprint(edited), fingerprint(following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[(d, len(t), sha, shown(own), shown(other), round(likeness(own, other), 9), round(likeness(own, theirs), 9))] += 1
    found = winnowing.fingerprint_edits(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = collections.Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found
    )
    assert got == want
