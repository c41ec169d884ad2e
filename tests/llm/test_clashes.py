"""Columns of the caller that bear the operators' own names, and rows without ids."""

import pytest
from pyspark.sql import functions as F

from parcelworks.llm import exact_dedup, mixing, ngram_join, toxicity

OWN = ["n", "kept", "id", "sha", "hash", "root", "tid", "text_sha", "text_hash", "_score", "_rejected", "_id", "_sha", "_c0", "_mix_domain",
       "_mix_epoch", "_mix_tokens", "_mix_key", "key", "number", "least", "size", "band", "members"]


@pytest.fixture(scope="module")
def docs(spark):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(0, "same text"), (1, "SAME text"), (2, words), (3, words + " more"), (None, "alone"), (None, "alone"), (None, None), (7, ""), (7, words)]
    frame = spark.createDataFrame([(d, t, "en", "src1", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.concat(F.lit(f"{name} "), F.coalesce("text", F.lit(""))).alias(name) for name in OWN])


def check(left, docs, n):
    rows = left.collect()
    assert left.columns == docs.columns and len(rows) == n
    assert all(r[name] == f"{name} {r.text or ''}" for r in rows for name in OWN)


def test_names(spark, docs):
    check(exact_dedup.drop_duplicates(docs), docs, 5)
    check(ngram_join.one_per_component(docs, k=5, percent=80), docs, 5)
    filled = docs.where("text <> ''")  # texts without tokens cost no budget and may come again
    check(mixing.mix(filled, share=1.0, epochs=1, marks=False), docs, filled.count())
    marks = spark.createDataFrame([(0, 1), (2, 0), (3, 0), (7, 1)], "doc_id long, toxic int")
    check(toxicity.accepted(docs, toxicity.fit_on(docs, marks.where("doc_id > 99"))), docs, docs.count())


def test_texts_that_share_an_id_train_alike(spark):
    rows = [(d, f"text {d} {k} " + ("bad " if d % 2 else "good ") * 5, "en") for d in range(40) for k in range(3)]
    marks = spark.createDataFrame([(d, d % 2) for d in range(40)], "doc_id long, toxic int")
    scores = []
    for parts in (1, 7):
        frame = spark.createDataFrame(rows[:: 1 if parts == 1 else -1], "doc_id long, text string, lang string").repartition(parts)
        model = toxicity.fit_on(frame, marks)
        scores.append(sorted((r.doc_id, r.text, r._score) for r in toxicity.score(frame, model).collect()))
    assert scores[0] == scores[1]
