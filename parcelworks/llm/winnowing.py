"""Document fingerprints by winnowing (DataFrame functions only).

Every gram of k consecutive words is hashed; of every ``window`` consecutive
hashes the least is selected, the rightmost one on ties, and its position (the
number of words before it) is kept.  Two texts that share a run of at least
``k + window - 1`` words select a common hash inside it (the match guarantee),
at positions that differ by the run's offset.  Words end at each white space
character; a word of over 32 bytes is cut after every 16 code points, so text
without spaces has grams too.
A selected gram is one BIGINT: 32 hash bits above 31 bits of
``MAX_POS - position``, so the plain minimum of a window is its rightmost
least hash.

Defined results: null counts as empty; a text without words selects nothing;
fewer than k words are one gram; fewer grams than a window are one window.
Two empty fingerprints have likeness 1, one empty fingerprint 0.

``successors`` orders documents by doc_id (descending, null last, ties by the
text's SHA-256, descending) and pairs each with the next one, the last with
the first; rows that repeat doc_id and text share one place.  The order is
made by a range partitioning of ids; each partition's last document is joined
to the first of the following partition through one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, stored

K, WINDOW = 3, 6
MAX_POS = (1 << 31) - 1
SPACE = " \t\n\x0b\f\r"
LONG_WORD = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (an expression used in a lambda would be repeated)."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    for other in SPACE[1:]:
        text = F.replace(text, F.lit(other), F.lit(" "))
    is_long = lambda word: F.octet_length(word) > LONG_WORD

    def cut(words: Column) -> Column:
        pieces = F.transform(words, lambda w: F.when(is_long(w), F.split(w, r"(?<=\G.{16})")).otherwise(F.array(w)))
        return F.when(F.exists(words, is_long), F.flatten(pieces)).otherwise(words)

    return _let(F.split(text, " "), cut)


def select_grams(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The selected grams, array<bigint>, in the order of their positions."""

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - k, F.lit(0))

        def packed(at: Column) -> Column:
            # get() is null beyond the end and a hash skips nulls: fewer than k words are one gram
            value = F.shiftrightunsigned(F.xxhash64(*[F.get(words, at + j) for j in range(k)]), 32)
            return F.shiftleft(value, 31).bitwiseOR((F.lit(MAX_POS) - at).cast("long"))

        return F.transform(F.sequence(F.lit(0), last), packed)

    def least(grams: Column) -> Column:
        last = F.greatest(F.size(grams) - window, F.lit(0))
        return F.array_distinct(
            F.transform(F.sequence(F.lit(0), last), lambda at: F.least(*[F.get(grams, at + j) for j in range(window)]))
        )

    none = F.array().cast("array<bigint>")
    body = F.btrim(text, F.lit(SPACE))
    found = _let(_words(body), lambda words: _let(hashes(words), least))
    return F.when(body != "", found).otherwise(none)


def hash_set(grams: Column) -> Column:
    """The distinct 32-bit hashes of selected grams, array<int>."""
    return F.array_distinct(F.transform(grams, lambda g: (F.shiftright(g, 31) - F.lit(1 << 31)).cast("int")))


def positions(grams: Column) -> Column:
    """The positions of selected grams, in words."""
    return F.transform(grams, lambda g: F.lit(MAX_POS) - g.bitwiseAND(F.lit(MAX_POS).cast("long")))


def as_text(grams: Column) -> Column:
    """The selected grams, hash and position, as one string of numbers."""
    return grams.cast("string")


def likeness(x: Column, y: Column) -> Column:
    """Jaccard likeness of two hash sets."""
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return own_columns(docs, "doc_id", "text").select(
        "doc_id", F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text")
    )


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, sha, n_chars, next_id, next_sha; one row per distinct (doc_id, text)."""
    keys = _documents(docs).select("doc_id", "sha", F.char_length("text").alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("sha").desc()]
    spine = stored(
        keys.repartitionByRange(*order).select(F.spark_partition_id().alias("part"), "doc_id", "sha", "n_chars"), "spine"
    )
    here = F.struct("doc_id", "sha")  # nulls are smallest in a struct, so the maximum comes first
    firsts = spine.groupBy("part").agg(F.max(here).alias("first"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(Window.orderBy("part")), F.first("first").over(every)).alias("after"),
    )
    inside = F.lead(here).over(Window.partitionBy("part").orderBy(*order))
    nexts = spine.withColumn("next", inside).join(following, "part")
    nexts = nexts.withColumn("next", F.coalesce("next", "after"))
    return nexts.select(
        "doc_id", "sha", "n_chars", F.col("next.doc_id").alias("next_id"), F.col("next.sha").alias("next_sha")
    )


def fingerprint_edits(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by as many
    first ones of the next document.
    """
    # both joins below read the same, unrenamed columns by the same key: Spark shuffles the texts once
    rows = _documents(docs)
    links = stored(successors(docs), "successors").withColumnsRenamed({"doc_id": "_id", "sha": "_sha"})
    third = F.floor(F.col("n_chars") / 3).cast("int")
    theirs = _documents(docs)
    if links.count() != rows.count():  # successors are distinct; every copy of a document gives the same head
        theirs = theirs.dropDuplicates(["doc_id", "sha"])
    heads = links.join(theirs, links["next_id"].eqNullSafe(theirs["doc_id"]) & (links["next_sha"] == theirs["sha"])).select(
        "_id",
        "_sha",
        "n_chars",
        F.substring("text", F.lit(1), third).alias("head"),
        hash_set(select_grams(F.col("text"), k, window)).alias("next_set"),
    )
    both = rows.join(heads, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["sha"] == F.col("_sha")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - third), F.col("head"))
    made = both.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_set")
    made = made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        select_grams(F.col("text"), k, window).alias("own"),
        select_grams(F.col("edited"), k, window).alias("other"),
        "next_set",
    )
    made = made.select("*", hash_set(F.col("own")).alias("own_set"))
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        _let(hash_set(F.col("other")), lambda other: likeness(F.col("own_set"), other)).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )
