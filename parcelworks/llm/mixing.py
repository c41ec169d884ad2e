"""Mixing sources to target weights by hierarchical budgeting.

A total token budget flows down a tree domain -> language -> source.  At each
node the budget is divided among the children by weight, but no child gets
more than it can supply (its tokens times ``epochs``).  What a child cannot
take goes to its siblings in proportion to their weights (water filling); a
node is itself limited by its subtree, so a shortage leaves a node for its
ancestors only when the siblings below it are full.

Each leaf then reads its documents in seeded epochs: epoch e orders them by
md5("seed|e|doc_id").  Whole epochs are taken first; in the last one the
prefix whose running token sum stays within the rest.  The running sum never
has a leaf in one task: the md5 order is cut into 16**``DIGITS`` buckets, the
bucket sums locate the cut, and only the bucket that holds it is ordered.

Tokens are runs without ASCII white space.

Defined results: a null or numberless source is in domain "other"; a null
language or source is a leaf of its own ("none"); a null or empty text has no
tokens and is taken with the prefix it falls in; null doc_ids have one place
in the order; ties go by doc_id; repeated rows are taken each for itself; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored

SEED = "mix-1"
EPOCHS = 2
DIGITS = 3
SHARE = 0.9  # budget as a share of the tokens at hand
DOMAINS = 4
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
OTHER_WEIGHT = 1
_LEAF = ["_mix_domain", "_mix_lang", "_mix_source"]


def _weight(name: Column, weights: dict[str, int]) -> Column:
    found = F.lit(OTHER_WEIGHT)
    for key, value in weights.items():
        found = F.when(name == key, F.lit(value)).otherwise(found)
    return found.cast("long")


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})", 1)
    named = F.concat(F.lit("domain"), (F.try_to_number(number, F.lit("999999999")).cast("long") % DOMAINS).cast("string"))
    return F.when(number != "", named).otherwise(F.lit("other"))


def _divide(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent columns, name, cap, w, budget of the parent) with ``share``, the child's budget."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))) / F.sum("w").over(onward)
    filled = children.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("w") * F.col("level"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parent))
    share = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * common)
    return filled.withColumn("share", share).drop("level", "full", "budget", "w", "cap")


def budgets(leaves: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Leaf budgets from (domain, lang, source, tokens); adds ``quota`` (tokens to take)."""
    d, lang, source = _LEAF
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).alias("budget"))
    level1 = leaves.groupBy(d).agg(F.sum("cap").alias("cap")).join(total).withColumn("w", _weight(F.col(d), DOMAIN_WEIGHTS))
    level1 = _divide(level1.withColumn("root", F.lit(0)), ["root"], d).select(d, F.col("share").alias("budget"))
    level2 = leaves.groupBy(d, lang).agg(F.sum("cap").alias("cap")).join(level1, d)
    level2 = _divide(level2.withColumn("w", _weight(F.col(lang), LANGUAGE_WEIGHTS)), [d], lang)
    level2 = level2.select(d, lang, F.col("share").alias("budget"))
    level3 = leaves.select(*_LEAF, "tokens", "cap").join(level2, [d, lang]).withColumn("w", F.lit(1).cast("long"))
    level3 = _divide(level3, [d, lang], source)
    return level3.withColumn("quota", F.floor("share").cast("long")).select(*_LEAF, "tokens", "quota")


def mix(
    docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED, tokens: Column | None = None, marks: bool = True
) -> DataFrame:
    """``docs`` rows, each once per epoch that takes it; ``marks`` adds _mix_domain, _mix_tokens and _mix_epoch."""
    columns, names = numbered(docs)
    doc_id = names["doc_id"]
    # rows without an id are spread by all that they hold; those without tokens too are alike in every way that counts
    known = F.concat(F.lit("row "), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).cast("string"))
    rows = docs.select(
        *columns,
        domain_of(F.col("source")).alias(_LEAF[0]),
        F.coalesce("lang", F.lit("none")).alias(_LEAF[1]),
        F.coalesce("source", F.lit("none")).alias(_LEAF[2]),
        (tokens_of(F.col("text")) if tokens is None else tokens).alias("_mix_tokens"),
        known.alias("_mix_known"),
    )
    own_id = F.coalesce(F.col(doc_id).cast("string"), F.when(F.col("_mix_tokens") > 0, F.col("_mix_known")))
    rows = rows.withColumn("_mix_id", own_id).drop("_mix_known")
    leaves = stored(rows.groupBy(*_LEAF).agg(F.sum("_mix_tokens").alias("tokens")), "leaves")
    plan = budgets(leaves, share, epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(0).cast("int")
    plan = plan.withColumn("_mix_whole", whole)
    plan = plan.withColumn("_mix_rest", F.col("quota") - F.col("_mix_whole") * F.col("tokens"))
    plan = stored(plan.select(*_LEAF, "_mix_whole", "_mix_rest"), "leaf-plan")

    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("_mix_whole").cast("string"), F.col("_mix_id")))
    rows = rows.join(plan, _LEAF).withColumn("_mix_key", key)
    rows = rows.withColumn("_mix_bucket", F.substring("_mix_key", 1, DIGITS))
    place = [*_LEAF, "_mix_bucket"]
    sums = rows.groupBy(*place, "_mix_rest").agg(F.sum("_mix_tokens").alias("_mix_sum"))
    running = F.sum("_mix_sum").over(Window.partitionBy(*_LEAF).orderBy("_mix_bucket"))
    sums = sums.withColumn("_mix_end", running).withColumn("_mix_before", F.col("_mix_end") - F.col("_mix_sum"))
    sums = stored(sums.select(*place, "_mix_before", "_mix_end"), "bucket-sums")
    rows = rows.join(sums, place)
    inside = rows.where(F.col("_mix_end") <= F.col("_mix_rest")).withColumn("_mix_more", F.lit(1))
    beyond = rows.where(F.col("_mix_before") > F.col("_mix_rest")).withColumn("_mix_more", F.lit(0))
    cut = rows.where((F.col("_mix_end") > F.col("_mix_rest")) & (F.col("_mix_before") <= F.col("_mix_rest")))
    order = Window.partitionBy(*place).orderBy("_mix_key", doc_id).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_mix_before") + F.sum("_mix_tokens").over(order)
    cut = cut.withColumn("_mix_more", (upto <= F.col("_mix_rest")).cast("int"))
    taken = inside.union(beyond).union(cut)
    taken = taken.where(F.col("_mix_whole") + F.col("_mix_more") > 0)
    every = F.explode(F.sequence(F.lit(0), F.col("_mix_whole") + F.col("_mix_more") - 1)).alias("_mix_epoch")
    shown = [F.col(own).alias(name) for name, own in names.items()]
    every_row = taken.select("*", every)
    return every_row.select(*shown, *([_LEAF[0], "_mix_tokens", "_mix_epoch"] if marks else []))


def _case(column: str, weights: dict[str, int]) -> str:
    return "CASE " + column + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {OTHER_WEIGHT} END"


def _divide_sql(children: str, parent: str, name: str) -> str:
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""
    SELECT *, CASE WHEN cap <= w * level THEN CAST(cap AS DOUBLE)
                   ELSE w * max(level) FILTER (WHERE NOT cap <= w * level) OVER ({part}) END AS share
    FROM (SELECT *, (budget - coalesce(sum(cap) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {name}
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(w) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {name}
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM ({children}))"""


SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
           CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})', 1) <> ''
                THEN 'domain' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})', 1) AS BIGINT) % {DOMAINS} AS VARCHAR)
                ELSE 'other' END AS domain,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS tokens
    FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS cap
         FROM d GROUP BY ALL),
one AS ({_divide_sql(f'''SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, {_case("domain", DOMAIN_WEIGHTS)} AS w,
    (SELECT coalesce(sum(tokens), 0) * CAST({SHARE} AS DOUBLE) FROM leaf) AS budget FROM leaf GROUP BY domain''', "", "domain")}),
two AS ({_divide_sql(f'''SELECT leaf.domain, lang, CAST(sum(leaf.cap) AS BIGINT) AS cap, {_case("lang", LANGUAGE_WEIGHTS)} AS w,
    any_value(one.share) AS budget FROM leaf JOIN one ON leaf.domain = one.domain GROUP BY leaf.domain, lang''', "domain", "lang")}),
three AS ({_divide_sql('''SELECT leaf.domain, leaf.lang, source, tokens, leaf.cap, 1 AS w, two.share AS budget
    FROM leaf JOIN two ON leaf.domain = two.domain AND leaf.lang = two.lang''', "domain, lang", "source")}),
plan AS (SELECT domain, lang, source, CAST(floor(share) AS BIGINT) AS quota, tokens,
                CASE WHEN tokens > 0 THEN CAST(floor(CAST(floor(share) AS BIGINT) / tokens) AS BIGINT) ELSE 0 END AS whole
         FROM three),
ordered AS (
    SELECT d.*, whole, quota - whole * plan.tokens AS rest,
           sum(d.tokens) OVER (PARTITION BY d.domain, d.lang, d.source
                               ORDER BY md5('{SEED}|' || CAST(whole AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR)), doc_id
                               ROWS UNBOUNDED PRECEDING) AS upto
    FROM d JOIN plan ON d.domain = plan.domain AND d.lang = plan.lang AND d.source = plan.source)
SELECT doc_id, domain, lang, source, tokens,
       CAST(unnest(range(0, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch
FROM ordered
"""
