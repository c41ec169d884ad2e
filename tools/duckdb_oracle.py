"""What every registered query must return, as DuckDB SQL over the star-schema test tables.

Layers, each a list of named queries:

1. raw: every mapped column as text, with the stand-in input's own rules
   (malformed text, faulty rows) applied to it;
2. staging: the text parsed by DuckDB's own casts;
3. facts: one row per order row and one per (order, seller) pair;
4. sums: explicit numerators and denominators for each grain (all orders,
   month, flag, state, seller), which every analysis divides.

Thresholds and fixed texts come from the library; sums and averages are
rounded the same way on both sides.
"""

from __future__ import annotations

from parcelworks.operators import quality as Q
from parcelworks.operators import report as R
from parcelworks.plans.registry import FAULTY_QUERIES, MONTH_MIN, SELLER_MIN, STATE_MIN
from parcelworks.sources import starschema as S

Layer = list[tuple[str, str]]

_SHIPPED = "(SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL)"


def _when(column: str, mapping: dict, default: str = "NULL") -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, str) else repr(v)}" for k, v in mapping.items())
    return f"CASE {column} {cases} ELSE {default} END"


_STATUS = _when("o_orderstatus", {k: f"'{v}'" for k, v in S.STATUS_BY_CODE.items()}, "o_orderstatus")
_ESTIMATE = _when("o_orderpriority", {k: f"o_orderdate + INTERVAL {d} DAY" for k, d in S.ESTIMATE_DAYS_BY_PRIORITY.items()})
_NATION = "LEFT JOIN nation ON n_nationkey = {}"

# table -> (source, [(column, value, how staging reads it)])
MAPPING = {
    "orders": (
        f"orders LEFT JOIN {_SHIPPED} ON l_orderkey = o_orderkey",
        [
            ("order_id", "o_orderkey", "text"),
            ("customer_id", "o_custkey", "text"),
            ("order_status", _STATUS, "lower"),
            ("order_purchase_timestamp", "o_orderdate", "time"),
            ("order_approved_at", "o_orderdate + INTERVAL 1 HOUR", "time"),
            ("order_delivered_carrier_date", "CASE WHEN o_orderstatus = 'F' THEN first_ship END", "time"),
            ("order_delivered_customer_date", "CASE WHEN o_orderstatus = 'F' THEN last_ship END", "time"),
            ("order_estimated_delivery_date", _ESTIMATE, "time"),
        ],
    ),
    "order_items": (
        "lineitem",
        [
            ("order_id", "l_orderkey", "text"),
            ("order_item_id", "l_linenumber", "int"),
            ("product_id", "l_partkey", "text"),
            ("seller_id", "l_suppkey", "text"),
            ("shipping_limit_date", "l_shipdate", "time"),
            ("price", "l_extendedprice", "number"),
            ("freight_value", "nullif(l_extendedprice * l_tax, 0)", "number"),
        ],
    ),
    "payments": (
        "orders",
        [
            ("order_id", "o_orderkey", "text"),
            ("payment_sequential", "1", "int"),
            ("payment_type", "o_orderpriority", "lower"),
            ("payment_installments", "1 + o_orderkey % 12", "int"),
            ("payment_value", "o_totalprice", "number"),
        ],
    ),
    "reviews": (
        "events",
        [
            ("review_id", "event_id", "text"),
            ("order_id", "(event_id >> 1) * 4", "text"),
            ("review_score", _when("event_type", S.SCORE_BY_EVENT), "int"),
            ("review_creation_date", "ts", "time"),
            ("review_answer_timestamp", "ts + INTERVAL 1 DAY", "time"),
        ],
    ),
    "customers": (
        f"customer {_NATION.format('c_nationkey')}",
        [
            ("customer_id", "c_custkey", "text"),
            ("customer_unique_id", "c_name", "text"),
            ("customer_zip_code_prefix", "c_nationkey", "int"),
            ("customer_city", "c_mktsegment", "lower"),
            ("customer_state", "n_name", "upper"),
        ],
    ),
    "products": (
        "part",
        [
            ("product_id", "p_partkey", "text"),
            ("product_category_name", "p_type", "lower or null"),
            *((f"product_{side}", "p_size", "number") for side in ("weight_g", "length_cm", "height_cm", "width_cm")),
        ],
    ),
    "sellers": (
        f"supplier {_NATION.format('s_nationkey')}",
        [
            ("seller_id", "s_suppkey", "text"),
            ("seller_zip_code_prefix", "s_nationkey", "int"),
            ("seller_city", "s_name", "lower"),
            ("seller_state", "n_name", "upper"),
        ],
    ),
}
_READ = {
    "text": "{0}",
    "lower": "lower(trim({0}))",
    "upper": "upper(trim({0}))",
    "lower or null": "nullif(lower(trim({0})), '')",
    "time": "TRY_CAST({0} AS TIMESTAMP)",
    "number": "TRY_CAST({0} AS DOUBLE)",
    "int": "CAST({0} AS INTEGER)",
}


def _staging(rules: dict[str, S.Rules]) -> Layer:
    layers = []
    for table, (source, columns) in MAPPING.items():
        own = rules.get(table, S.Rules("", (), ()))
        texts = ", ".join(f"CAST({value} AS VARCHAR) AS {name}" for name, value, _ in columns)
        layers.append((f"plain_{table}", f"SELECT {texts} FROM {source}"))
        shown = []
        for name, _, _ in columns:
            cases = " ".join(f"WHEN {own.hits(m, r)} THEN {value}" for m, r, column, value in own.changed if column == name)
            shown.append(f"CASE {cases} ELSE {name} END AS {name}" if cases else name)
        raw = f"SELECT {', '.join(shown)} FROM plain_{table}"
        for modulus, rest, values in own.added:
            more = ", ".join(f"{values[name]} AS {name}" if name in values else name for name, _, _ in columns)
            raw += f" UNION ALL SELECT {more} FROM plain_{table} WHERE {own.hits(modulus, rest)}"
        layers.append((f"raw_{table}", raw))
        read = ", ".join(f"{_READ[kind].format(name)} AS {name}" for name, _, kind in columns)
        layers.append((f"stg_{table}", f"SELECT {read} FROM raw_{table}"))
    return layers


_FACTS: Layer = [
    (
        "lines",
        "SELECT order_id, count(*) AS n, count(DISTINCT seller_id) AS sellers, "
        "sum(ifnull(price, 0)) + sum(ifnull(freight_value, 0)) AS worth FROM stg_order_items GROUP BY ALL",
    ),
    (
        "votes",
        "SELECT order_id, count(*) AS n, count(review_score) AS given, sum(review_score) AS points "
        "FROM stg_reviews GROUP BY ALL",
    ),
    (
        # comparisons and differences are null unless both of their dates are there
        "fct_orders",
        "SELECT o.*, ifnull(l.n, 0) AS item_count, ifnull(l.worth, 0) AS order_value, ifnull(l.sellers, 0) AS seller_count, "
        "v.points / nullif(v.given, 0) AS avg_review_score, ifnull(v.n, 0) AS review_count, "
        "CAST(o.order_delivered_customer_date > o.order_estimated_delivery_date AS INTEGER) AS late_delivery, "
        "datediff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) AS delivery_days "
        "FROM stg_orders o LEFT JOIN lines l ON l.order_id = o.order_id LEFT JOIN votes v ON v.order_id = o.order_id",
    ),
    ("pairs", "SELECT order_id, seller_id FROM stg_order_items GROUP BY ALL"),
    (
        "seller_orders",
        "SELECT seller_id, order_id, order_value, seller_count, late_delivery, avg_review_score, delivery_days, "
        "order_value / nullif(seller_count, 0) AS share FROM pairs JOIN fct_orders USING (order_id)",
    ),
]


def _sums(source: str, key: str | None, where: str = "true") -> str:
    """Numerators (sums) and denominators (counts) of every ratio at one grain."""
    both = ", ".join(
        f"sum({x}) AS {short}_sum, count({x}) AS {short}_n"
        for short, x in (("late", "late_delivery"), ("score", "avg_review_score"), ("days", "delivery_days"), ("worth", "order_value"))
    )
    low = "count(*) FILTER (WHERE avg_review_score <= 2) AS low_n"
    keyed = f"{key} AS grain, " if key else ""
    return f"SELECT {keyed}count(*) AS n, {both}, {low} FROM {source} WHERE {where}" + (f" GROUP BY {key}" if key else "")


def _mean(short: str) -> str:
    return f"{short}_sum / nullif({short}_n, 0)"


def _round(value: str, name: str, digits: int = 6) -> str:
    return f"round({value}, {digits}) AS {name}"


_LATE, _SCORE, _DAYS = _mean("late"), _mean("score"), _mean("days")
_JUDGED = "late_delivery IS NOT NULL"

_SUMS: Layer = [
    ("overall", _sums("fct_orders", None)),
    ("span", "SELECT min(order_purchase_timestamp) AS first, max(order_purchase_timestamp) AS last FROM fct_orders"),
    ("months", _sums("fct_orders", "date_trunc('month', order_purchase_timestamp)::TIMESTAMP", f"{_JUDGED} AND order_purchase_timestamp IS NOT NULL")),
    ("flags", _sums("fct_orders", "late_delivery", f"{_JUDGED} AND avg_review_score IS NOT NULL")),
    ("states", _sums("fct_orders JOIN stg_customers USING (customer_id)", "customer_state", _JUDGED)),
    ("sellers", _sums("seller_orders", "seller_id", _JUDGED)),
    ("rated_months", f"SELECT grain AS month, n, {_LATE} AS rate FROM months WHERE n >= {MONTH_MIN}"),
    ("rated_states", f"SELECT grain AS state, n, {_LATE} AS rate, {_SCORE} AS score, {_DAYS} AS days FROM states WHERE n >= {STATE_MIN}"),
    ("rated_sellers", f"SELECT grain AS seller, n, {_LATE} AS rate, {_SCORE} AS score FROM sellers WHERE n >= {SELLER_MIN}"),
    (
        "spread",
        "SELECT count(*) AS n, min(rate) AS low, quantile_cont(rate, 0.5) AS middle, quantile_cont(rate, 0.9) AS p90, "
        "max(rate) AS high, corr(rate, score) AS relation FROM rated_sellers",
    ),
    ("watched", "SELECT *, row_number() OVER (ORDER BY rate DESC, n DESC, seller) AS place FROM rated_sellers QUALIFY place <= 5"),
    (
        "groups",
        "SELECT " + ", ".join(
            f"max({value}) FILTER (WHERE grain = {flag}) AS {name}_{flag}"
            for flag in (0, 1) for name, value in (("score", _SCORE), ("low", "low_n / n"))
        ) + " FROM flags",
    ),
]


def _base(rules: dict[str, S.Rules], altered: bool = False) -> str:
    layers = _staging(rules) + _FACTS + _SUMS
    if altered:  # the checked facts, as the stand-in rule leaves them
        flag = f"CASE WHEN {S.ALTERED_FACTS} THEN CASE WHEN late_delivery IS NULL THEN 1 END ELSE late_delivery END"
        layers.append(("checked", f"SELECT * REPLACE ({flag} AS late_delivery) FROM fct_orders"))
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in layers) + "\n"


def _repeated(table: str) -> str:
    return f"SELECT count(*) FROM (SELECT order_id FROM {table} GROUP BY order_id HAVING count(*) > 1)"


def _unmatched(table: str) -> str:
    return f"SELECT count(*) FROM {table} t WHERE NOT EXISTS (FROM stg_orders o WHERE o.order_id = t.order_id)"


def _hits(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def check_sql(facts: str = "fct_orders") -> dict[str, str]:
    """The count of each quality check, in report order."""
    statuses = ", ".join(f"'{s}'" for s in Q.ORDER_STATUSES)
    dated = "order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL"
    counts = (
        _repeated("stg_orders"),
        _unmatched("stg_order_items"),
        _unmatched("stg_reviews"),
        _hits("stg_order_items", "least(price, freight_value) < 0"),
        _hits("stg_orders", f"order_status NOT IN ({statuses})"),
        _hits("stg_orders", "order_purchase_timestamp > order_delivered_customer_date"),
        _repeated(facts),
        _hits("stg_reviews", "review_score NOT BETWEEN 1 AND 5"),
        _hits(facts, f"(late_delivery IS NOT NULL) <> ({dated})"),
    )
    return dict(zip(Q.CHECK_NAMES, counts, strict=True))


def _fixed(value: str, digits: int) -> str:
    return f"printf('%.{digits}f', {value})"


def _percent(value: str) -> str:
    return f"printf('%.1f', 100.0 * ({value})) || '%'"


def _thousands(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _or_missing(text: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL OR isnan(CAST({value} AS DOUBLE)) THEN 'not available' ELSE {text} END"


def _joined(*parts: str) -> str:
    return " || ".join(parts)


def _text(words: str) -> str:
    return "'" + words.replace("'", "''") + "'"


def _review_gap() -> str:
    gap, low = "score_0 - score_1", "low_1 - low_0"
    sentence = _joined(
        _text("among reviewed eligible orders, late deliveries averaged "), _fixed("score_1", 3), _text(" stars versus "),
        _fixed("score_0", 3), _text(" on time, a "), _fixed(gap, 3), _text("-point gap. The 1-2 star review rate was "),
        _fixed(f"({low}) * 100", 1), _text(" percentage points higher in the late group."),
    )
    missing = _text("Late and on-time reviews cannot be compared: one of the groups has none.")
    return "SELECT " + ", ".join([
        _round("score_0", "on_time_average_review_score"), _round("score_1", "late_average_review_score"),
        _round("low_0", "on_time_low_review_rate"), _round("low_1", "late_low_review_rate"),
        _round(gap, "review_gap"), _round(low, "low_review_gap"),
        f"CASE WHEN score_0 IS NULL OR score_1 IS NULL THEN {missing} ELSE {sentence} END AS finding",
    ]) + " FROM groups"


def _peak_month() -> str:
    sentence = _joined(
        "strftime(month, '%B %Y')",
        _text(f" had the highest late-delivery rate among months with at least {MONTH_MIN:,} eligible orders: "),
        _percent("rate"), _text(" across "), _thousands("n"), _text(" orders."),
    )
    return (
        "SELECT c.stable_months, month AS peak_month, n AS peak_eligible_orders, "
        f"{_round('rate', 'peak_late_delivery_rate')}, strftime(month, '%B %Y') AS peak_month_label, "
        f"ifnull({sentence}, {_text('No month met the minimum volume threshold.')}) AS finding "
        "FROM (SELECT count(*) AS stable_months FROM rated_months) c "
        "LEFT JOIN (FROM rated_months ORDER BY rate DESC, month LIMIT 1) ON true"
    )


def _state_spread() -> str:
    sentence = _joined(
        _text(f"Among states with at least {STATE_MIN:,} eligible orders, "), "h.state", _text(" had a "), _percent("h.rate"),
        _text(" late rate versus "), _percent("l.rate"), _text(" in "), "l.state", _text(", a descriptive gap of "),
        _percent("h.rate - l.rate"), _text("."),
    )
    return (
        "SELECT c.qualified_states, h.state AS highest_state, l.state AS lowest_state, "
        f"{_round('h.rate', 'highest_late_delivery_rate')}, {_round('l.rate', 'lowest_late_delivery_rate')}, "
        f"{_round('h.rate - l.rate', 'late_rate_spread')}, "
        f"ifnull({sentence}, {_text('No state met the minimum volume threshold.')}) AS finding "
        "FROM (SELECT count(*) AS qualified_states FROM rated_states) c "
        "LEFT JOIN (FROM rated_states ORDER BY rate DESC, state LIMIT 1) h ON true "
        "LEFT JOIN (FROM rated_states ORDER BY rate, state LIMIT 1) l ON true"
    )


def _seller_finding() -> str:
    relation = f"CASE WHEN relation IS NULL OR isnan(relation) THEN 'nan' ELSE {_fixed('relation', 3)} END"
    sentence = _joined(
        _text("Across "), _thousands("n"), _text(f" sellers with at least {SELLER_MIN} eligible orders, the median late rate was "),
        _percent("middle"), _text(", the 90th percentile was "), _percent("p90"),
        _text(", and the seller-level late-rate/review correlation was "), relation, _text("."),
    )
    small = _text("The fixture is too small for a seller distribution.")
    return (
        f"SELECT n AS eligible_sellers, {_round('middle', 'median_late_delivery_rate')}, {_round('p90', 'p90_late_delivery_rate')}, "
        f"{_round('relation', 'late_review_correlation')}, middle IS NOT NULL AS has_distribution, "
        f"CASE WHEN middle IS NULL THEN {small} ELSE {sentence} END AS finding FROM spread"
    )


def _metric_list() -> str:
    worth = "ifnull(worth_sum, 0)"
    shown = (
        ("n", "n", _thousands("n")),
        ("late_n", "late_n", _thousands("late_n")),
        (worth, f"round({worth}, 2)", f"format('{{:,.2f}}', CAST({worth} AS DOUBLE))"),
        (_LATE, f"round({_LATE}, 6)", _percent(_LATE)),
        (_SCORE, f"round({_SCORE}, 6)", _fixed(_SCORE, 3)),
        (_DAYS, f"round({_DAYS}, 6)", _fixed(_DAYS, 3)),
    )
    return " UNION ALL ".join(
        f"SELECT {place} AS position, '{key}' AS metric, {_text(label)} AS label, CAST({rounded} AS DOUBLE) AS value, "
        f"{_or_missing(text, value)} AS display FROM overall"
        for place, ((key, label), (value, rounded, text)) in enumerate(zip(R.METRIC_LABELS, shown, strict=True), 1)
    )


def _state_rows() -> str:
    return (
        "SELECT CAST(row_number() OVER (ORDER BY n DESC, state) AS INTEGER) AS position, state AS customer_state, "
        f"n AS eligible_orders, {_round('rate', 'late_delivery_rate')}, {_round('score', 'average_review_score')}, "
        f"{_round('days', 'average_delivery_days')}, {_thousands('n')} AS eligible_orders_display, "
        f"{_percent('rate')} AS late_delivery_rate_display, {_fixed('score', 3)} AS average_review_display, "
        f"{_fixed('days', 2)} AS average_delivery_days_display FROM rated_states QUALIFY position <= 12"
    )


_STAGED = {f"stg_{table}": f"SELECT * FROM stg_{table}" for table in MAPPING}
_NAMED = "late_delivery_rate", "average_review_score", "average_delivery_days"
_SELLER_COLUMNS = f"seller AS seller_id, n AS eligible_orders, {_round('rate', _NAMED[0])}, {_round('score', _NAMED[1])}"

_PLAIN = _STAGED | {
    "item_rollup": f"SELECT order_id, n AS item_count, {_round('worth', 'order_value', 4)}, sellers AS seller_count FROM lines",
    "review_rollup": f"SELECT order_id, {_round('points / nullif(given, 0)', 'avg_review_score')}, n AS review_count FROM votes",
    "fct_orders": "SELECT * REPLACE (round(order_value, 4) AS order_value, round(avg_review_score, 6) AS avg_review_score) FROM fct_orders",
    "order_seller_bridge": "SELECT order_id, seller_id FROM pairs",
    "order_seller_facts":
        "SELECT * EXCLUDE (share, delivery_days) REPLACE (round(order_value, 4) AS order_value, "
        "round(avg_review_score, 6) AS avg_review_score) FROM seller_orders",
    "fct_seller_performance":
        f"SELECT seller_id, count(*) AS order_count, {_round('sum(share)', 'allocated_gross_item_freight_value', 2)}, "
        f"{_round('sum(late_delivery) / nullif(count(late_delivery), 0)', _NAMED[0])}, "
        f"{_round('sum(avg_review_score) / nullif(count(avg_review_score), 0)', _NAMED[1])} FROM seller_orders GROUP BY seller_id",
    "analysis_metrics":
        f"SELECT n AS orders, late_n AS late_delivery_eligible_orders, {_round('ifnull(worth_sum, 0)', 'gross_item_freight_value', 2)}, "
        f"{_round(_LATE, _NAMED[0])}, {_round(_SCORE, _NAMED[1])}, {_round(_DAYS, _NAMED[2])}, "
        "first AS purchase_start, last AS purchase_end FROM overall, span",
    "analysis_monthly":
        f"SELECT grain AS month, n AS eligible_orders, {_round(_LATE, _NAMED[0])}, {_round(_SCORE, _NAMED[1])} FROM months",
    "analysis_delivery_review":
        f"SELECT grain AS late_delivery, n AS reviewed_orders, {_round(_SCORE, _NAMED[1])}, {_round('low_n / n', 'low_review_rate')}, "
        f"{_round(_DAYS, _NAMED[2])}, {_round(_mean('worth'), 'average_order_value', 2)} FROM flags",
    "analysis_states":
        f"SELECT grain AS customer_state, n AS eligible_orders, {_round(_LATE, _NAMED[0])}, {_round(_SCORE, _NAMED[1])}, "
        f"{_round(_DAYS, _NAMED[2])} FROM states",
    "analysis_seller_base": f"SELECT {_SELLER_COLUMNS} FROM rated_sellers",
    "analysis_seller_summary":
        "SELECT n AS eligible_sellers, " + ", ".join(
            _round(x, f"{name}_late_delivery_rate") for x, name in (("low", "min"), ("middle", "median"), ("p90", "p90"), ("high", "max"))
        ) + f", {_round('relation', 'late_review_correlation')} FROM spread",
    "analysis_seller_watchlist": f"SELECT {_SELLER_COLUMNS} FROM watched",
    "report_review_gap": _review_gap(),
    "report_peak_month": _peak_month(),
    "report_state_spread": _state_spread(),
    "report_state_table": _state_rows(),
    "report_watchlist":
        f"SELECT CAST(place AS INTEGER) AS position, {_SELLER_COLUMNS}, left(seller, 8) || '...' AS seller_id_display, "
        f"{_thousands('n')} AS eligible_orders_display, {_percent('rate')} AS late_delivery_rate_display, "
        f"{_or_missing(_fixed('score', 3), 'score')} AS average_review_display FROM watched",
    "report_monthly_series":
        f"SELECT month, strftime(month, '%Y-%m') AS month_label, n AS eligible_orders, {_round('rate', _NAMED[0])} FROM rated_months",
    "report_review_series":
        "SELECT late_delivery, label, " + _round("ifnull(CASE late_delivery WHEN 0 THEN score_0 ELSE score_1 END, 0)", _NAMED[1])
        + " FROM groups, (VALUES " + ", ".join(f"({flag}, '{label}')" for flag, label in R.REVIEW_SERIES_POINTS)
        + ") points(late_delivery, label) WHERE EXISTS (FROM flags)",
    "report_metric_list": _metric_list(),
    "report_coverage":
        "SELECT first AS purchase_start, last AS purchase_end, "
        "ifnull(strftime(first, '%Y-%m-%d') || ' to ' || strftime(last, '%Y-%m-%d'), 'not available') AS coverage FROM span",
    "report_state_series":
        "SELECT CAST(row_number() OVER (ORDER BY rate, state) AS INTEGER) AS position, state AS customer_state, "
        f"{_round('rate', _NAMED[0])}, {_percent('rate')} AS late_delivery_rate_display "
        "FROM (FROM rated_states ORDER BY rate DESC, state DESC LIMIT 12)",
    "report_seller_finding": _seller_finding(),
}


def _quality() -> dict[str, str]:
    counts = check_sql("checked")
    singles = {f"quality_q{place}": f"SELECT '{name}' AS name, ({sql}) AS failures" for place, (name, sql) in enumerate(counts.items(), 1)}
    rows = " UNION ALL ".join(f"SELECT '{name}' AS name, ({sql}) AS failures, {_text(Q.CHECK_DETAILS[name])} AS detail" for name, sql in counts.items())
    return singles | {"quality_report": f"SELECT name, failures = 0 AS passed, failures, detail FROM ({rows})"}


def _fingerprints(folder: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS logical_table, '{t}.parquet' AS filename, size AS bytes, sha256(content) AS sha256 "
        f"FROM read_blob('{folder}/{t}.parquet')"
        for t in S.STAR_TABLES
    )


def oracle_sql(folder: str) -> dict[str, str]:
    """query name -> SQL; ``folder`` holds the table files (only their digests need it)."""
    plain, malformed, faulty = _base({}), _base(S.MALFORMED), _base(S.FAULTY, altered=True)
    found = {name: plain + sql for name, sql in _PLAIN.items()}
    found |= {f"{name}_from_text": malformed + sql for name, sql in _STAGED.items()}
    found |= {name: faulty + sql for name, sql in _quality().items()}
    assert set(_quality()) == set(FAULTY_QUERIES)
    return found | {"snapshot_fingerprints": _fingerprints(folder.rstrip("/"))}
