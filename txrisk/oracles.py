"""The registered queries once more, as SQL for an independent engine (DuckDB).

Used only to check results. The texts are written from the rules of the data model, not
derived from the Spark plans, and run over the whole test tables.
"""

from txrisk import schema as S

_REQUIRED = ", ".join(S.REQUIRED)
_ALL = f"{_REQUIRED}, {S.LABEL}"

RAW = """
merchant_of AS (SELECT l_orderkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice) AS BIGINT) AS c,
    o_orderpriority, c_mktsegment, c_acctbal, c_nationkey, s_suppkey, s_nationkey, n_name,
    o_orderkey % 50 = 7 AS planted, o_orderkey % 14 = 0 AS abroad
  FROM orders JOIN merchant_of ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = suppkey JOIN nation ON n_nationkey = s_nationkey),
mapped AS (
  SELECT k,
    'TXN' || lpad(CAST(k AS VARCHAR), CAST(greatest(9, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS transaction_id,
    CAST(d AS TIMESTAMP) + to_seconds(k * 7919 % 86400) AS transaction_date,
    'CUST' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_id,
    'MERCH' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(5, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS merchant_id,
    'CAT_' || CAST(s_suppkey % 12 AS VARCHAR) AS merchant_category,
    CASE WHEN k % 333 = 5 THEN -(CAST(c AS DOUBLE) / CAST(100 AS DOUBLE))
      WHEN planted THEN CAST(c AS DOUBLE) / CAST(100 AS DOUBLE) + CAST(6000 AS DOUBLE)
      ELSE CAST(c AS DOUBLE) / CAST(100 AS DOUBLE) END AS transaction_amount,
    CASE WHEN k % 100 <> 17 THEN 'CITY_' || CAST(s_nationkey AS VARCHAR) END AS city,
    n_name AS state, o_orderpriority AS payment_method, c_mktsegment AS card_type,
    CAST(16 + o_custkey % 90 AS BIGINT) AS customer_age,
    CASE WHEN k % 100 <> 43 THEN c_acctbal END AS customer_income,
    CAST(CASE WHEN planted THEN 1 + k % 4 ELSE (k * 13 + o_custkey) % 24 END AS BIGINT) AS transaction_hour,
    CAST(CASE WHEN planted OR abroad THEN 1 ELSE 0 END AS BIGINT) AS is_international,
    CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
    CAST(greatest((c * (50 + k * 31 % 101)) // 100 + (k * 17 % 2001 - 1000), 100) AS DOUBLE)
      / CAST(100 AS DOUBLE) AS previous_transaction_amount,
    CAST(abs(c_nationkey - s_nationkey) + CASE WHEN planted THEN 2000 + k % 10000
      WHEN abroad THEN 500 + k % 7500 ELSE 0 END AS DOUBLE) AS distance_from_home_km,
    CAST(CASE WHEN planted THEN 1 ELSE 0 END AS BIGINT) AS ground_truth_unusual
  FROM base),
raw AS (SELECT * EXCLUDE (k) FROM mapped UNION ALL SELECT * EXCLUDE (k) FROM mapped WHERE k % 200 = 9)"""

DISTINCT = f"""{RAW},
uniq AS (SELECT {_REQUIRED}, min({S.LABEL}) AS {S.LABEL} FROM raw GROUP BY ALL)"""

# De-duplicated, positive, city filled: what all cleaning steps after that build on.
KEPT = f"""{DISTINCT},
kept AS (SELECT * REPLACE (coalesce(city, '{S.UNKNOWN_CITY}') AS city) FROM uniq WHERE transaction_amount > 0)"""

_CLIP = (
    f"CASE WHEN customer_age < {S.AGE_MIN} THEN {S.AGE_MIN} WHEN customer_age > {S.AGE_MAX} "
    f"THEN {S.AGE_MAX} ELSE customer_age END"
)

FILLED = f"""{KEPT},
bracketed AS (SELECT *, CAST(floor(customer_age / 10.0) * 10 AS BIGINT) AS b FROM kept),
medians AS (SELECT b, median(customer_income) AS m FROM bracketed WHERE b IS NOT NULL GROUP BY b),
by_bracket AS (SELECT t.* EXCLUDE (b) REPLACE (coalesce(customer_income, m) AS customer_income)
  FROM bracketed t LEFT JOIN medians USING (b)),
filled AS (SELECT * REPLACE (coalesce(customer_income,
  (SELECT median(customer_income) FROM by_bracket)) AS customer_income) FROM by_bracket)"""

CLEANED = f"""{FILLED},
cleaned AS (SELECT * REPLACE (CAST({_CLIP} AS BIGINT) AS customer_age) FROM filled)"""

# The report table: cleaned but for income, which no report reads. The label serves as
# the flag and the negative distance in steps of cents as the score.
LEDGER = f"""{KEPT},
transactions AS (
  SELECT * REPLACE (CAST({_CLIP} AS BIGINT) AS customer_age), {S.LABEL} AS is_anomaly,
    -(distance_from_home_km * 100 + transaction_amount) AS anomaly_score
  FROM kept)"""

ISO = "strftime(transaction_date, '%Y-%m-%d %H:%M:%S')"
CENTS = "CAST(round(transaction_amount * 100) AS BIGINT)"
TOTAL = f"CAST(CAST(sum({CENTS}) AS BIGINT) AS DOUBLE) / CAST(100 AS DOUBLE)"


def mean(cents=CENTS):
    s, n = f"CAST(sum({cents}) AS BIGINT)", f"count({cents})"
    return (
        f"CAST(sign({s}) * ((2 * abs({s}) + {n}) // nullif(2 * {n}, 0)) AS DOUBLE) / CAST(100 AS DOUBLE)"
    )


def percentage(num, den, places):
    scale = 10**places
    part = f"(2 * CAST({num} AS BIGINT) * {100 * scale} + {den}) // nullif(2 * {den}, 0)"
    return f"coalesce(CAST({part} AS DOUBLE) / CAST({scale} AS DOUBLE), CAST(0 AS DOUBLE))"


def round_half_up(x, places):
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"floor(({x}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale}"


def word(key, seed, index):
    part = f"substr(md5('{seed}|' || {key}), {1 + 13 * index}, 13)"
    return f"CAST('0x' || {part} AS BIGINT)"


def chosen(key, seed, share):
    return f"{word(key, seed, 0)} < {int(share * 2**52)}"


def over(ctes, select):
    return f"WITH {ctes}\n{select}"


# ---------------------------------------------------------------- quality and cleaning

_COLUMNS = [*S.REQUIRED, S.LABEL]
_MISSING = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _COLUMNS)

PROFILE = f"""{DISTINCT},
counts AS (SELECT count(*) AS total_records, {len(_COLUMNS)} AS total_columns,
    {_MISSING} AS total_missing_cells, count(*) - (SELECT count(*) FROM uniq) AS duplicate_rows,
    count(*) FILTER (WHERE transaction_amount <= 0) AS invalid_amount_count,
    count(*) FILTER (WHERE customer_age < 18 OR customer_age > 100) AS invalid_age_count FROM raw),
profile AS (SELECT CAST(total_records AS BIGINT) AS total_records, CAST(total_columns AS BIGINT) AS total_columns,
    CAST(total_missing_cells AS BIGINT) AS total_missing_cells, CAST(duplicate_rows AS BIGINT) AS duplicate_rows,
    CAST(invalid_amount_count AS BIGINT) AS invalid_amount_count,
    CAST(invalid_age_count AS BIGINT) AS invalid_age_count,
    {percentage("total_missing_cells", "(total_records * total_columns)", 3)} AS missing_pct,
    total_missing_cells = 0 AND duplicate_rows = 0 AND invalid_amount_count = 0
      AND invalid_age_count = 0 AS is_valid_overall FROM counts),
report AS (SELECT *, (SELECT count(*) FROM uniq WHERE transaction_amount > 0) AS total_records_after_cleaning,
    total_records - (SELECT count(*) FROM uniq WHERE transaction_amount > 0) AS records_removed FROM profile)"""

_MISSING_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM raw"
    for c in _COLUMNS
)

_ACTIONS = {
    "duplicate_rows_removed": "duplicate_rows",
    "invalid_amounts_removed": "invalid_amount_count",
    "records_before_cleaning": "total_records",
    "records_after_cleaning": "total_records_after_cleaning",
    "total_records_removed": "records_removed",
}

_TEXT_DATE = f"* REPLACE ({ISO} AS transaction_date)"

_F = S.FEATURES
_FEATURE_LIST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _F)

SQL = {
    "scan_csv": over(RAW, f"SELECT {_TEXT_DATE} FROM raw"),
    "iso_dates": over(RAW, f"SELECT transaction_id, {ISO} AS transaction_date FROM raw"),
    "table_roundtrip": over(LEDGER, f"SELECT {_TEXT_DATE} FROM transactions"),
    "load_or_build": over(RAW, f"SELECT {_TEXT_DATE} FROM raw"),
    "dq_profile": over(PROFILE, "SELECT * FROM profile"),
    "dq_missing_by_column": over(
        RAW, f"SELECT * FROM ({_MISSING_LONG}) WHERE missing_count > 0"
    ),
    "dq_removed": over(
        PROFILE, "SELECT total_records, total_records_after_cleaning, records_removed FROM report"
    ),
    "dq_actions": over(
        PROFILE,
        " UNION ALL ".join(
            f"SELECT '{a}' AS action, CAST({c} AS BIGINT) AS row_count FROM report"
            for a, c in _ACTIONS.items()
        ),
    ),
    "clean_dedup": over(DISTINCT, f"SELECT {_TEXT_DATE} FROM uniq"),
    "clean_positive": over(
        RAW, "SELECT transaction_id, transaction_amount FROM raw WHERE transaction_amount > 0"
    ),
    "clean_fill_city": over(
        RAW, "SELECT transaction_id, coalesce(city, 'Unknown') AS city FROM raw"
    ),
    "clean_income": over(FILLED, "SELECT transaction_id, customer_age, customer_income FROM filled"),
    "clean_income_fallback": over(
        FILLED.replace(
            "FROM kept)",
            "FROM (SELECT * REPLACE (CASE WHEN customer_age < 30 OR customer_age >= 40 "
            "THEN customer_income END AS customer_income) FROM kept))",
        ),
        "SELECT transaction_id, customer_age, customer_income FROM filled",
    ),
    "clean_clip_age": over(
        RAW, f"SELECT transaction_id, CAST({_CLIP} AS BIGINT) AS customer_age FROM raw"
    ),
    "clean_full": over(CLEANED, f"SELECT {_TEXT_DATE} FROM cleaned"),
    # ------------------------------------------------------------------ anomaly scoring
    "features": over(CLEANED, f"SELECT transaction_id, {_FEATURE_LIST} FROM cleaned"),
    "impute_median": over(
        RAW,
        "SELECT "
        + ", ".join(
            f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM raw)) AS {c}" for c in _F
        )
        + " FROM raw",
    ),
    "standardize": over(
        f"{CLEANED}, m AS (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _F)
        + " FROM cleaned)",
        "SELECT transaction_id, "
        + ", ".join(
            f"{round_half_up(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END', 6)} AS {c}"
            for c in _F
        )
        + " FROM cleaned, m",
    ),
}



def _hashed(key):
    """Rows of ``keyed`` (a row for each row to draw) as drawn by each tree."""
    return f"""
share AS (SELECT least(CAST(1.5 AS DOUBLE) * {S.SAMPLE_SIZE} / count(*), 1) AS p FROM keyed),
words AS (SELECT *, {word(key, S.SEED, 0)} AS u FROM keyed),
started AS (SELECT *, CASE WHEN p >= 1 THEN 0 ELSE CAST(floor(
  ln(1 - u / CAST({2**52} AS DOUBLE)) / ln(1 - p)) AS BIGINT) END AS first FROM words, share),
tried AS (SELECT *, {word(key + " || '|' || CAST(tree AS VARCHAR)", f"{S.SEED}|trees", 0)} AS h FROM started, range({S.N_TREES}) AS r(tree)
  WHERE tree >= first),
hashed AS (SELECT *, CASE WHEN tree = first THEN CAST(floor(CAST(h AS DOUBLE) * p) AS BIGINT) ELSE h END
  AS rank_hash FROM tried WHERE tree = first OR h < CAST(floor(p * CAST({2**52} AS DOUBLE)) AS BIGINT))"""


_DRAWN = f"keyed AS (SELECT transaction_id FROM kept), {_hashed('transaction_id')}"
SQL["forest_samples"] = over(
    f"{KEPT}, {_DRAWN}",
    "SELECT tree, rank_hash, transaction_id FROM hashed QUALIFY row_number() "
    f"OVER (PARTITION BY tree ORDER BY rank_hash, transaction_id) <= {S.SAMPLE_SIZE}",
)

# ------------------------------------------------- the whole forest, level by level

_N = len(_F)
DEPTH = 8  # of trees over samples of 256 rows


def _scaled(column):
    mean, std = (f"CAST(printf('%.9g', {f}({column})) AS DOUBLE)" for f in ("avg", "stddev_pop"))
    return f"{mean} AS m_{column}, CASE WHEN {std} = 0 THEN 1 ELSE {std} END AS s_{column}"


def _level(depth):
    """Nodes of one level from the rows that reached it, and the rows of the next."""
    ranges = ", ".join(f"min(x[{i + 1}]), max(x[{i + 1}])" for i in range(_N))
    # the features that vary, as a text of one digit each
    varying = ", ".join(f"CASE WHEN r[{2 * i + 1}] < r[{2 * i + 2}] THEN '{i}' END" for i in range(_N))
    node_key = "CAST(tree AS VARCHAR) || '|' || CAST(node AS VARCHAR)"
    return f"""
seen{depth} AS (SELECT tree, node, count(*) AS size, [{ranges}] AS r FROM at{depth} GROUP BY tree, node),
open{depth} AS (SELECT *, concat({varying}) AS v FROM seen{depth}),
drawn{depth} AS (SELECT *, {depth} < {DEPTH} AND size > 1 AND v <> '' AS inner_node,
  CAST(nullif(substr(v, CAST({word(node_key, S.SEED, 0)} % greatest(length(v), 1) AS INTEGER) + 1, 1), '')
    AS INTEGER) AS f,
  CAST({word(node_key, S.SEED, 1)} AS DOUBLE) / CAST({2**52} AS DOUBLE) AS u FROM open{depth}),
cut{depth} AS (SELECT *, r[2 * f + 1] AS lo, r[2 * f + 2] AS hi,
  r[2 * f + 1] + u * (r[2 * f + 2] - r[2 * f + 1]) AS point FROM drawn{depth}),
nodes{depth} AS MATERIALIZED (SELECT tree, node, CASE WHEN inner_node THEN f ELSE -1 END AS feature,
  CASE WHEN NOT inner_node THEN 0 WHEN point >= hi THEN lo ELSE point END AS split,
  size, {depth} AS depth FROM cut{depth}),
at{depth + 1} AS (SELECT a.tree, a.x, 2 * a.node + CASE WHEN a.x[n.feature + 1] <= n.split THEN 1 ELSE 2 END AS node
  FROM at{depth} a JOIN nodes{depth} n ON n.tree = a.tree AND n.node = a.node WHERE n.feature >= 0)"""


_TREES = f"""
scaling AS (SELECT {", ".join(_scaled(c) for c in _F)} FROM cleaned),
prepared AS (SELECT cleaned.*, [{", ".join(f"({c} - m_{c}) / s_{c}" for c in _F)}] AS x FROM cleaned, scaling),
picked AS (SELECT tree, transaction_id FROM hashed QUALIFY row_number()
  OVER (PARTITION BY tree ORDER BY rank_hash, transaction_id) <= {S.SAMPLE_SIZE}),
at0 AS MATERIALIZED (SELECT tree, 0 AS node, x FROM picked JOIN prepared USING (transaction_id)),
{",".join(_level(d) for d in range(DEPTH + 1))},
nodes AS MATERIALIZED ({" UNION ALL ".join(f"SELECT * FROM nodes{d}" for d in range(DEPTH + 1))})"""
FOREST = f"{CLEANED}, {_DRAWN},{_TREES}"


def _key_part(column):
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"


# Rows drawn by a hash of all the columns they are distinct in, before any is changed.
_KEYED = f"""keyed AS (SELECT transaction_id, md5({" || ".join(_key_part(c) for c in S.REQUIRED)}) AS row_key
  FROM uniq WHERE transaction_amount > 0)"""
KEYED_FOREST = f"{CLEANED}, {_KEYED}, {_hashed('row_key')},{_TREES}"

_NODES = """SELECT CAST(tree AS BIGINT) AS tree, CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature,
  CAST(split AS DOUBLE) AS split, CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * node + 1 END AS BIGINT) AS "left",
  CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * node + 2 END AS BIGINT) AS "right",
  CAST(size AS BIGINT) AS size, CAST(depth AS BIGINT) AS depth FROM nodes"""
SQL["forest_nodes"] = over(FOREST, _NODES)
SQL["risk_nodes"] = over(KEYED_FOREST, _NODES)


def _path_constant(n):
    return (
        f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE CAST(2 AS DOUBLE) * (ln(CAST({n} - 1 AS DOUBLE)) "
        f"+ CAST(0.5772156649015329 AS DOUBLE)) - CAST(2 AS DOUBLE) * ({n} - 1) / {n} END"
    )


def _step(depth):
    return f"""
step{depth + 1} AS (SELECT s.transaction_id, s.tree, s.x,
  CASE WHEN n.feature < 0 THEN s.node WHEN s.x[n.feature + 1] <= n.split THEN 2 * s.node + 1
  ELSE 2 * s.node + 2 END AS node FROM step{depth} s JOIN nodes n ON n.tree = s.tree AND n.node = s.node)"""


_WALK = f"""
step0 AS (SELECT transaction_id, CAST(tree AS BIGINT) AS tree, x, 0 AS node
  FROM prepared, range({S.N_TREES}) AS r(tree)),
{",".join(_step(d) for d in range(DEPTH))},
raw_scores AS MATERIALIZED (SELECT transaction_id, -pow(CAST(2 AS DOUBLE), -(sum(n.depth + {_path_constant("n.size")})
  / ({S.N_TREES} * ({_path_constant(str(S.SAMPLE_SIZE))})))) AS raw
  FROM step{DEPTH} s JOIN nodes n ON n.tree = s.tree AND n.node = s.node GROUP BY transaction_id),
cut AS (SELECT quantile_cont(raw, {S.CONTAMINATION}) AS t FROM raw_scores),
scored AS (SELECT cleaned.*, raw - t AS anomaly_score, CAST(CASE WHEN raw - t < 0 THEN 1 ELSE 0 END AS BIGINT)
  AS is_anomaly FROM cleaned JOIN raw_scores USING (transaction_id), cut)"""
SCORED = f"{FOREST},{_WALK}"

_SCORES = over(
    SCORED,
    f"SELECT transaction_id, {round_half_up('anomaly_score', 8)} AS anomaly_score, is_anomaly FROM scored",
)
SQL["score_forest"] = _SCORES
SQL["save_load_score"] = _SCORES
SQL["score_stream"] = _SCORES

# A fixed forest of three trees of depth two, as (feature, split) tests and leaf paths.
_C = {n: f"CAST({v!r} AS DOUBLE)" for n, v in {2: 1.0, 3: 1.207392357589623}.items()}
FIXED_CASES = [
    "CASE WHEN transaction_amount <= 3000 THEN CASE WHEN distance_from_home_km <= 100 "
    f"THEN 2 + {_C[3]} ELSE 2 + {_C[2]} END ELSE CASE WHEN transaction_amount <= 7000 "
    f"THEN 2 + {_C[2]} ELSE 2 END END",
    "CASE WHEN distance_from_home_km <= 1500 THEN CASE WHEN customer_income <= 0 "
    f"THEN 2 + {_C[2]} ELSE 2 + {_C[3]} END ELSE CASE WHEN transaction_hour <= 4 "
    f"THEN 2 ELSE 2 + {_C[2]} END END",
    f"CASE WHEN is_international <= 0.5 THEN 1 + {_C[3]} ELSE CASE WHEN "
    f"previous_transaction_amount <= 2500 THEN 2 + {_C[2]} ELSE 2 + {_C[2]} END END",
]
FIXED_SIZE = 8


def fixed_forest_sql(normal: float) -> str:
    depth = " + ".join(f"({c})" for c in FIXED_CASES)
    raw = f"-pow(CAST(2 AS DOUBLE), -(({depth}) / (3 * CAST({normal!r} AS DOUBLE))))"
    return over(CLEANED, f"SELECT transaction_id, {round_half_up(raw, 9)} AS raw_score FROM cleaned")


_THRESHOLD = f"quantile_cont(anomaly_score, {S.CONTAMINATION})"
SQL["contamination_threshold"] = over(
    LEDGER, f"SELECT {round_half_up(_THRESHOLD, 6)} AS threshold FROM transactions"
)
SQL["contamination_flag"] = over(
    f"{LEDGER}, cut AS (SELECT {_THRESHOLD} AS t FROM transactions)",
    f"SELECT transaction_id, {round_half_up('anomaly_score - t', 6)} AS anomaly_score, "
    "CAST(CASE WHEN anomaly_score - t < 0 THEN 1 ELSE 0 END AS BIGINT) AS is_anomaly "
    "FROM transactions, cut",
)
def _summary(table):
    return f"""SELECT count(*) AS total_transactions, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
  {percentage("sum(is_anomaly)", "count(*)", 3)} AS anomaly_rate_pct,
  {round_half_up("avg(anomaly_score)", 4)} AS avg_anomaly_score,
  {mean(f"CASE WHEN is_anomaly = 0 THEN {CENTS} END")} AS avg_amount_normal,
  coalesce({mean(f"CASE WHEN is_anomaly = 1 THEN {CENTS} END")}, 0) AS avg_amount_anomaly
FROM {table}"""


SQL["anomaly_summary"] = over(LEDGER, _summary("transactions"))
SQL["forest_summary"] = over(SCORED, _summary("scored"))
SQL["forest_recall"] = over(
    SCORED,
    "SELECT count(*) FILTER (WHERE ground_truth_unusual = 1 AND is_anomaly = 1) AS caught, "
    "CAST(sum(ground_truth_unusual) AS BIGINT) AS planted FROM scored",
)
SQL["planted_recall"] = over(
    f"{LEDGER}, cut AS (SELECT {_THRESHOLD} AS t FROM transactions)",
    "SELECT count(*) FILTER (WHERE ground_truth_unusual = 1 AND anomaly_score < t) AS caught, "
    "CAST(sum(ground_truth_unusual) AS BIGINT) AS planted FROM transactions, cut",
)

# ------------------------------------------------------------------------------ reports

_KEYED = {
    "monthly_transaction_value": (
        "strftime(transaction_date, '%Y-%m') AS month",
        f"count(*) AS transaction_count, {TOTAL} AS total_value, {mean()} AS avg_value",
        "",
    ),
    "transaction_count_by_category": ("merchant_category", "count(*) AS transaction_count", ""),
    "spend_by_category": (
        "merchant_category",
        f"{TOTAL} AS total_spend, {mean()} AS avg_spend",
        "",
    ),
    "top_customers_by_value": (
        "customer_id",
        f"count(*) AS transaction_count, {TOTAL} AS total_spend",
        "ORDER BY total_spend DESC, customer_id NULLS FIRST LIMIT 10",
    ),
    "top_merchants_by_value": (
        "merchant_id, merchant_category",
        f"count(*) AS transaction_count, {TOTAL} AS total_value",
        "ORDER BY total_value DESC, merchant_id NULLS FIRST, merchant_category NULLS FIRST LIMIT 10",
    ),
    "weekend_vs_weekday": (
        "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type",
        f"count(*) AS transaction_count, {TOTAL} AS total_value, {mean()} AS avg_value",
        "",
    ),
    "international_vs_domestic": (
        "CASE WHEN is_international = 1 THEN 'International' ELSE 'Domestic' END AS txn_type",
        f"count(*) AS transaction_count, {TOTAL} AS total_value, {mean()} AS avg_value",
        "",
    ),
    "value_by_state": (
        "state",
        f"count(*) AS transaction_count, {TOTAL} AS total_value, {mean()} AS avg_value",
        "",
    ),
    "anomaly_rate_by_category": (
        "merchant_category",
        "count(*) AS transaction_count, CAST(sum(is_anomaly) AS BIGINT) AS flagged_count, "
        + percentage("sum(is_anomaly)", "count(*)", 2)
        + " AS flagged_rate_pct",
        "",
    ),
}
_REPORT_BODIES = {
    name: f"SELECT {keys}, {measures} FROM transactions GROUP BY ALL {order}"
    for name, (keys, measures, order) in _KEYED.items()
}
_REPORT_BODIES["high_value_transactions"] = f"""SELECT transaction_id, {ISO} AS transaction_date,
  customer_id, merchant_id, merchant_category, transaction_amount, state, is_international
FROM transactions WHERE transaction_amount >= 1000
ORDER BY transaction_amount DESC, transaction_id LIMIT 100"""
REPORT_NAMES = list(_REPORT_BODIES)
SQL.update({name: over(LEDGER, body) for name, body in _REPORT_BODIES.items()})
SQL["all_reports"] = over(
    LEDGER,
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS row_count FROM ({body})"
        for name, body in _REPORT_BODIES.items()
    ),
)

# ------------------------------------------------------------------ filters, dashboards

FILTER_START, FILTER_END = "1996-03-15", "1998-10-20"
FILTER_CATEGORIES = ["CAT_1", "CAT_4", "CAT_7"]
FILTER_STATES = [f"NATION_{i}" for i in range(12)]
FILTER_CARDS = ["BUILDING", "MACHINERY", "FURNITURE"]
FILTER_PAYMENTS = ["1-URGENT", "5-LOW"]


def _in(column, values):
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


_DATES = f"CAST(transaction_date AS DATE) BETWEEN DATE '{FILTER_START}' AND DATE '{FILTER_END}'"
_LISTS = " AND ".join(
    [
        _in("merchant_category", FILTER_CATEGORIES),
        _in("state", FILTER_STATES),
        _in("card_type", FILTER_CARDS),
        _in("payment_method", FILTER_PAYMENTS),
    ]
)
_BRIEF = f"SELECT transaction_id, {ISO} AS transaction_date, transaction_amount FROM transactions"
_DOMAINS = " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS field, {c} AS value FROM transactions WHERE {c} IS NOT NULL"
    for c in ("merchant_category", "state", "card_type", "payment_method")
)
SQL["filter_domains"] = over(LEDGER, _DOMAINS)
SQL["filter_date_domain"] = over(
    LEDGER,
    "SELECT strftime(min(transaction_date), '%Y-%m-%d') AS min_date, "
    "strftime(max(transaction_date), '%Y-%m-%d') AS max_date FROM transactions",
)
SQL["filter_dates"] = over(LEDGER, f"{_BRIEF} WHERE {_DATES}")
SQL["filter_in"] = over(LEDGER, f"{_BRIEF} WHERE {_LISTS}")
SQL["filter_flags"] = over(LEDGER, f"{_BRIEF} WHERE is_international = 1 AND is_anomaly = 0")
SQL["filter_all"] = over(
    LEDGER, f"{_BRIEF} WHERE {_DATES} AND {_LISTS} AND is_international = 0 AND is_anomaly = 0"
)
SQL["kpi_cards"] = over(
    LEDGER,
    f"""SELECT count(*) AS total_transactions, {TOTAL} AS total_value, {mean()} AS avg_value,
  {percentage("sum(is_anomaly)", "count(*)", 3)} AS anomaly_rate_pct FROM transactions""",
)


def _resample(where):
    return over(
        f"""{LEDGER}, f AS (SELECT *, date_trunc('month', transaction_date) AS m FROM transactions
  WHERE {where}),
months AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM f)""",
        f"""SELECT strftime(months.m, '%Y-%m-%d') AS month_start,
  count(transaction_amount) AS transaction_count, coalesce({TOTAL}, 0) AS total_value
FROM months LEFT JOIN f ON f.m = months.m GROUP BY months.m""",
    )


SQL["monthly_resample"] = _resample("true")
# a choice narrow enough to leave months without rows, which must still appear
SPARSE = {"states": ["NATION_6"], "categories": ["CAT_5"], "flagged": True}
SQL["monthly_resample_filtered"] = _resample(
    "state = 'NATION_6' AND merchant_category IN ('CAT_5') AND is_anomaly = 1"
)


def _group(key, measure):
    return over(LEDGER, f"SELECT {key}, {measure} FROM transactions WHERE {key} IS NOT NULL GROUP BY {key}")


SQL["category_spend"] = _group("merchant_category", f"{TOTAL} AS transaction_amount")
SQL["category_count"] = _group("merchant_category", "count(*) AS transaction_count")
SQL["state_count"] = _group("state", "count(*) AS transaction_count")
SQL["state_value"] = _group("state", f"{TOTAL} AS transaction_amount")
_LABELLED = f"""{LEDGER}, labelled AS (SELECT *,
  CASE WHEN is_international = 1 THEN 'International' ELSE 'Domestic' END AS txn_type FROM transactions)"""
SQL["intl_summary"] = over(
    _LABELLED,
    f"SELECT txn_type, count(transaction_amount) AS transaction_count, {TOTAL} AS total_value "
    "FROM labelled GROUP BY txn_type",
)
SQL["intl_share"] = over(
    _LABELLED,
    "SELECT txn_type, count(*) AS transaction_count, CAST(count(*) AS DOUBLE) / "
    "(SELECT count(*) FROM labelled) AS share FROM labelled GROUP BY txn_type",
)
SQL["high_value_count"] = over(
    LEDGER, "SELECT count(*) AS high_value_count FROM transactions WHERE transaction_amount >= 1000"
)


def _histogram(ctes, source, column, bins, groups=""):
    g = f"{groups}, " if groups else ""
    kinds = f", (SELECT DISTINCT {groups} FROM {source}) AS kinds" if groups else ""
    same = f" AND kinds.{groups} = counted.{groups}" if groups else ""
    pick = f"kinds.{groups}, " if groups else ""
    return over(
        f"""{ctes}, r AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}),
w AS (SELECT lo, (hi - lo) / CAST({bins} AS DOUBLE) AS width FROM r),
counted AS (SELECT {g}least(CAST(floor(({column} - lo) / width) AS BIGINT), {bins - 1}) AS bin,
  count(*) AS n FROM {source}, w GROUP BY ALL)""",
        f"""SELECT {pick}b.bin, lo + b.bin * width AS bin_start, lo + (b.bin + 1) * width AS bin_end,
  coalesce(n, 0) AS transaction_count
FROM range({bins}) AS b(bin), w{kinds} LEFT JOIN counted ON counted.bin = b.bin{same}""",
    )


SQL["amount_histogram"] = _histogram(
    f"{LEDGER}, high AS (SELECT * FROM transactions WHERE transaction_amount >= 1000)",
    "high",
    "transaction_amount",
    S.AMOUNT_BINS,
)
_STATUS = """CASE is_anomaly WHEN 0 THEN 'Normal' WHEN 1 THEN 'Flagged' END AS status"""
SQL["score_histogram"] = _histogram(
    f"{LEDGER}, marked AS (SELECT *, {_STATUS} FROM transactions)",
    "marked",
    "anomaly_score",
    S.SCORE_BINS,
    "status",
)
SQL["status_label"] = over(LEDGER, f"SELECT transaction_id, {_STATUS} FROM transactions")
SQL["flagged_table"] = over(
    LEDGER,
    f"""SELECT transaction_id, {ISO} AS transaction_date, customer_id, merchant_id, merchant_category,
  transaction_amount, transaction_hour, distance_from_home_km, is_international, anomaly_score
FROM transactions WHERE is_anomaly = 1""",
)

# ------------------------------------------------------- scalar functions and planting

SQL["derive_weekend"] = over(
    RAW,
    "SELECT transaction_id, CAST(CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END AS BIGINT) "
    "AS is_weekend FROM raw",
)
SQL["derive_keys"] = (
    "SELECT o_orderkey, 'TXN' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 7 THEN "
    "lpad(CAST(o_orderkey AS VARCHAR), 7, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id, "
    "'CUST' || CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 6 THEN "
    "lpad(CAST(o_custkey AS VARCHAR), 6, '0') ELSE CAST(o_custkey AS VARCHAR) END AS customer_id FROM orders"
)


def _hundredths(seed, low, high):
    steps = (high - low) * 100 + 1
    return (
        f"CAST({word('transaction_id', seed, 0)} % {steps} + {low * 100} AS DOUBLE) / CAST(100 AS DOUBLE)"
    )


_OUT = chosen("transaction_id", f"{S.SEED}/outlier", 0.02)
SQL["plant_outliers"] = over(
    f"{RAW}, hit AS (SELECT *, {_OUT} AS h FROM raw)",
    f"""SELECT * EXCLUDE (h) REPLACE ({ISO} AS transaction_date,
  CASE WHEN h THEN {_hundredths(f"{S.SEED}/amount", 1500, 9000)} ELSE transaction_amount END AS transaction_amount,
  CASE WHEN h THEN {word("transaction_id", f"{S.SEED}/hour", 0)} % 4 + 1 ELSE transaction_hour END AS transaction_hour,
  CASE WHEN h THEN {_hundredths(f"{S.SEED}/distance", 2000, 12000)} ELSE distance_from_home_km END
    AS distance_from_home_km,
  CASE WHEN h THEN 1 ELSE is_international END AS is_international,
  CAST(CASE WHEN h THEN 1 ELSE 0 END AS BIGINT) AS ground_truth_unusual) FROM hit""",
)
SQL["plant_defects"] = over(
    RAW,
    f"""SELECT transaction_id,
  CASE WHEN NOT {chosen("transaction_id", f"{S.SEED}/city", 0.01)} THEN city END AS city,
  CASE WHEN NOT {chosen("transaction_id", f"{S.SEED}/income", 0.01)} THEN customer_income END AS customer_income,
  CASE WHEN {chosen("transaction_id", f"{S.SEED}/invalid", 0.003)} THEN -abs(transaction_amount)
    ELSE transaction_amount END AS transaction_amount FROM raw""",
)
SQL["union_duplicates"] = over(
    f"{RAW}, t AS (SELECT {_TEXT_DATE} FROM raw)",
    f"SELECT * FROM t UNION ALL SELECT * FROM t WHERE {chosen('transaction_id', f'{S.SEED}/duplicate', 0.005)}",
)
SQL["sample_exact_n"] = over(
    KEPT,
    f"SELECT transaction_id FROM kept QUALIFY row_number() OVER (ORDER BY "
    f"{word('transaction_id', S.SEED, 0)}, transaction_id) <= CAST(floor((SELECT count(*) FROM kept) * 0.01) AS BIGINT)",
)


def _lowest(purpose, share):
    """Whether a row's hash is among the lowest ``share`` of all."""
    order = word("transaction_id", f"{S.SEED}/{purpose}", 0)
    return f"rank() OVER (ORDER BY {order}) <= CAST(floor((SELECT count(*) FROM kept) * {share}) AS BIGINT)"


SQL["plant_exact"] = over(
    f"""{KEPT}, picked AS (SELECT *, {_lowest("outlier", 0.02)} AS outlier, {_lowest("city", 0.01)} AS no_city,
  {_lowest("income", 0.01)} AS no_income, {_lowest("invalid", 0.003)} AS invalid FROM kept),
shifted AS (SELECT * REPLACE (CASE WHEN outlier THEN {_hundredths(f"{S.SEED}/amount", 1500, 9000)}
  ELSE transaction_amount END AS transaction_amount) FROM picked)""",
    """SELECT transaction_id, CAST(CASE WHEN outlier THEN 1 ELSE 0 END AS BIGINT) AS ground_truth_unusual,
  CASE WHEN NOT no_city THEN city END AS city, CASE WHEN NOT no_income THEN customer_income END AS customer_income,
  CASE WHEN invalid THEN -abs(transaction_amount) ELSE transaction_amount END AS transaction_amount FROM shifted""",
)

SQL["union_duplicates_exact"] = over(
    f"{KEPT}, picked AS (SELECT *, {_lowest('duplicate', 0.005)} AS again FROM kept)",
    """SELECT transaction_id, transaction_amount FROM picked
UNION ALL SELECT transaction_id, transaction_amount FROM picked WHERE again""",
)

# Rows that only their city tells apart: copies are numbered, and each is a row to draw.
SQL["forest_sample_copies"] = over(
    f"{KEPT}, sized AS (SELECT count(*) AS rows FROM kept)",
    f"SELECT CAST(t AS BIGINT) AS tree, CAST(least({S.SAMPLE_SIZE}, rows) AS BIGINT) AS n "
    f"FROM sized, range({S.N_TREES}) AS r(t)",
)

# ------------------------------------------- reports over the forest's own flags and scores

_OWN = f"""{SCORED},
own AS (SELECT * REPLACE ({round_half_up("anomaly_score", 8)} AS anomaly_score) FROM scored),
marked AS (SELECT *, {_STATUS} FROM own)"""
_RATES = (
    "SELECT merchant_category, count(*) AS transaction_count, "
    "CAST(sum(is_anomaly) AS BIGINT) AS flagged_count, "
    + percentage("sum(is_anomaly)", "count(*)", 2)
    + " AS flagged_rate_pct FROM scored GROUP BY ALL"
)
SQL["forest_rate_by_category"] = over(SCORED, _RATES)
SQL["risk_rate_by_category"] = over(f"{KEYED_FOREST},{_WALK}", _RATES)
SQL["forest_score_histogram"] = _histogram(_OWN, "marked", "anomaly_score", S.SCORE_BINS, "status")
SQL["forest_flagged_table"] = over(
    _OWN,
    f"""SELECT transaction_id, {ISO} AS transaction_date, customer_id, merchant_id, merchant_category,
  transaction_amount, transaction_hour, distance_from_home_km, is_international, anomaly_score
FROM own WHERE is_anomaly = 1""",
)

# What one task may hold, in the queries that take the way of larger tables.
FEW = 40
SQL["clean_income_large"] = SQL["clean_income"]
SQL["impute_median_large"] = SQL["impute_median"]
SQL["contamination_threshold_large"] = SQL["contamination_threshold"]


def _first_by_state(purpose, share):
    """Whether a row is among the first ``share`` by the hash of its state, then by id."""
    order = word("state", purpose, 0)
    return (
        f"row_number() OVER (ORDER BY {order}, transaction_id) <= "
        f"CAST(floor((SELECT count(*) FROM kept) * {share}) AS BIGINT)"
    )


SQL["sample_exact_shared_key"] = over(
    KEPT, f"SELECT transaction_id, state FROM kept QUALIFY {_first_by_state(S.SEED, 0.1)}"
)
SQL["plant_exact_shared_key"] = over(
    f"""{KEPT}, picked AS (SELECT *, {_first_by_state(f"{S.SEED}/city", 0.01)} AS no_city,
  {_first_by_state(f"{S.SEED}/income", 0.01)} AS no_income, {_first_by_state(f"{S.SEED}/invalid", 0.003)} AS invalid FROM kept)""",
    """SELECT transaction_id, CASE WHEN NOT no_city THEN city END AS city,
  CASE WHEN NOT no_income THEN customer_income END AS customer_income,
  CASE WHEN invalid THEN -abs(transaction_amount) ELSE transaction_amount END AS transaction_amount FROM picked""",
)
SQL["filter_has_rows"] = over(
    LEDGER,
    f"SELECT 'some' AS choice, count(*) > 0 AS has_rows FROM transactions WHERE {_LISTS} "
    "UNION ALL SELECT 'none', count(*) > 0 FROM transactions WHERE state = 'NOWHERE'",
)

# Amounts finer than a cent: a share of each amount, in ten-thousandths.
FINE = 10_000
SQL["sub_cent_spend"] = over(
    f"""{LEDGER}, fine AS (SELECT merchant_category,
  CAST(floor(abs(transaction_amount) * 37) AS HUGEINT) AS x FROM transactions)""",
    f"""SELECT merchant_category, CAST((sum(x) * 2 + {FINE // 100}) // {2 * FINE // 100} AS DOUBLE) / 100 AS total_spend,
  CAST((sum(x) * 2 + count(*) * {FINE // 100}) // (count(*) * {2 * FINE // 100}) AS DOUBLE) / 100 AS avg_spend
FROM fine GROUP BY ALL""",
)

# How sorted results must come, beside what they hold.
ORDER = {
    "monthly_transaction_value": "month",
    "transaction_count_by_category": "transaction_count DESC, merchant_category",
    "spend_by_category": "total_spend DESC, merchant_category",
    "top_customers_by_value": "total_spend DESC, customer_id",
    "top_merchants_by_value": "total_value DESC, merchant_id, merchant_category",
    "high_value_transactions": "transaction_amount DESC, transaction_id",
    "value_by_state": "total_value DESC, state",
    "anomaly_rate_by_category": "flagged_rate_pct DESC, merchant_category",
    "risk_rate_by_category": "flagged_rate_pct DESC, merchant_category",
    "filter_domains": "field, value",
    "monthly_resample": "month_start",
    "category_spend": "transaction_amount DESC, merchant_category",
    "category_count": "transaction_count DESC, merchant_category",
    "state_count": "transaction_count DESC, state",
    "state_value": "transaction_amount DESC, state",
    "intl_summary": "txn_type",
    "amount_histogram": "bin",
    "score_histogram": "status, bin",
    "flagged_table": "anomaly_score, transaction_id",
}
