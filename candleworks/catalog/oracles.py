"""The same results in DuckDB SQL, written independently of the Spark expressions."""

from __future__ import annotations

# --- shared table expressions ----------------------------------------------

_BARS = """
trades AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / l_quantity AS price, l_quantity AS qty,
         row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bars AS (
  SELECT symbol, date, arg_min(price, k) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, k) AS close, arg_max(price, k) AS adj_close,
         CAST(sum(qty) AS BIGINT) AS volume, 'USD' AS currency, 'US' AS exchange,
         row_number() OVER (PARTITION BY symbol ORDER BY date) AS ingest_seq
  FROM trades GROUP BY symbol, date)"""

_SUPPLIER_BARS = _BARS.replace(
    "p_brand AS symbol", "CAST(l_suppkey AS VARCHAR) AS symbol"
).replace("FROM lineitem JOIN part ON l_partkey = p_partkey", "FROM lineitem")

_DIRTY = (
    _BARS
    + """,
broken AS (
  SELECT symbol, date, ingest_seq AS rn, close, currency, exchange,
         CASE WHEN ingest_seq % 211 = 0 THEN -open ELSE open END AS open,
         CASE WHEN ingest_seq % 239 = 0 THEN high - 1
              WHEN ingest_seq % 223 = 0 THEN NULL ELSE high END AS high,
         CASE WHEN ingest_seq % 227 = 0 THEN high + 1 ELSE low END AS low,
         CASE WHEN ingest_seq % 233 = 0 THEN NULL ELSE adj_close END AS adj_close,
         CASE WHEN ingest_seq % 11 = 0 THEN 0 WHEN ingest_seq % 229 = 0 THEN -volume
              ELSE volume END AS volume
  FROM bars),
dirty AS (
  SELECT *, rn AS ingest_seq FROM broken
  UNION ALL SELECT *, rn + 1000000 FROM broken WHERE rn % 97 = 0)"""
)

_NUMBER = "CAST(split_part(symbol, '#', 2) AS INTEGER)"

_MIXED = (
    _DIRTY
    + f""",
mixed AS (
  SELECT symbol, date, open, high, low, close, adj_close, volume, currency, exchange, ingest_seq
  FROM dirty WHERE {_NUMBER} % 2 = 1
  UNION ALL
  SELECT symbol, date, open, high, low, close, adj_close,
         CASE WHEN {_NUMBER} % 10 = 4 AND ingest_seq % 5 = 0 THEN 0 ELSE volume END, currency, exchange, ingest_seq
  FROM bars WHERE {_NUMBER} % 2 = 0)"""
)

_RAW = (
    _BARS
    + f""",
raw AS (
  SELECT symbol, ingest_seq, {_NUMBER} AS b,
         CASE WHEN ingest_seq % 251 = 0 THEN 'n/a' ELSE CAST(open AS VARCHAR) END AS open_text,
         CASE WHEN ingest_seq % 263 = 0 AND {_NUMBER} IN (3, 4, 5) THEN ''
              ELSE CAST(close AS VARCHAR) END AS close_text,
         CASE WHEN ingest_seq % 257 = 0 AND {_NUMBER} IN (6, 7) THEN 'many'
              WHEN ingest_seq % 269 = 0 THEN '12.5' ELSE CAST(volume AS VARCHAR) END AS volume_text
  FROM bars)"""
)


def _filled(source: str, adjusted: str = "adj_close") -> str:
    """Table ``corrected``: the source with short runs filled by interpolation.

    A symbol without a filled day keeps its own missing values (nothing is interpolated).
    """
    cols = ["open", "high", "low", "close"]
    nxt = ", ".join(f"lead({c}) OVER w AS n_{c}" for c in cols)
    line = ", ".join(f"{c} + (n_{c} - {c}) * k / (m + 1) AS {c}" for c in cols)
    return f"""
stepped AS (
  SELECT symbol, date, {", ".join(cols)}, {adjusted} AS adj_close, volume, currency, exchange,
         {nxt}, date_diff('day', date, lead(date) OVER w) - 1 AS m
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date)),
placed AS (
  SELECT symbol, date, {", ".join(cols)}, adj_close, volume, currency, exchange, FALSE AS is_filled
  FROM stepped
  UNION ALL
  SELECT symbol, date + CAST(k AS INTEGER) AS date, {line}, NULL, 0, currency, exchange, TRUE
  FROM stepped, unnest(generate_series(1, m)) AS g(k) WHERE m BETWEEN 1 AND 2),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS ingest_seq FROM placed),
known AS (
  SELECT *, bool_or(is_filled) OVER (PARTITION BY symbol) AS any_filled,
            max(CASE WHEN adj_close IS NOT NULL THEN ingest_seq END) OVER
              (PARTITION BY symbol ORDER BY ingest_seq) AS pa,
            min(CASE WHEN adj_close IS NOT NULL THEN ingest_seq END) OVER
              (PARTITION BY symbol ORDER BY ingest_seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb
  FROM numbered),
corrected AS (
  SELECT t.symbol, t.date, t.open, t.high, t.low, t.close,
         CASE WHEN t.adj_close IS NOT NULL THEN t.adj_close
              WHEN NOT t.any_filled OR t.ingest_seq - t.pa > 2 THEN NULL
              WHEN t.pb IS NULL THEN a.adj_close
              ELSE a.adj_close + (b.adj_close - a.adj_close) * (t.ingest_seq - t.pa) / (t.pb - t.pa)
         END AS adj_close,
         CAST(t.volume AS BIGINT) AS volume, t.currency, t.exchange, t.is_filled, t.ingest_seq
  FROM known t
  LEFT JOIN numbered a ON a.symbol = t.symbol AND a.ingest_seq = t.pa
  LEFT JOIN numbered b ON b.symbol = t.symbol AND b.ingest_seq = t.pb)"""


_LAYERS = (
    _BARS
    + ","
    + _filled("bars")
    + """,
layers AS (
  SELECT 'original' AS layer, symbol, date, close, volume FROM bars
  UNION ALL SELECT 'corrected', symbol, date, close, volume FROM corrected)"""
)


# --- issues -----------------------------------------------------------------

_IDENTICAL = "abs(open - high) <= 0.01 AND abs(open - low) <= 0.01 AND abs(open - close) <= 0.01"
_ROW_CONDITIONS: list[tuple[str, str, str]] = [
    *[("vr_null_critical", c, f"{c} IS NULL") for c in ("open", "high", "low", "close")],
    *[("vr_null_optional", c, f"{c} IS NULL") for c in ("volume", "adj_close")],
    *[("vr_price_nonpositive", c, f"{c} <= 0") for c in ("open", "high", "low", "close")],
    ("vr_volume_negative", "volume", "volume < 0"),
    ("vr_volume_zero_rows", "volume", "volume = 0"),
    ("vr_low_gt_open", "", "low > open + 0.01"),
    ("vr_low_gt_high", "", "low > high + 0.01"),
    ("vr_low_gt_close", "", "low > close + 0.01"),
    ("vr_high_lt_open", "", "high + 0.01 < open"),
    ("vr_high_lt_close", "", "high + 0.01 < close"),
    ("vr_ohlc_identical", "", _IDENTICAL),
    ("vr_weekend_trading", "", "isodow(date) >= 6"),
]

#: rule -> issue type and severity, written out so that a wrong label can't pass.
_LABELS = {
    "vr_empty": ("missing_data", "CRITICAL"),
    "vr_missing_columns": ("missing_data", "CRITICAL"),
    "vr_non_numeric": ("invalid_type", "CRITICAL"),
    "vr_volume_type": ("invalid_type", "WARNING"),
    "vr_null_critical": ("missing_data", "CRITICAL"),
    "vr_null_optional": ("missing_data", "WARNING"),
    "vr_min_rows": ("missing_data", "CRITICAL"),
    "vr_price_nonpositive": ("negative_price", "CRITICAL"),
    "vr_volume_negative": ("zero_volume", "CRITICAL"),
    "vr_volume_zero_rows": ("zero_volume", "WARNING"),
    "vr_low_gt_open": ("price_inconsistency", "WARNING"),
    "vr_low_gt_high": ("price_inconsistency", "CRITICAL"),
    "vr_low_gt_close": ("price_inconsistency", "WARNING"),
    "vr_high_lt_open": ("price_inconsistency", "WARNING"),
    "vr_high_lt_close": ("price_inconsistency", "WARNING"),
    "vr_ohlc_identical": ("price_inconsistency", "WARNING"),
    "vr_date_duplicate": ("date_duplicate", "CRITICAL"),
    "vr_date_order": ("date_order", "WARNING"),
    "vr_gap_suspicious": ("date_gap", "WARNING"),
    "vr_weekend_trading": ("date_gap", "WARNING"),
    "vr_sparse_series": ("date_gap", "INFO"),
    "vr_temporal_stats": ("date_gap", "INFO"),
    "vr_extreme_variation": ("extreme_variation", "WARNING"),
    "vr_volume_zero_share": ("volume_zero", "WARNING"),
    "vr_iqr_outlier": ("outlier", "INFO"),
}


def _spec(rule: str, severity: str | None = None) -> str:
    kind, usual = _LABELS[rule]
    return f"'{rule}' AS rule_id, '{kind}' AS issue_type, {severity or repr(usual)} AS severity"


def _issue_selects(source: str) -> dict[str, str]:
    """rule -> SELECT of its issues over a bars table (metric columns come last)."""
    found: dict[str, list[str]] = {}
    for rule, field, condition in _ROW_CONDITIONS:
        found.setdefault(rule, []).append(
            f"SELECT symbol, '{field}' AS field, {_spec(rule)}, count(*) AS affected "
            f"FROM {source} WHERE {condition} GROUP BY symbol"
        )
    selects = {rule: "\nUNION ALL ".join(parts) for rule, parts in found.items()}
    selects["vr_volume_zero_share"] = f"""
SELECT symbol, 'volume' AS field,
       {_spec('vr_volume_zero_share', "CASE WHEN z < n * 0.1 THEN 'WARNING' ELSE 'CRITICAL' END")},
       z AS affected, round(z / n * 100, 6) AS metric
FROM (SELECT symbol, count(*) AS n, count(*) FILTER (volume = 0) AS z FROM {source} GROUP BY symbol)
WHERE z > 0"""
    selects["vr_date_duplicate"] = f"""
SELECT symbol, '' AS field, {_spec('vr_date_duplicate')}, count(*) AS affected,
       round(CAST(count(DISTINCT date) AS DOUBLE), 0) AS metric
FROM (SELECT symbol, date, row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq) AS n FROM {source})
WHERE n > 1 GROUP BY symbol"""
    steps = f"""(SELECT symbol, count(*) AS n, count(*) FILTER (g < 0) AS back,
  count(*) FILTER (g = 1) AS one, count(*) FILTER (g BETWEEN 2 AND 3) AS weekend,
  count(*) FILTER (g BETWEEN 4 AND 7) AS holiday, count(*) FILTER (g > 7) AS longer, max(g) AS largest
  FROM (SELECT symbol, date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY ingest_seq), date) AS g
        FROM {source}) GROUP BY symbol)"""
    selects["vr_date_order"] = (
        f"SELECT symbol, '' AS field, {_spec('vr_date_order')}, back AS affected FROM {steps} WHERE back > 0"
    )
    selects["vr_gap_suspicious"] = f"""
SELECT symbol, '' AS field, {_spec('vr_gap_suspicious')}, longer AS affected,
       CAST(largest AS DOUBLE) AS metric FROM {steps} WHERE longer > 0"""
    selects["vr_sparse_series"] = f"""
SELECT symbol, '' AS field, {_spec('vr_sparse_series')}, one AS affected,
       round(one / (n - 1) * 100, 6) AS metric FROM {steps} WHERE one / nullif(n - 1, 0) < 0.6"""
    selects["vr_temporal_stats"] = f"""
SELECT symbol, '' AS field, {_spec('vr_temporal_stats')}, one AS affected,
       CAST(weekend AS DOUBLE) AS metric, CAST(holiday AS DOUBLE) AS metric_2 FROM {steps} WHERE n > 1"""
    selects["vr_extreme_variation"] = f"""
SELECT symbol, 'close' AS field, {_spec('vr_extreme_variation')}, count(*) AS affected,
       round(max(v), 6) AS metric
FROM (SELECT symbol, abs(close / lag(close) OVER (PARTITION BY symbol ORDER BY date, ingest_seq) - 1) AS v
      FROM {source}) WHERE v > 0.2 GROUP BY symbol"""
    outliers = []
    for field in ("open", "high", "low", "close", "volume"):
        outliers.append(
            f"SELECT t.symbol, '{field}' AS field, {_spec('vr_iqr_outlier')}, count(*) AS affected, "
            f"round(max(lo), 4) AS metric, round(max(hi), 4) AS metric_2 FROM {source} t JOIN "
            f"(SELECT symbol, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
            f"(SELECT symbol, quantile_cont({field}, 0.25) AS q1, quantile_cont({field}, 0.75) AS q3 "
            f"FROM {source} GROUP BY symbol)) b USING (symbol) "
            f"WHERE t.{field} < lo OR t.{field} > hi GROUP BY t.symbol"
        )
    selects["vr_iqr_outlier"] = "\nUNION ALL ".join(outliers)
    return selects


_MIXED_ISSUES = (
    _MIXED
    + ",\nfound AS ("
    + "\nUNION ALL ".join(
        f"(SELECT symbol, rule_id, severity FROM ({s}))" for s in _issue_selects("mixed").values()
    )
    + "\nUNION ALL SELECT symbol, 'vr_min_rows', 'CRITICAL' FROM mixed GROUP BY symbol HAVING count(*) < 5)"
)
_BAD = """,
bad AS (
  SELECT symbol, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS reasons
  FROM found WHERE severity = 'CRITICAL' GROUP BY symbol)"""

# What the repair of the accepted symbols changes: days filled in.
_REPAIRED = """,
repaired AS (
  SELECT symbol FROM (
    SELECT symbol, date_diff('day', date, lead(date) OVER (PARTITION BY symbol ORDER BY date)) - 1 AS m
    FROM mixed WHERE symbol NOT IN (SELECT symbol FROM bad))
  GROUP BY symbol HAVING count(*) FILTER (m BETWEEN 1 AND 2) > 0),
every_issue AS (
  SELECT symbol, rule_id, severity FROM found UNION ALL SELECT symbol, 'fix_interpolate', 'INFO' FROM repaired)"""

# Mixed bars of the symbols that pass the gate; the stored layers hold them.
_EVEN = _MIXED_ISSUES + _BAD + """,
even AS (SELECT * FROM mixed WHERE symbol NOT IN (SELECT symbol FROM bad))"""
_STORED = _EVEN + "," + _filled("even")
_PERIOD = """,
latest AS (SELECT symbol, max(date) AS d FROM even GROUP BY symbol)"""

_RETURNS = """,
returns AS (
  SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1.0 AS r
  FROM bars)"""

_ROLLING = (
    _RETURNS
    + """,
rolled AS (
  SELECT *, CASE WHEN count(r) OVER w = 30 THEN stddev_samp(r) OVER w END AS rv
  FROM returns
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
topped AS (
  SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY date) AS top FROM rolled),
risk AS (SELECT *, (close - top) / nullif(top, 0) AS dd FROM topped)"""
)

_REQUESTED = """,
requested AS (SELECT DISTINCT p_brand AS symbol FROM part UNION ALL SELECT r_name FROM region)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _recursive(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select.strip()}"


SQL: dict[str, str] = {}

_ELEVEN = "symbol, date, open, high, low, close, adj_close, volume, currency, exchange"
_ALL_BARS = _with(_BARS, f"SELECT {_ELEVEN} FROM bars")

# --- sources and sinks -----------------------------------------------------

for _name in ("src_timeseries_json", "src_values_json", "proj_bars_schema", "sink_csv"):
    SQL[_name] = _ALL_BARS
SQL["src_timeseries_json_generic"] = _with(
    _BARS,
    "SELECT symbol, date, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM bars",
)
SQL["src_interval_json"] = _with(
    _BARS,
    """
SELECT symbol, max(date) AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, date) AS close, arg_max(adj_close, date) AS adj_close, CAST(sum(volume) AS BIGINT) AS volume,
       'USD' AS currency, 'US' AS exchange
FROM bars GROUP BY symbol, date_trunc('week', date)""",
)
SQL["src_quote_json"] = _with(
    _BARS,
    "SELECT symbol, arg_max(close, date) AS price, 'USD' AS currency FROM bars GROUP BY symbol",
)
SQL["src_payload_errors"] = _with(
    _BARS,
    f"""
, documents AS (SELECT DISTINCT symbol, year(date) AS y, {_NUMBER} AS b FROM bars)
SELECT symbol,
       CASE WHEN b % 4 = 0 OR b % 8 = 3 THEN 'provider_error' WHEN b % 4 = 1 THEN 'rate_limited'
            ELSE 'no_series' END AS status,
       CASE WHEN b % 4 = 0 THEN 'Invalid API call'
            WHEN b % 4 = 1 THEN 'Our standard call frequency is 5 per minute'
            WHEN b % 8 = 3 THEN 'symbol not found' END AS detail,
       count(*) AS documents
FROM documents WHERE b % 4 IN (0, 1) OR b % 8 IN (2, 3) GROUP BY 1, 2, 3""",
)
_SHAPES = _BARS + f""",
shaped AS (SELECT *, {_NUMBER} % 4 AS shape FROM bars)"""
SQL["src_series_variants"] = _with(
    _SHAPES,
    """
SELECT symbol, CASE WHEN shape = 3 AND ingest_seq % 11 = 0 THEN NULL ELSE date END AS date, open, high, low, close,
       CASE WHEN shape = 1 THEN close / 2 ELSE close END AS adj_close,
       CASE WHEN shape = 3 AND ingest_seq % 10 = 0 THEN NULL ELSE volume END AS volume, currency, exchange
FROM shaped WHERE NOT (shape = 3 AND ingest_seq % 7 = 0)""",
)
SQL["src_point_errors"] = _with(
    _SHAPES,
    """
SELECT symbol, 'repeated_name' AS detail, count(*) AS points FROM shaped WHERE shape = 3 GROUP BY symbol
UNION ALL
SELECT symbol, 'bad_date', count(*) FROM shaped WHERE shape = 3 AND ingest_seq % 11 = 0 GROUP BY symbol
UNION ALL
SELECT symbol, 'volume_overflow', count(*) FROM shaped WHERE shape = 3 AND ingest_seq % 10 = 0 GROUP BY symbol""",
)
SQL["src_parquet_snapshot"] = _with(
    _STORED + _PERIOD,
    f"""
SELECT c.{_ELEVEN.replace(", ", ", c.")}, is_filled, CAST(year(d) AS INTEGER) AS as_of_year,
       CAST(month(d) AS INTEGER) AS as_of_month
FROM corrected c JOIN latest USING (symbol)""",
)

_METADATA = """
SELECT symbol, CAST(year(d) AS INTEGER) AS as_of_year, CAST(month(d) AS INTEGER) AS as_of_month,
       o.n AS original_records, CAST(0 AS BIGINT) AS original_duplicates_removed,
       c.n AS corrected_records, c.n - o.n AS added_by_correction,
       o.a AS start_date, o.b AS end_date, TRUE AS is_valid, i.n AS total_issues,
       CAST(0 AS BIGINT) AS critical_count, i.w AS warning_count, i.n - i.w AS info_count
FROM (SELECT symbol, count(*) AS n, min(date) AS a, max(date) AS b FROM even GROUP BY symbol) o
JOIN (SELECT symbol, count(*) AS n FROM corrected GROUP BY symbol) c USING (symbol)
JOIN latest USING (symbol) JOIN counted i USING (symbol)"""
SQL["src_metadata"] = _with(
    _STORED
    + _PERIOD
    + _REPAIRED
    + """,
counted AS (
  SELECT symbol, count(*) AS n, count(*) FILTER (severity = 'WARNING') AS w FROM every_issue GROUP BY symbol)""",
    _METADATA,
)
_ALL_STORED = (
    _BARS + ",\neven AS (SELECT * FROM bars)," + _filled("bars") + _PERIOD
)
_ISSUES_OF_BARS = "\nUNION ALL ".join(
    [f"(SELECT symbol, severity FROM ({s}))" for s in _issue_selects("bars").values()]
    + ["(SELECT symbol, 'CRITICAL' FROM bars GROUP BY symbol HAVING count(*) < 5)"]
)
SQL["sink_metadata"] = _with(
    _ALL_STORED
    + f""",
counted AS (
  SELECT symbol, count(*) AS n, count(*) FILTER (severity = 'WARNING') AS w, count(*) FILTER (severity = 'CRITICAL') AS k
  FROM ({_ISSUES_OF_BARS}) GROUP BY symbol)""",
    _METADATA.replace("TRUE AS is_valid", "i.k = 0 AS is_valid")
    .replace("CAST(0 AS BIGINT) AS critical_count", "i.k AS critical_count")
    .replace("i.n - i.w AS info_count", "i.n - i.w - i.k AS info_count"),
)
SQL["src_list_symbols"] = _with(_EVEN, "SELECT DISTINCT symbol FROM even")
_EVERY_YEAR = "(SELECT DISTINCT CAST(year(date) AS INTEGER) AS y FROM bars)"
SQL["src_list_periods"] = _with(
    _BARS,
    f"""
SELECT DISTINCT symbol, y AS as_of_year, CAST(12 AS INTEGER) AS as_of_month,
       y = (SELECT max(year(date)) FROM bars) AS is_latest
FROM bars, {_EVERY_YEAR} WHERE year(date) <= y""",
)
SQL["src_universe"] = """
SELECT DISTINCT p_brand AS symbol, 'expansion' AS universe FROM part
UNION ALL
SELECT DISTINCT p_brand, 'core' FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INTEGER) <= 5"""
SQL["sink_parquet_layers"] = _with(
    _STORED,
    """
SELECT layer, symbol, CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows,
       min(date) AS first_date, max(date) AS last_date, CAST(sum(volume) AS BIGINT) AS volume
FROM (SELECT 'original' AS layer, symbol, date, volume FROM even
      UNION ALL SELECT 'corrected', symbol, date, volume FROM corrected)
GROUP BY 1, 2, 3""",
)
_UPSERT = """
FROM bars WHERE ingest_seq % 3 <> 0 OR ingest_seq % 2 = 0"""
SQL["sink_dataset_upsert"] = _with(
    _BARS,
    "SELECT symbol, date, open, CASE WHEN ingest_seq % 2 = 0 THEN close * 2 ELSE close END AS close,"
    f" volume {_UPSERT}",
)
SQL["set_merge_upsert"] = SQL["sink_dataset_upsert"].replace("symbol, date, open, CASE", "symbol, date, CASE")
SQL["sink_backup_retention"] = _with(
    _BARS,
    """
, yearly AS (SELECT symbol, CAST(year(date) AS VARCHAR) AS backup_id, count(*) AS n_rows FROM bars GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY backup_id DESC) AS n FROM yearly)
SELECT symbol, 'original' AS layer, backup_id, n_rows FROM ranked WHERE n <= 4""",
)
SQL["sink_report_json"] = _with(
    _STORED,
    """
SELECT symbol, o.n AS original_records, c.n - o.n AS gaps_filled, c.n AS trading_days,
       c.v AS max_volume, c.n - o.n AS added_records
FROM (SELECT symbol, count(*) AS n FROM even GROUP BY symbol) o
JOIN (SELECT symbol, count(*) AS n, max(volume) AS v FROM corrected GROUP BY symbol) c USING (symbol)""",
)

# Two saves up to 2000 (every bar but each sixth that neither delivers), one from 2000 on.
_SAVES = (
    _BARS
    + """,
early AS (
  SELECT *, date = max(date) OVER (PARTITION BY symbol) AS last FROM bars WHERE year(date) <= 2000),
merged AS (
  SELECT symbol, date, volume, ingest_seq, CASE WHEN last OR ingest_seq % 2 = 0 THEN high ELSE close END AS close
  FROM early WHERE last OR ingest_seq % 3 <> 0 OR ingest_seq % 2 = 0),
late AS (SELECT symbol, date, volume, ingest_seq, close FROM bars WHERE year(date) >= 2000),
snaps AS (
  SELECT symbol, date, volume, close, max(date) OVER (PARTITION BY symbol) AS d FROM merged
  UNION ALL SELECT symbol, date, volume, close, max(date) OVER (PARTITION BY symbol) FROM late)"""
)
SQL["src_metadata_second_save"] = _with(
    _SAVES,
    """
SELECT symbol, CAST(year(d) AS INTEGER) AS as_of_year, CAST(month(d) AS INTEGER) AS as_of_month,
       count(*) AS original_records, CAST(0 AS BIGINT) AS original_duplicates_removed,
       min(date) AS start_date, max(date) AS end_date
FROM snaps GROUP BY symbol, d""",
)
SQL["sink_csv_second_save"] = _with(
    _SAVES,
    """
SELECT symbol, date, close, CAST(volume AS BIGINT) AS volume
FROM (SELECT *, 1 AS save FROM merged UNION ALL SELECT *, 2 AS save FROM late)
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY save DESC) = 1""",
)
SQL["dq_report_two_snapshots"] = _with(
    _SAVES,
    """
SELECT symbol, CAST(year(d) AS INTEGER) AS as_of_year, CAST(month(d) AS INTEGER) AS as_of_month,
       strftime(d, '%Y-%m') AS period, count(*) AS original_records,
       CAST(max(date) - min(date) + 1 AS INTEGER) AS total_days,
       count(*) - count(DISTINCT date) AS has_duplicates, TRUE AS is_sorted
FROM snaps GROUP BY symbol, d""",
)
SQL["pipe_report_latest"] = _with(
    _SAVES,
    """
SELECT symbol, strftime(max(date), '%Y-%m') AS period, count(*) AS original_records,
       CAST(sum(volume) AS BIGINT) AS original_total_volume, arg_max(close, date) AS end_price
FROM late GROUP BY symbol""",
)
SQL["sink_backups_on_disk"] = _with(
    _BARS,
    """
SELECT symbol, 'original' AS layer, CAST(4 AS BIGINT) AS backups, count(*) * 4 AS n_rows FROM bars GROUP BY symbol""",
)
SQL["src_snapshot_read"] = _with(
    _STORED + _PERIOD,
    f"""
SELECT c.{_ELEVEN.replace(", ", ", c.")}, is_filled, CAST(year(d) AS INTEGER) AS as_of_year,
       CAST(month(d) AS INTEGER) AS as_of_month
FROM corrected c JOIN latest USING (symbol) WHERE symbol = (SELECT min(symbol) FROM latest)""",
)

# --- projections -----------------------------------------------------------

SQL["proj_exchange_from_symbol"] = """
WITH t AS (SELECT 'S' || s_suppkey || ['.AS', '.L', '.DE', '.PA', '.MI', '.SW', '.ST', ''][s_suppkey % 8 + 1]
             AS symbol FROM supplier)
SELECT symbol, CASE split_part(symbol, '.', 2) WHEN 'AS' THEN 'Amsterdam' WHEN 'L' THEN 'London'
         WHEN 'DE' THEN 'Frankfurt' WHEN 'PA' THEN 'Paris' WHEN 'MI' THEN 'Milan' WHEN '' THEN 'US'
         ELSE split_part(symbol, '.', 2) END AS exchange
FROM t"""
SQL["proj_normalize_types"] = _with(
    _BARS,
    """
SELECT symbol, date, open, high, low, close, adj_close,
       CASE WHEN volume = 10 THEN 0 ELSE volume END AS volume, currency, exchange FROM bars""",
)
SQL["proj_numeric_coerce"] = _with(
    _RAW,
    """
SELECT symbol, ingest_seq, try_cast(open_text AS DOUBLE) AS open, try_cast(close_text AS DOUBLE) AS close,
       try_cast(volume_text AS DOUBLE) AS volume FROM raw""",
)
SQL["filt_null_prices"] = _with(
    _DIRTY, "SELECT symbol, ingest_seq, date, high FROM dirty WHERE high IS NOT NULL"
)
SQL["proj_compact_100"] = _with(
    _BARS,
    """
SELECT symbol, date, close FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 100""",
)
SQL["proj_latest_price"] = _with(
    _BARS,
    """
SELECT symbol, close AS price, adj_close AS adj_price, volume, date, currency, exchange FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
)
SQL["proj_year_month"] = _with(
    _BARS,
    """
SELECT symbol, CAST(year(max(date)) AS INTEGER) AS as_of_year,
       CAST(month(max(date)) AS INTEGER) AS as_of_month FROM bars GROUP BY symbol""",
)

# --- joins and sets --------------------------------------------------------


def _pivot(value: str) -> str:
    return ", ".join(
        f"max(CASE WHEN symbol = 'Brand#{i}' THEN {value} END) AS brand_{i}" for i in range(1, 26)
    )


SQL["join_compare_symbols"] = _with(_BARS, f"SELECT date, {_pivot('close')} FROM bars GROUP BY date")
SQL["join_returns_align"] = _with(
    _BARS + _RETURNS, f"SELECT date, {_pivot('round(r, 8)')} FROM returns GROUP BY date"
)
SQL["join_compare_symbols_long"] = _with(_SUPPLIER_BARS, "SELECT date, symbol, close AS value FROM bars")
SQL["join_returns_align_long"] = _with(
    _SUPPLIER_BARS + _RETURNS, "SELECT date, symbol, round(r, 8) AS value FROM returns"
)
SQL["join_original_corrected"] = _with(
    _LAYERS,
    """
SELECT symbol, count(*) FILTER (layer = 'original') AS original_rows,
       count(*) FILTER (layer = 'corrected') AS corrected_rows,
       CAST(sum(volume) FILTER (layer = 'original') AS BIGINT) AS original_volume,
       CAST(sum(volume) FILTER (layer = 'corrected') AS BIGINT) AS corrected_volume,
       count(*) FILTER (layer = 'corrected') - count(*) FILTER (layer = 'original') AS added_rows
FROM layers GROUP BY symbol""",
)
SQL["join_regressors"] = _with(
    _BARS,
    """
SELECT symbol, date, close, orders FROM bars
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1) USING (date)""",
)
SQL["join_forecast_actual"] = _with(
    _BARS,
    """
SELECT t.symbol, t.date, y.close AS p, t.close AS y
FROM bars t JOIN bars y ON y.symbol = t.symbol AND y.date = t.date - 1""",
)
SQL["anti_missing_symbols"] = _with(
    _BARS + _REQUESTED, "SELECT symbol FROM requested WHERE symbol NOT IN (SELECT symbol FROM bars)"
)
SQL["set_provider_precedence"] = _with(
    _BARS,
    f"""
SELECT symbol, date, CASE WHEN {_NUMBER} % 2 = 1 THEN close * 2 ELSE close END AS close,
       CAST(CASE WHEN {_NUMBER} % 2 = 1 THEN 1 ELSE 2 END AS INTEGER) AS priority FROM bars""",
)
SQL["set_dedup_keep_last"] = _with(
    _DIRTY,
    """
SELECT symbol, date, ingest_seq, close FROM dirty
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq DESC) = 1""",
)
SQL["fix_dedup_date"] = _with(
    _DIRTY, "SELECT symbol, date, max(ingest_seq) AS ingest_seq FROM dirty GROUP BY symbol, date"
)
SQL["set_missing_dates"] = _with(
    _BARS,
    """
, ranges AS (SELECT symbol, min(date) AS a, max(date) AS b FROM bars GROUP BY symbol)
SELECT symbol, CAST(d AS DATE) AS date
FROM ranges, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g(d)
WHERE (symbol, CAST(d AS DATE)) NOT IN (SELECT (symbol, date) FROM bars)""",
)

# --- validation ------------------------------------------------------------

for _rule, _select in _issue_selects("dirty").items():
    SQL[_rule] = _with(_DIRTY, _select)

_EVERY_ISSUE = "\nUNION ALL ".join(
    f"(SELECT symbol, rule_id, field, issue_type, severity, affected FROM ({s}))"
    for s in _issue_selects("dirty").values()
)
SQL["vr_issues"] = _with(_DIRTY, _EVERY_ISSUE)
SQL["vr_min_rows"] = _with(
    _BARS,
    f"""
SELECT symbol || ':' || strftime(date, '%Y-%m') AS symbol, '' AS field, {_spec('vr_min_rows')},
       count(*) AS affected FROM bars GROUP BY 1 HAVING count(*) < 5""",
)
SQL["vr_empty"] = _with(
    _BARS + _REQUESTED,
    f"""
SELECT symbol, '' AS field, {_spec('vr_empty')}, CAST(0 AS BIGINT) AS affected
FROM requested WHERE symbol NOT IN (SELECT symbol FROM bars)""",
)
SQL["vr_missing_columns"] = _with(
    _RAW,
    f"""
SELECT DISTINCT symbol, CASE WHEN b IN (1, 2) THEN 'adj_close' ELSE 'currency,exchange' END AS field,
       {_spec('vr_missing_columns')}, CAST(CASE WHEN b IN (1, 2) THEN 1 ELSE 2 END AS BIGINT) AS affected
FROM raw WHERE b IN (1, 2, 8)""",
)
SQL["vr_non_numeric"] = _with(
    _RAW,
    f"""
SELECT symbol, 'open' AS field, {_spec('vr_non_numeric')}, count(*) AS affected
FROM raw WHERE open_text = 'n/a' GROUP BY symbol
UNION ALL
SELECT symbol, 'close', {_spec('vr_non_numeric')}, count(*) FROM raw WHERE close_text = '' GROUP BY symbol""",
)
SQL["vr_volume_type"] = _with(
    _RAW,
    f"""
SELECT symbol, 'volume' AS field, 'vr_volume_type' AS rule_id, 'invalid_type' AS issue_type,
       CASE WHEN many > 0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
       CASE WHEN many > 0 THEN many ELSE odd END AS affected
FROM (SELECT symbol, count(*) FILTER (volume_text = 'many') AS many,
             count(*) FILTER (volume_text = '12.5') AS odd FROM raw GROUP BY symbol)
WHERE many + odd > 0""",
)
_HITS = "\nUNION ALL ".join(
    f"SELECT symbol, ingest_seq, date, '{rule}' AS rule_id, '{field}' AS field FROM dirty WHERE {condition}"
    for rule, field, condition in _ROW_CONDITIONS
)
SQL["vr_violations"] = _with(
    _DIRTY
    + """,
lagged AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq) AS copy,
         date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY ingest_seq), date) AS gap
  FROM dirty)""",
    _HITS
    + """
UNION ALL SELECT symbol, ingest_seq, date, 'vr_date_duplicate', '' FROM lagged WHERE copy > 1
UNION ALL SELECT symbol, ingest_seq, date, 'vr_date_order', '' FROM lagged WHERE gap < 0
UNION ALL SELECT symbol, ingest_seq, date, 'vr_gap_suspicious', '' FROM lagged WHERE gap > 7""",
)

SQL["vr_summary"] = _with(
    _MIXED_ISSUES + _BAD + _REPAIRED,
    """
SELECT s.symbol, count(*) FILTER (severity = 'CRITICAL') = 0 AS is_valid, count(rule_id) AS total_issues,
       count(*) FILTER (severity = 'CRITICAL') AS critical_count,
       count(*) FILTER (severity = 'WARNING') AS warning_count,
       count(*) FILTER (severity = 'INFO') AS info_count,
       count(*) FILTER (severity = 'CRITICAL') = 0 AS has_corrections
FROM (SELECT DISTINCT symbol FROM mixed) s LEFT JOIN every_issue USING (symbol) GROUP BY s.symbol""",
)
SQL["vr_gate"] = _with(
    _MIXED_ISSUES + _BAD,
    """
SELECT symbol, FALSE AS accepted, CAST(0 AS BIGINT) AS n_rows, reasons FROM bad
UNION ALL
SELECT symbol, TRUE, count(*), '' FROM mixed WHERE symbol NOT IN (SELECT symbol FROM bad) GROUP BY symbol""",
)

# --- corrections -----------------------------------------------------------

SQL["fix_sort"] = _with(
    _MIXED,
    """
, steps AS (SELECT symbol, date < lag(date) OVER (PARTITION BY symbol ORDER BY ingest_seq) AS back FROM mixed)
SELECT symbol, NOT coalesce(bool_or(back), FALSE) AS was_sorted, coalesce(bool_or(back), FALSE) AS out_of_order
FROM steps GROUP BY symbol""",
)
SQL["fix_dedup_date_issues"] = _with(
    _DIRTY,
    """
SELECT symbol, 'duplicate_dates' AS issue_type, 'INFO' AS severity, count(*) - count(DISTINCT date) AS affected
FROM dirty GROUP BY symbol HAVING count(*) > count(DISTINCT date)""",
)
SQL["fix_sort_issues"] = _with(
    _BARS,
    f"""
, seq AS (
  SELECT symbol, date, ingest_seq + CASE WHEN {_NUMBER} % 2 = 1 AND ingest_seq % 5 = 0 THEN 10000000 ELSE 0 END AS seq
  FROM bars),
steps AS (SELECT symbol, date < lag(date) OVER (PARTITION BY symbol ORDER BY seq) AS back FROM seq)
SELECT symbol, 'out_of_order' AS issue_type, 'INFO' AS severity, CAST(1 AS BIGINT) AS affected
FROM steps GROUP BY symbol HAVING bool_or(back)""",
)
SQL["fix_interpolate_issues"] = _with(
    _BARS + "," + _filled("bars"),
    """
SELECT symbol, 'missing_dates' AS issue_type, 'INFO' AS severity, count(*) AS affected
FROM corrected WHERE is_filled GROUP BY symbol""",
)
SQL["fix_missing_runs"] = _with(
    _BARS,
    """
, islands AS (
  SELECT symbol, d, d - CAST(row_number() OVER (PARTITION BY symbol ORDER BY d) AS INTEGER) AS island
  FROM (SELECT symbol, CAST(d AS DATE) AS d
        FROM (SELECT symbol, min(date) AS a, max(date) AS b FROM bars GROUP BY symbol),
             unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g(d)
        WHERE (symbol, CAST(d AS DATE)) NOT IN (SELECT (symbol, date) FROM bars)))
SELECT symbol, min(d) AS run_start, CAST(count(*) AS INTEGER) AS run_days FROM islands GROUP BY symbol, island""",
)
SQL["fix_insert_short_runs"] = _with(
    _BARS + "," + _filled("bars"),
    """
SELECT symbol, date, CASE WHEN is_filled THEN NULL ELSE close END AS close, volume, currency, exchange, is_filled
FROM corrected""",
)
SQL["fix_interpolate"] = _with(
    _BARS
    + ","
    + _filled(
        "bars",
        "CASE WHEN ingest_seq % 31 = 0 OR ingest_seq % 37 IN (0, 1, 2, 3) THEN NULL ELSE adj_close END",
    ),
    "SELECT symbol, date, open, high, low, close, adj_close, is_filled, ingest_seq FROM corrected",
)
SQL["fix_types"] = _with(
    _BARS,
    """
SELECT symbol, CAST(sum(CASE WHEN volume = 10 THEN 0 ELSE volume END) AS BIGINT) AS volume,
       count(*) FILTER (volume = 10) AS zeros,
       CAST(count(*) FILTER (volume = 10) > 0 AS BIGINT) AS columns_changed
FROM bars GROUP BY symbol""",
)
SQL["fix_corrected_layer"] = _with(_STORED, f"SELECT {_ELEVEN}, is_filled, ingest_seq FROM corrected")

# --- quality ---------------------------------------------------------------

_COMPLETE = """
SELECT symbol, a AS start_date, b AS end_date, CAST(b - a + 1 AS INTEGER) AS total_days,
       o AS original_records, c AS corrected_records,
       CAST(floor((b - a + 1) * 5 / 7) AS BIGINT) AS expected_trading_days,
       round(o / ((b - a + 1) * 5 / 7) * 100, 2) AS completeness_original_pct,
       round(c / ((b - a + 1) * 5 / 7) * 100, 2) AS completeness_corrected_pct
FROM (SELECT symbol, min(date) FILTER (layer = 'original') AS a, max(date) FILTER (layer = 'original') AS b,
             count(*) FILTER (layer = 'original') AS o, count(*) FILTER (layer = 'corrected') AS c
      FROM layers GROUP BY symbol)"""
SQL["dq_completeness"] = _with(_LAYERS, _COMPLETE)
_GAPS = """
gaps AS (
  SELECT symbol, g, count(*) AS n
  FROM (SELECT symbol, date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS g FROM {0})
  WHERE g > 1 GROUP BY symbol, g)"""
SQL["dq_gap_distribution"] = _with(
    _BARS + "," + _GAPS.format("bars"),
    """
SELECT symbol, CAST(sum(n) AS BIGINT) AS total_gaps, CAST(max(g) AS INTEGER) AS largest_gap,
       string_agg(g || '_days=' || n, ',' ORDER BY g || '_days=' || n) AS gap_distribution
FROM gaps GROUP BY symbol""",
)
SQL["dq_gaps_filled"] = _with(
    _STORED, "SELECT symbol, count(*) FILTER (is_filled) AS gaps_filled FROM corrected GROUP BY symbol"
)
SQL["dq_forecast_readiness"] = _with(
    _BARS,
    """
SELECT symbol, n_rows, largest_gap, positive_close,
       n_rows >= 252 AND largest_gap <= 7 AND positive_close AS ready
FROM (SELECT symbol, count(*) AS n_rows, CAST(max(g) AS INTEGER) AS largest_gap,
             min(close) > 0 AS positive_close
      FROM (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS g FROM bars)
      GROUP BY symbol)""",
)
SQL["dq_null_counts"] = _with(
    _DIRTY,
    "SELECT symbol, "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}_nulls" for c in ("open", "high", "low", "close", "volume")
    )
    + " FROM dirty GROUP BY symbol",
)
SQL["dq_duplicate_dates"] = _with(
    _DIRTY, "SELECT symbol, count(*) - count(DISTINCT date) AS duplicates FROM dirty GROUP BY symbol"
)
SQL["dq_is_sorted"] = _with(
    _MIXED,
    """
, steps AS (SELECT symbol, date < lag(date) OVER (PARTITION BY symbol ORDER BY ingest_seq) AS back FROM mixed)
SELECT symbol, NOT coalesce(bool_or(back), FALSE) AS is_sorted FROM steps GROUP BY symbol""",
)
SQL["dq_report"] = _with(
    _STORED
    + _PERIOD
    + ","
    + _GAPS.format("even")
    + """,
layers AS (
  SELECT 'original' AS layer, symbol, date FROM even
  UNION ALL SELECT 'corrected', symbol, date FROM corrected),
complete AS ("""
    + _COMPLETE
    + """),
total AS (SELECT symbol, CAST(sum(n) AS BIGINT) AS total_gaps, CAST(max(g) AS INTEGER) AS largest FROM gaps GROUP BY symbol)""",
    """
SELECT symbol, strftime(d, '%Y-%m') AS period, total_days, original_records, corrected_records,
       completeness_original_pct, completeness_corrected_pct, total_gaps,
       corrected_records - original_records AS gaps_filled_by_validation, largest AS largest_gap_days,
       TRUE AS is_valid, CAST(0 AS BIGINT) AS close_nulls, CAST(0 AS BIGINT) AS has_duplicates, TRUE AS is_sorted
FROM complete JOIN latest USING (symbol) JOIN total USING (symbol)""",
)


def _layer_stats(layer: str) -> str:
    only = f"FILTER (layer = '{layer}')"
    return f"""
count(*) {only} AS {layer}_records, round(avg(close) {only}, 3) AS {layer}_mean_close,
round(stddev_samp(close) {only}, 3) AS {layer}_std_close, min(close) {only} AS {layer}_min_close,
max(close) {only} AS {layer}_max_close, CAST(trunc(avg(volume) {only}) AS BIGINT) AS {layer}_mean_volume,
CAST(sum(volume) {only} AS BIGINT) AS {layer}_total_volume"""


SQL["dq_orig_vs_corrected"] = _with(
    _LAYERS,
    f"""
SELECT symbol, {_layer_stats('original')}, {_layer_stats('corrected')},
       count(*) FILTER (layer = 'corrected') - count(*) FILTER (layer = 'original') AS added_records
FROM layers GROUP BY symbol""",
)

# --- analytics -------------------------------------------------------------

SQL["ana_daily_return"] = _with(
    _BARS + _RETURNS, "SELECT symbol, date, close, round(r, 8) AS daily_return FROM returns"
)


def _period(label: str, series: str, name: str) -> str:
    return f"""
, labelled AS (SELECT *, {label} AS pe FROM bars),
closes AS (SELECT symbol, pe, arg_max(close, date) AS close FROM labelled GROUP BY symbol, pe),
spine AS (
  SELECT symbol, {series} AS pe
  FROM (SELECT symbol, min(pe) AS a, max(pe) AS b FROM closes GROUP BY symbol),
       unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g(d) GROUP BY 1, 2),
padded AS (
  SELECT s.symbol, s.pe, c.close,
         last_value(c.close IGNORE NULLS) OVER (PARTITION BY s.symbol ORDER BY s.pe
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known
  FROM spine s LEFT JOIN closes c ON c.symbol = s.symbol AND c.pe = s.pe)
SELECT symbol, pe AS period_end, close,
       round(known / lag(known) OVER (PARTITION BY symbol ORDER BY pe) - 1, 8) AS {name}
FROM padded"""


_SUNDAY = "CAST(date_trunc('week', {0}) AS DATE) + 6"
SQL["ana_weekly_return"] = _with(
    _BARS, _period(_SUNDAY.format("date"), _SUNDAY.format("CAST(d AS DATE)"), "weekly_return")
)
SQL["ana_monthly_return"] = _with(
    _BARS, _period("last_day(date)", "last_day(CAST(d AS DATE))", "monthly_return")
)
_VOLATILITY = """
round(stddev_samp(r), 6) AS daily_volatility,
round(stddev_samp(r) * sqrt(252) * 100, 4) AS annualized_volatility_pct,
round(arg_max(rv, date), 6) AS current_rolling_vol, round(max(rv), 6) AS max_rolling_vol,
round(min(rv), 6) AS min_rolling_vol"""
_DRAWDOWN = """
round(min(dd) * 100, 6) AS maximum_drawdown_pct, arg_min(date, row(dd, date)) AS max_drawdown_date,
round(arg_max(dd, date) * 100, 6) AS current_drawdown_pct,
count(*) FILTER (dd < 0) AS days_in_drawdown"""
SQL["ana_volatility"] = _with(
    _BARS + _ROLLING, f"SELECT symbol, {_VOLATILITY} FROM risk GROUP BY symbol"
)
SQL["ana_rolling_volatility"] = _with(
    _BARS + _ROLLING, "SELECT symbol, date, round(rv, 6) AS rolling_vol FROM risk"
)
SQL["ana_drawdown"] = _with(_BARS + _ROLLING, f"SELECT symbol, {_DRAWDOWN} FROM risk GROUP BY symbol")
SQL["ana_drawdown_days"] = _with(
    _BARS + _ROLLING,
    "SELECT symbol, count(*) FILTER (dd < 0) AS days_in_drawdown FROM risk GROUP BY symbol",
)
_SUMMARY = f"""
SELECT symbol, min(date) AS start_date, max(date) AS end_date, count(*) AS trading_days,
       arg_min(close, date) AS start_price, arg_max(close, date) AS end_price,
       round((arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100, 6) AS total_return_pct,
       arg_max(close, date) - arg_min(close, date) AS price_change,
       max(high) AS highest_price, arg_min(date, row(-high, date)) AS highest_price_date,
       min(low) AS lowest_price, arg_min(date, row(low, date)) AS lowest_price_date,
       CAST(trunc(avg(volume)) AS BIGINT) AS average_volume, max(volume) AS max_volume,
       arg_min(date, row(-volume, date)) AS max_volume_date, CAST(sum(volume) AS BIGINT) AS total_volume,
       {_VOLATILITY}, {_DRAWDOWN}
FROM risk GROUP BY symbol"""
SQL["ana_summary"] = _with(_BARS + _ROLLING, _SUMMARY)
SQL["ana_summary_by_supplier"] = _with(_SUPPLIER_BARS + _ROLLING, _SUMMARY)
SQL["ana_volume_stats"] = _with(
    _BARS,
    """
SELECT symbol, CAST(trunc(avg(volume)) AS BIGINT) AS average_volume,
       CAST(trunc(stddev_samp(volume)) AS BIGINT) AS std_volume,
       CAST(trunc(quantile_cont(volume, 0.5)) AS BIGINT) AS median_volume,
       max(volume) AS max_volume, min(volume) AS min_volume, count(*) FILTER (volume = 0) AS zero_volume_days
FROM bars GROUP BY symbol""",
)
SQL["ana_volume_anomaly"] = _with(
    _BARS,
    """
SELECT symbol, date, volume, round(z, 6) AS zscore
FROM (SELECT *, (volume - avg(volume) OVER w) / nullif(stddev_samp(volume) OVER w, 0) AS z
      FROM bars WINDOW w AS (PARTITION BY symbol)) WHERE abs(z) > 2""",
)
SQL["ana_volume_top10_share"] = _with(
    _BARS,
    """
SELECT symbol, round(sum(volume) FILTER (n <= 10) / sum(volume) * 100, 6) AS top_10_days_volume_pct
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY volume DESC) AS n FROM bars) GROUP BY symbol""",
)
SQL["ana_correlation"] = _with(
    _BARS + _RETURNS,
    """
, pairs AS (
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, corr(a.r, b.r) AS c
  FROM returns a JOIN returns b USING (date) WHERE a.r IS NOT NULL AND b.r IS NOT NULL AND a.symbol <= b.symbol GROUP BY 1, 2)
SELECT symbol_a, symbol_b, round(c, 6) AS correlation,
       CASE WHEN c > 0.7 THEN 'high' WHEN c > 0.3 THEN 'medium' WHEN c IS NOT NULL THEN 'low' END AS strength
FROM pairs""",
)
SQL["ana_compare_periods"] = _with(
    _BARS
    + f""",
snaps AS (SELECT b.*, y FROM bars b, {_EVERY_YEAR} WHERE year(date) <= y),
moves AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol, y ORDER BY date) - 1 AS r FROM snaps),
found AS (
  SELECT symbol, y || '-12' AS period,
         (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100 AS a,
         stddev_samp(r) * sqrt(252) * 100 AS b, CAST(trunc(avg(volume)) AS DOUBLE) AS c
  FROM moves GROUP BY symbol, y)""",
    """
SELECT symbol, period, round(a, 4) AS value, 'return' AS metric FROM found
UNION ALL SELECT symbol, period, round(b, 4), 'volatility' FROM found
UNION ALL SELECT symbol, period, round(c, 4), 'volume' FROM found""",
)

# --- features --------------------------------------------------------------


def _window(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(fn: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {_window(n)} = {n} THEN {fn}({x}) OVER {_window(n)} END"


_STEPS = """,
lagged AS (
  SELECT *, lag(close) OVER w AS pc, lag(high) OVER w AS ph, lag(low) OVER w AS pl
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
steps AS (
  SELECT *, CASE WHEN close > pc THEN close - pc ELSE 0 END AS gain,
         CASE WHEN close < pc THEN pc - close ELSE 0 END AS loss,
         CASE WHEN pc IS NULL THEN high - low
              ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
         CASE WHEN high - ph < 0 THEN 0 ELSE high - ph END AS up,
         CASE WHEN pl - low < 0 THEN 0 ELSE pl - low END AS down,
         CASE WHEN close > pc THEN volume WHEN close < pc THEN -volume ELSE 0 END AS signed,
         (high + low + close) / 3 * volume AS turnover
  FROM lagged)"""
_RUNNING = "OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)"
_SMA20, _STD20 = _full("avg", "close", 20), _full("stddev_samp", "close", 20)
_GAIN, _LOSS = _full("avg", "gain", 14), _full("avg", "loss", 14)
_LINE = "OVER (PARTITION BY symbol ORDER BY date)"

_FEATURE_COLUMNS: dict[str, dict[str, str]] = {
    "ft_sma": {f"sma_{n}": f"round({_full('avg', 'close', n)}, 3)" for n in (5, 10, 20, 50, 200)},
    "ft_rsi": {
        "rsi": f"round(CASE WHEN {_LOSS} = 0 AND {_GAIN} > 0 THEN 100 "
        f"ELSE 100 - 100 / (1 + {_GAIN} / nullif({_LOSS}, 0)) END, 6)"
    },
    "ft_roc": {
        "roc": f"round((close - lag(close, 12) {_LINE}) / nullif(lag(close, 12) {_LINE}, 0) * 100, 6)"
    },
    "ft_bollinger": {
        "bb_middle": f"round({_SMA20}, 2)",
        "bb_upper": f"round({_SMA20} + 2 * {_STD20}, 2)",
        "bb_lower": f"round({_SMA20} - 2 * {_STD20}, 2)",
        "bb_width": f"round(4 * {_STD20} / nullif({_SMA20}, 0), 6)",
    },
    "ft_atr": {"atr": f"round({_full('avg', 'tr', 14)}, 2)"},
    "ft_obv": {"obv": f"CAST(sum(signed) {_RUNNING} AS BIGINT)"},
    "ft_vwap": {"vwap": f"round(sum(turnover) {_RUNNING} / nullif(sum(volume) {_RUNNING}, 0), 2)"},
    "ft_returns": {
        f"return_{k}d": f"round((close / nullif(lag(close, {k}) {_LINE}, 0) - 1) * 100, 6)"
        for k in (1, 5, 10)
    },
    "ft_log_return": {
        "log_return": "round(CASE WHEN close / nullif(pc, 0) > 0 THEN ln(close / pc) END, 8)"
    },
    "ft_trend_strength": {
        "trend_strength": f"round({_full('avg', 'up', 14)} - {_full('avg', 'down', 14)}, 2)"
    },
}
for _name, _columns in _FEATURE_COLUMNS.items():
    _list = ", ".join(f"{v} AS {k}" for k, v in _columns.items())
    SQL[_name] = _with(_BARS + _STEPS, f"SELECT symbol, date, {_list} FROM steps")

# The recursion of the definition, one row after the other.
_EMA = """,
ema AS (
  SELECT symbol, ingest_seq, date, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS sig
  FROM bars WHERE ingest_seq = 1
  UNION ALL
  SELECT b.symbol, b.ingest_seq, b.date,
         b.close * (2/13.0) + e.e12 * (11/13.0), b.close * (2/27.0) + e.e26 * (25/27.0),
         0.2 * ((b.close * (2/13.0) + e.e12 * (11/13.0)) - (b.close * (2/27.0) + e.e26 * (25/27.0))) + 0.8 * e.sig
  FROM ema e JOIN bars b ON b.symbol = e.symbol AND b.ingest_seq = e.ingest_seq + 1)"""
# The recursion reads the bars in every step, so they are computed once.
_STATIC_BARS = _BARS.replace("bars AS (", "bars AS MATERIALIZED (")
SQL["ft_ema"] = _recursive(
    _STATIC_BARS + _EMA, "SELECT symbol, date, round(e12, 2) AS ema_12, round(e26, 2) AS ema_26 FROM ema"
)
_MACD = "round(e12 - e26, 2) AS macd, round(sig, 2) AS macd_signal, round(e12 - e26 - sig, 2) AS macd_hist"
SQL["ft_macd"] = _recursive(_STATIC_BARS + _EMA, f"SELECT symbol, date, {_MACD} FROM ema")
_ALL_COLUMNS = ", ".join(
    f"{v} AS {k}" for cols in _FEATURE_COLUMNS.values() for k, v in cols.items() if k != "sma_200"
)
SQL["ft_all"] = _recursive(
    _STATIC_BARS + _EMA + _STEPS,
    f"""
SELECT symbol, date, open, high, low, close, adj_close, volume, {_ALL_COLUMNS},
       round(e12, 2) AS ema_12, round(e26, 2) AS ema_26, {_MACD}
FROM steps JOIN ema USING (symbol, date)""",
)

# --- accuracy --------------------------------------------------------------

_PAIRS = (
    _BARS
    + """,
forecasts AS (
  SELECT symbol, date, close AS y, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS naive,
         CASE WHEN count(close) OVER w = 5 THEN avg(close) OVER w END AS sma5
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
pairs AS (
  SELECT symbol, date, 'naive' AS model, y, naive AS p FROM forecasts WHERE naive IS NOT NULL
  UNION ALL SELECT symbol, date, 'sma5', y, sma5 FROM forecasts WHERE sma5 IS NOT NULL),
moved AS (
  SELECT *, y - lag(y) OVER w AS dy, p - lag(p) OVER w AS dp, avg(y) OVER (PARTITION BY symbol, model) AS my
  FROM pairs WINDOW w AS (PARTITION BY symbol, model ORDER BY date))"""
)
_METRICS = {
    "rmse": "round(sqrt(avg((y - p) ** 2)), 4)",
    "mae": "round(avg(abs(y - p)), 4)",
    "mape": "round(avg(abs((y - p) / y)) FILTER (y <> 0) * 100, 6)",
    "r2": "round(1 - sum((y - p) ** 2) / nullif(sum((y - my) ** 2), 0), 6)",
    "directional_accuracy": "round(avg(CASE WHEN (dy > 0) = (dp > 0) THEN 1.0 ELSE 0.0 END) "
    "FILTER (dy IS NOT NULL) * 100, 6)",
    "smape": "round(avg(2 * abs(y - p) / (abs(y) + abs(p))) FILTER (abs(y) + abs(p) <> 0) * 100, 6)",
}
_METRIC_NAMES = {
    "fm_rmse": "rmse",
    "fm_mae": "mae",
    "fm_mape": "mape",
    "fm_r2": "r2",
    "fm_directional": "directional_accuracy",
    "fm_smape": "smape",
}
for _name, _metric in _METRIC_NAMES.items():
    SQL[_name] = _with(
        _PAIRS, f"SELECT symbol, model, {_METRICS[_metric]} AS {_metric} FROM moved GROUP BY symbol, model"
    )
_EXACT_SCORES = "SELECT symbol, model, " + ", ".join(
    f"{v[len('round('):v.rindex(',')]} AS {k}" for k, v in _METRICS.items()
) + " FROM moved GROUP BY symbol, model"
_SCORES = "SELECT symbol, model, " + ", ".join(f"{v} AS {k}" for k, v in _METRICS.items()) + (
    " FROM moved GROUP BY symbol, model"
)
SQL["fm_all"] = _with(_PAIRS, _SCORES)
SQL["fm_compare_models"] = _with(
    _PAIRS + f",\nscores AS ({_EXACT_SCORES})",
    "\nUNION ALL ".join(
        f"SELECT symbol, '{m}' AS metric, arg_min(model, row({sign}{m}, model)) AS best_model, "
        f"round({best}({m}), 4) AS value FROM scores GROUP BY symbol"
        for m, sign, best in (
            ("rmse", "", "min"),
            ("mae", "", "min"),
            ("mape", "", "min"),
            ("r2", "-", "max"),
            ("directional_accuracy", "-", "max"),
        )
    ),
)

# --- forecast (the fitted values have no SQL form) --------------------------

SQL["fc_prepare"] = _with(
    _DIRTY, "SELECT symbol, date AS ds, close AS y FROM dirty WHERE volume <> 0"
)
def _line(source: str) -> str:
    """Table ``line``: a straight line through each symbol's closes, by least squares."""
    return f""",
placed AS (
  SELECT *, date_diff('day', min(date) OVER (PARTITION BY symbol), date)
              / date_diff('day', min(date) OVER (PARTITION BY symbol), max(date) OVER (PARTITION BY symbol)) AS t
  FROM {source}),
line AS (
  SELECT symbol, count(*) AS n, min(date) AS a, max(date) AS b,
         CAST(date_diff('day', min(date), max(date)) AS DOUBLE) AS days,
         regr_intercept(close, t) AS level, regr_slope(close, t) AS slope,
         sqrt((regr_syy(close, t) - regr_sxy(close, t) ** 2 / regr_sxx(close, t)) / count(*)) AS sigma
  FROM placed GROUP BY symbol)"""


SQL["fc_fit_line"] = _with(
    _BARS + _line("bars"),
    """
SELECT symbol, n, days, round(level, 4) AS start_level, round(slope, 4) AS change, round(sigma, 4) AS deviation
FROM line""",
)
SQL["fc_predict_line"] = _with(
    _BARS + _line("bars"),
    """
, ahead AS (
  SELECT symbol, b + CAST(k AS INTEGER) AS date, sigma,
         level + slope * (date_diff('day', a, b) + k) / days AS p
  FROM line, unnest(generate_series(1, 30)) AS g(k))
SELECT symbol, date, round(p, 4) AS predicted_price, round(p - 1.2816 * sigma, 4) AS lower_bound,
       round(p + 1.2816 * sigma, 4) AS upper_bound
FROM ahead""",
)
SQL["fc_evaluate_line"] = _with(
    _BARS
    + ",\ntrain AS (SELECT * FROM bars WHERE date <= DATE '2000-12-31')"
    + _line("train"),
    """
, scored AS (
  SELECT symbol, close - (level + slope * date_diff('day', a, date) / days) AS e
  FROM bars JOIN line USING (symbol) WHERE date > DATE '2000-12-31')
SELECT symbol, round(sqrt(avg(e ** 2)), 4) AS rmse, round(avg(abs(e)), 4) AS mae FROM scored GROUP BY symbol""",
)
_BEND = """,
placed AS (
  SELECT symbol, date, close AS y,
         date_diff('day', min(date) OVER w, date) / date_diff('day', min(date) OVER w, max(date) OVER w) AS t
  FROM bars WINDOW w AS (PARTITION BY symbol)),
centred AS (
  SELECT symbol, date, y, t, greatest(t - 0.5, 0) AS k, t - avg(t) OVER w AS dt, y - avg(y) OVER w AS dy,
         greatest(t - 0.5, 0) - avg(greatest(t - 0.5, 0)) OVER w AS dk
  FROM placed WINDOW w AS (PARTITION BY symbol)),
moments AS (
  SELECT symbol, count(*) AS n, min(date) AS a, max(date) AS b, CAST(date_diff('day', min(date), max(date)) AS DOUBLE) AS days,
         avg(y) AS my, avg(t) AS mt, avg(k) AS mk, max(abs(y)) AS scale,
         sum(dt * dt) AS tt, sum(dk * dk) AS kk, sum(dt * dk) AS tk, sum(dt * dy) AS ty, sum(dk * dy) AS ky, sum(dy * dy) AS yy
  FROM centred GROUP BY symbol),
solved AS (
  SELECT *, (ty * kk - ky * tk) / (tt * kk - tk * tk) AS slope, (ky * tt - ty * tk) / (tt * kk - tk * tk) AS bend FROM moments),
bent AS (
  SELECT *, my - slope * mt - bend * mk AS level, sqrt((yy - slope * ty - bend * ky) / n) AS sigma FROM solved)"""

SQL["fc_fit_bend"] = _with(
    _BARS + _BEND,
    """
SELECT symbol, round(level, 4) AS start_level, round(slope, 4) AS change, round(bend, 4) AS bend, round(sigma, 4) AS deviation
FROM bent""",
)
# Changes come at the rate 1 / 0.5 with |bend| as their scale.
SQL["fc_predict_bend"] = _with(
    _BARS + _BEND,
    """
, ahead AS (
  SELECT symbol, b + CAST(i AS INTEGER) AS date, level + slope * (1 + i / days) + bend * (0.5 + i / days) AS p,
         1.2816 * sqrt(sigma ** 2 + 2 / 3 * (1 / 0.5) * bend ** 2 * (i / days) ** 3) AS reach
  FROM bent, unnest(generate_series(1, 400)) AS g(i))
SELECT symbol, date, round(p, 3) AS predicted_price, round(p - reach, 3) AS lower_bound, round(p + reach, 3) AS upper_bound
FROM ahead""",
)
SQL["fc_changepoints_bend"] = _with(
    _BARS + _BEND,
    """
SELECT symbol, 1 AS rank, a + CAST(floor(0.5 * days) AS INTEGER) AS date, round(bend / scale, 4) AS delta FROM bent""",
)


def _logistic(steps: int) -> str:
    """Tables ``theta0`` (the line through the logits) to ``theta<steps>``: Gauss-Newton steps."""
    parts = [
        """,
ends AS (SELECT symbol, max(close) * 1.3 AS cap, min(close) * 0.5 AS floor, min(date) AS a, max(date) AS b FROM bars GROUP BY symbol),
room AS (
  SELECT symbol, close - floor AS y, cap - floor AS c, date_diff('day', a, date) / date_diff('day', a, b) AS t
  FROM bars JOIN ends USING (symbol)),
logits AS (SELECT symbol, t, ln(p / (1 - p)) AS z FROM (SELECT symbol, t, least(greatest(y / c, 0.01), 0.99) AS p FROM room)),
theta0 AS (SELECT symbol, regr_intercept(z, t) AS u, regr_slope(z, t) AS v FROM logits GROUP BY symbol)"""
    ]
    for i in range(1, steps + 1):
        parts.append(f""",
rows{i} AS (
  SELECT symbol, u, v, t, y - c * s AS r, c * s * (1 - s) AS g
  FROM (SELECT symbol, u, v, t, y, c, 1 / (1 + exp(-(u + v * t))) AS s FROM room JOIN theta{i - 1} USING (symbol))),
sums{i} AS (
  SELECT symbol, any_value(u) AS u, any_value(v) AS v, sum(g * g) AS p, sum(g * g * t) AS q, sum(g * g * t * t) AS w,
         sum(g * r) AS d, sum(g * t * r) AS e
  FROM rows{i} GROUP BY symbol),
theta{i} AS (
  SELECT symbol, u + (d * w - e * q) / (p * w - q * q) AS u, v + (e * p - d * q) / (p * w - q * q) AS v FROM sums{i})""")
    return "".join(parts)


SQL["fc_logistic_step"] = _with(
    _BARS + _logistic(1),
    """
SELECT symbol, count(*) AS n, round(any_value(u), 5) AS level, round(any_value(v), 5) AS rate
FROM room JOIN theta1 USING (symbol) GROUP BY symbol""",
)
_SETTLED = ",\nsettled AS (SELECT symbol, u, v, sqrt(avg((y - c / (1 + exp(-(u + v * t)))) ** 2)) AS sigma, count(*) AS n FROM room JOIN theta20 USING (symbol) GROUP BY ALL)"
SQL["fc_fit_logistic"] = _with(
    _BARS + _logistic(20) + _SETTLED,
    """
SELECT symbol, n, round(u, 5) AS level, round(v, 5) AS rate, round(sigma, 4) AS deviation, true AS converged FROM settled""",
)
SQL["fc_predict_logistic"] = _with(
    _BARS + _logistic(20) + _SETTLED,
    """
, ahead AS (
  SELECT symbol, b + CAST(i AS INTEGER) AS date, sigma,
         floor + (cap - floor) / (1 + exp(-(u + v * (1 + i / date_diff('day', a, b))))) AS p
  FROM settled JOIN ends USING (symbol), unnest(generate_series(1, 30)) AS g(i))
SELECT symbol, date, round(p, 3) AS predicted_price, round(p - 1.2816 * sigma, 3) AS lower_bound,
       round(p + 1.2816 * sigma, 3) AS upper_bound
FROM ahead""",
)
SQL["fc_future_frame"] = _with(
    _BARS,
    """
SELECT symbol, date AS ds FROM bars
UNION ALL
SELECT symbol, d + CAST(k AS INTEGER) FROM (SELECT symbol, max(date) AS d FROM bars GROUP BY symbol),
       unnest(generate_series(1, 30)) AS g(k)""",
)
_HOLIDAYS = {
    "holiday_new_year_s_day": "01-01",
    "holiday_independence_day": "07-04",
    "holiday_veterans_day": "11-11",
    "holiday_christmas_day": "12-25",
}
SQL["fc_holidays"] = _with(
    _BARS,
    "SELECT symbol, date, "
    + ", ".join(
        f"CAST(strftime(date, '%m-%d') = '{d}' AS DOUBLE) AS {n}" for n, d in _HOLIDAYS.items()
    )
    + " FROM bars",
)

SQL["fc_holiday_table"] = _with(
    _BARS,
    """
, named AS (
  SELECT symbol, date, CASE
    WHEN strftime(date, '%m-%d') = '01-01' THEN 'New Year''s Day'
    WHEN strftime(date, '%m-%d') = '07-04' THEN 'Independence Day'
    WHEN strftime(date, '%m-%d') = '11-11' THEN 'Veterans Day'
    WHEN strftime(date, '%m-%d') = '12-25' THEN 'Christmas Day'
    WHEN strftime(date, '%m-%d') = '06-19' AND year(date) >= 2021 THEN 'Juneteenth'
    WHEN isodow(date) = 1 AND month(date) = 1 AND ceil(day(date) / 7) = 3 THEN 'Martin Luther King Day'
    WHEN isodow(date) = 1 AND month(date) = 2 AND ceil(day(date) / 7) = 3 THEN 'Washington''s Birthday'
    WHEN isodow(date) = 1 AND month(date) = 5 AND month(date + 7) = 6 THEN 'Memorial Day'
    WHEN isodow(date) = 1 AND month(date) = 9 AND day(date) <= 7 THEN 'Labor Day'
    WHEN isodow(date) = 1 AND month(date) = 10 AND ceil(day(date) / 7) = 2 THEN 'Columbus Day'
    WHEN isodow(date) = 4 AND month(date) = 11 AND ceil(day(date) / 7) = 4 THEN 'Thanksgiving' END AS holiday
  FROM bars)
SELECT symbol, date, holiday FROM named WHERE holiday IS NOT NULL""",
)

def _calendar() -> str:
    """Table ``calendar`` (country, name, day) of all years in the data; Easter by the paschal full moon."""
    easter = """
years AS (SELECT DISTINCT CAST(year(date) + i AS INTEGER) AS y FROM bars, unnest([-1, 0, 1]) AS g(i)),
moons AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
ages AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM moons),
weeks AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM ages),
steps AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM weeks),
easters AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM steps),"""
    fixed = {
        "BE": "1-1 New Year's Day|5-1 Labour Day|7-21 National Day|8-15 Assumption Day|11-1 All Saints' Day|11-11 Armistice Day|12-25 Christmas Day",
        "BR": "1-1 New Year's Day|4-21 Tiradentes|5-1 Labour Day|9-7 Independence Day|10-12 Our Lady of Aparecida|11-2 All Souls' Day|11-15 Republic Day|12-25 Christmas Day",
        "CH": "1-1 New Year's Day|8-1 National Day|12-25 Christmas Day",
        "DE": "1-1 New Year's Day|5-1 Labour Day|10-3 Unity Day|12-25 Christmas Day|12-26 Second Christmas Day",
        "ES": "1-1 New Year's Day|1-6 Epiphany|5-1 Labour Day|8-15 Assumption Day|10-12 National Day|11-1 All Saints' Day|12-6 Constitution Day|12-8 Immaculate Conception|12-25 Christmas Day",
        "FR": "1-1 New Year's Day|5-1 Labour Day|5-8 Victory Day|7-14 Bastille Day|8-15 Assumption Day|11-1 All Saints' Day|11-11 Armistice Day|12-25 Christmas Day",
        "GB": "1-1 New Year's Day|12-25 Christmas Day|12-26 Boxing Day",
        "IT": "1-1 New Year's Day|1-6 Epiphany|4-25 Liberation Day|5-1 Labour Day|6-2 Republic Day|8-15 Assumption Day|11-1 All Saints' Day|12-8 Immaculate Conception|12-25 Christmas Day|12-26 Saint Stephen's Day",
        "NL": "1-1 New Year's Day|12-25 Christmas Day|12-26 Second Christmas Day",
        "SE": "1-1 New Year's Day|1-6 Epiphany|5-1 Labour Day|12-25 Christmas Day|12-26 Second Christmas Day",
        "US": "1-1 New Year's Day|7-4 Independence Day|11-11 Veterans Day|12-25 Christmas Day",
    }
    later = [("NL", 4, 27, "King's Day", 2014), ("BR", 11, 20, "Black Consciousness Day", 2024), ("US", 6, 19, "Juneteenth", 2021), ("SE", 6, 6, "National Day", 2005)]
    moved = {
        "BR": "-48 Carnival Monday|-47 Carnival Tuesday|-2 Good Friday|60 Corpus Christi",
        "DE": "-2 Good Friday|1 Easter Monday|39 Ascension Day|50 Whit Monday",
        "FR": "1 Easter Monday|39 Ascension Day|50 Whit Monday",
        "GB": "-2 Good Friday|1 Easter Monday",
        "NL": "-2 Good Friday|1 Easter Monday|39 Ascension Day|50 Whit Monday",
        "ES": "-2 Good Friday",
        "IT": "1 Easter Monday",
        "CH": "-2 Good Friday|1 Easter Monday|39 Ascension Day|50 Whit Monday",
        "BE": "1 Easter Monday|39 Ascension Day|50 Whit Monday",
        "SE": "-2 Good Friday|1 Easter Monday|39 Ascension Day",
    }
    # Country, name, and the span of days in which one weekday (Monday is 1) is the holiday.
    spans = [
        ("US", "Martin Luther King Day", 1, 15, 1), ("US", "Washington's Birthday", 2, 15, 1), ("US", "Memorial Day", 5, 25, 1),
        ("US", "Labor Day", 9, 1, 1), ("US", "Columbus Day", 10, 8, 1), ("US", "Thanksgiving", 11, 22, 4),
        ("GB", "Early May Bank Holiday", 5, 1, 1), ("GB", "Spring Bank Holiday", 5, 25, 1), ("GB", "Summer Bank Holiday", 8, 25, 1),
        ("SE", "Midsummer Day", 6, 20, 6), ("SE", "All Saints' Day", 10, 31, 6),
    ]
    quoted = lambda x: x.replace("'", "''")
    rows = []
    for country, text in fixed.items():
        for entry in text.split("|"):
            day, name = entry.split(" ", 1)
            m, d = day.split("-")
            rows.append(f"SELECT '{country}' AS country, '{quoted(name)}' AS name, make_date(y, {m}, {d}) AS day FROM years")
    rows += [f"SELECT '{c}', '{quoted(n)}', make_date(y, {m}, {d}) FROM years WHERE y >= {s}" for c, m, d, n, s in later]
    for country, text in moved.items():
        for entry in text.split("|"):
            days, name = entry.split(" ", 1)
            rows.append(f"SELECT '{country}', '{name}', easter + ({days}) FROM easters")
    rows += [
        f"SELECT '{c}', '{quoted(n)}', make_date(y, {m}, {d}) + CAST(({w} - isodow(make_date(y, {m}, {d})) + 7) % 7 AS INTEGER) FROM years"
        for c, n, m, d, w in spans
    ]
    observed = """,
observed AS (
  SELECT country, name || ' (observed)' AS name, CASE
    WHEN country = 'US' AND isodow(day) = 6 THEN day - 1 WHEN country = 'US' AND isodow(day) = 7 THEN day + 1
    WHEN name = 'New Year''s Day' AND isodow(day) = 6 THEN day + 2 WHEN name = 'New Year''s Day' AND isodow(day) = 7 THEN day + 1
    WHEN isodow(day) >= 6 THEN day + 2 END AS day
  FROM calendar WHERE isodow(day) >= 6 AND (
    country = 'US' AND name IN ('New Year''s Day', 'Juneteenth', 'Independence Day', 'Veterans Day', 'Christmas Day')
    OR country = 'GB' AND name IN ('New Year''s Day', 'Christmas Day', 'Boxing Day')))"""
    return "," + easter + "\ncalendar AS (" + "\nUNION ALL ".join(rows) + ")" + observed


SQL["fc_country_holidays"] = _with(
    _BARS + _calendar(),
    """
SELECT symbol, date, country, name AS holiday
FROM bars JOIN (SELECT * FROM calendar UNION ALL SELECT * FROM observed) ON date = day""",
)

# --- runs ------------------------------------------------------------------

_STATUS = (
    _MIXED_ISSUES
    + _BAD
    + _REQUESTED
    + ",\neven AS (SELECT * FROM mixed WHERE symbol NOT IN (SELECT symbol FROM bad)),"
    + _filled("even")
    + """,
saved AS (SELECT symbol, count(*) AS n FROM corrected GROUP BY symbol),
status AS (
  SELECT r.symbol, CASE WHEN m.symbol IS NULL THEN 'skipped' WHEN b.symbol IS NOT NULL THEN 'failed'
           ELSE 'successful' END AS status,
         CASE WHEN m.symbol IS NOT NULL AND b.symbol IS NULL THEN s.n ELSE 0 END AS records,
         CASE WHEN m.symbol IS NULL THEN 'vr_empty' ELSE coalesce(b.reasons, '') END AS reasons
  FROM (SELECT DISTINCT symbol FROM requested) r
  LEFT JOIN (SELECT DISTINCT symbol FROM mixed) m ON m.symbol = r.symbol
  LEFT JOIN bad b ON b.symbol = r.symbol LEFT JOIN saved s ON s.symbol = r.symbol)"""
)
SQL["pipe_daily"] = _with(_STATUS, "SELECT symbol, status, records, reasons FROM status")
SQL["pipe_run_stats"] = _with(
    _STATUS,
    """
SELECT count(*) AS total_symbols, count(*) FILTER (status = 'successful') AS successful,
       count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
       CAST(sum(records) AS BIGINT) AS total_records,
       round(count(*) FILTER (status = 'successful') / count(*) * 100, 1) AS success_rate
FROM status""",
)
SQL["pipe_batch"] = _with(
    _BARS + "," + _filled("bars") + _REQUESTED,
    """
SELECT symbol, CASE WHEN n IS NULL THEN 'skipped' ELSE 'successful' END AS status,
       coalesce(n, 0) AS records, coalesce(n, 0) AS stored
FROM requested LEFT JOIN (SELECT symbol, count(*) AS n FROM corrected GROUP BY symbol) USING (symbol)""",
)
SQL["pipe_bulk_collect"] = _with(
    _BARS + _REQUESTED,
    """
SELECT count(*) AS total_symbols, count(b.symbol) AS successful, count(*) - count(b.symbol) AS failed,
       round(count(b.symbol) / count(*) * 100, 1) AS success_rate
FROM requested LEFT JOIN (SELECT DISTINCT symbol FROM bars) b USING (symbol)""",
)
SQL["pipe_report_dataset"] = _with(
    _STORED
    + _PERIOD
    + """,
scored AS (
  SELECT *, (volume - avg(volume) OVER w) / nullif(stddev_samp(volume) OVER w, 0) AS z
  FROM corrected WINDOW w AS (PARTITION BY symbol))""",
    """
SELECT symbol, strftime(any_value(d), '%Y-%m') AS period, count(*) AS corrected_records,
       arg_min(close, date) AS start_price, arg_max(close, date) AS end_price,
       CAST(trunc(quantile_cont(volume, 0.5)) AS BIGINT) AS median_volume,
       count(*) FILTER (abs(z) > 2) AS anomalous_volume_days,
       CAST(sum(volume) AS BIGINT) AS original_total_volume
FROM scored JOIN latest USING (symbol) GROUP BY symbol""",
)

# --- streams: the results of the same work on the whole tables --------------

SQL["st_ingest_upsert"] = _with(
    _DIRTY,
    """
SELECT symbol, date, ingest_seq, close, volume FROM dirty
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq DESC) = 1""",
)
SQL["st_ingest_falling_order"] = SQL["st_ingest_upsert"]
SQL["st_row_rules"] = _with(
    _DIRTY,
    "SELECT symbol, ingest_seq, date, string_agg(label, ',' ORDER BY label) AS broken FROM ("
    + "\nUNION ALL ".join(
        f"SELECT symbol, ingest_seq, date, '{rule}{':' + field if field else ''}' AS label "
        f"FROM dirty WHERE {condition}"
        for rule, field, condition in _ROW_CONDITIONS
    )
    + ") GROUP BY 1, 2, 3",
)
SQL["st_ohlc_bars"] = """
SELECT event_type AS symbol, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bar_start,
       arg_min(value, row(ts, value)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, row(ts, value)) AS close, count(*) AS volume, count(*) AS ticks
FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
GROUP BY 1, 2"""
SQL["ohlc_bars"] = """
SELECT event_type AS symbol, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bar_start,
       arg_min(value, row(ts, value)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, row(ts, value)) AS close, count(*) AS volume, count(*) AS ticks
FROM events GROUP BY 1, 2"""

SQL["st_ingest_once"] = _with(_BARS, "SELECT symbol, date, ingest_seq, close, volume FROM bars")
SQL["st_batch_ledger"] = _with(
    _BARS,
    """
SELECT count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM bars
GROUP BY CASE WHEN year(date) <= 1994 THEN 1 WHEN year(date) <= 1996 THEN 2 ELSE 3 END""",
)
SQL["st_order_rules"] = _with(
    _DIRTY,
    """,
arrived AS (
  SELECT symbol, ingest_seq, date,
         date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY ingest_seq), date) AS gap,
         ingest_seq > 1000000 AND date <= (SELECT max(date) FROM bars) - INTERVAL 30 DAY AS late, close
  FROM dirty),
timed AS (
  SELECT *, abs(close / lag(close) OVER (PARTITION BY symbol ORDER BY date, ingest_seq) - 1) AS step
  FROM arrived WHERE NOT late)
SELECT symbol, ingest_seq, date, 'vr_date_order' AS rule FROM arrived WHERE gap < 0
UNION ALL SELECT symbol, ingest_seq, date, 'vr_gap_suspicious' FROM arrived WHERE gap > 7
UNION ALL SELECT symbol, ingest_seq, date, 'late' FROM arrived WHERE late
UNION ALL SELECT symbol, ingest_seq, date, 'vr_extreme_variation' FROM timed WHERE step > 0.2""",
)
