"""DuckDB SQL for each named query (tables are pre-registered views)."""

from __future__ import annotations

from tidings.functions.stopwords import ENGLISH_STOP_WORDS

# Stand-in tables as SQL, mirroring tidings.sources.standins.
SPARSE_PRICES = """
sparse_prices AS (
  SELECT n.n_name AS name, CAST(o.o_orderdate AS DATE) AS date,
         arg_max(o.o_totalprice, o.o_orderkey) AS close
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)"""

SHIP_PROBES = """
ship_probes AS (
  SELECT DISTINCT n.n_name AS name, CAST(l.l_shipdate AS DATE) AS date
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

PRICE_CONTEXT = """
price_ctx AS (
  SELECT name, date, close,
         row_number() OVER w AS rn,
         lag(close, 1) OVER w AS prev1_close,
         lag(close, 3) OVER w AS prev3_close,
         lead(close, 1) OVER w AS next_close
  FROM sparse_prices WHERE close IS NOT NULL
  WINDOW w AS (PARTITION BY name ORDER BY date))"""

SESSION_RETURNS = """
session_returns AS (
  SELECT p.name, p.date, c.close, c.next_close,
         CASE WHEN c.close <> 0 THEN (c.next_close / c.close - 1) * 100 END AS next_session_return,
         CASE WHEN c.rn >= 4 AND c.prev1_close <> 0 THEN (c.close / c.prev1_close - 1) * 100 END AS prior_1d_return,
         CASE WHEN c.rn >= 4 AND c.prev3_close <> 0 THEN (c.close / c.prev3_close - 1) * 100 END AS prior_3d_return
  FROM ship_probes p ASOF LEFT JOIN price_ctx c ON p.name = c.name AND p.date >= c.date),
labelled AS (
  SELECT *, CASE WHEN next_session_return IS NULL THEN NULL
                 WHEN next_session_return > 0.3 THEN 'UP'
                 WHEN next_session_return < -0.3 THEN 'DOWN' ELSE 'FLAT' END AS label
  FROM session_returns)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["asof_returns"] = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS) + """
SELECT name, CAST(date AS VARCHAR) AS date, round(close, 6) AS close, round(next_close, 6) AS next_close,
       round(next_session_return, 6) AS next_session_return, label,
       round(prior_1d_return, 6) AS prior_1d_return, round(prior_3d_return, 6) AS prior_3d_return
FROM labelled"""

ORACLE["label_counts"] = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS) + """
SELECT name, coalesce(label, 'UNRESOLVED') AS label, count(*) AS n_probes,
       round(avg(next_session_return), 6) AS avg_return
FROM labelled GROUP BY 1, 2"""

ORACLE["asof_forward_strict"] = with_(SPARSE_PRICES, SHIP_PROBES) + """
SELECT p.name, CAST(p.date AS VARCHAR) AS date, CAST(s.date AS VARCHAR) AS next_date,
       round(s.close, 6) AS next_close
FROM ship_probes p ASOF LEFT JOIN sparse_prices s ON p.name = s.name AND s.date > p.date"""

BARS = """
bars AS (
  SELECT event_type AS name, CAST(ts AS DATE) AS date, arg_min(value, event_id) AS open,
         max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""

NATION_DIM = """
nation_dim AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS ticker, n.n_name AS name, r.r_name AS sector
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

def panel_returns(out: str, source: str) -> str:
    """Returns on every date of the calendar, gaps filled with the last value."""
    return f"""
{out}_cal AS (SELECT DISTINCT date FROM {source}),
{out}_panel AS (
  SELECT n.name, c.date,
         last_value(s.close IGNORE NULLS) OVER (PARTITION BY n.name ORDER BY c.date
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
  FROM (SELECT DISTINCT name FROM {source} WHERE close IS NOT NULL) n CROSS JOIN {out}_cal c
  LEFT JOIN {source} s ON s.name = n.name AND s.date = c.date),
{out} AS (
  SELECT name, date, close,
         CASE WHEN lag(close) OVER w <> 0 THEN (close / lag(close) OVER w - 1) * 100 END AS ret
  FROM {out}_panel WINDOW w AS (PARTITION BY name ORDER BY date))"""


SPARSE_RETURNS = panel_returns("sparse_returns", "sparse_prices")
BAR_RETURNS = panel_returns("bar_returns", "bars")

MARKET = """
market AS (
  SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY 1),
market_returns AS (
  SELECT date, CASE WHEN lag(close) OVER (ORDER BY date) <> 0
                    THEN (close / lag(close) OVER (ORDER BY date) - 1) * 100 END AS ret
  FROM market)"""

ORACLE["series_returns"] = with_(SPARSE_PRICES, SPARSE_RETURNS) + """
SELECT name, CAST(date AS VARCHAR) AS date, round(ret, 6) AS ret FROM sparse_returns"""

ORACLE["calendar_returns"] = with_(SPARSE_PRICES) + """,
cal AS (SELECT date, lag(date) OVER (ORDER BY date) AS prev FROM (SELECT DISTINCT date FROM sparse_prices))
SELECT n.name, CAST(cal.date AS VARCHAR) AS date,
       round(CASE WHEN p.close <> 0 THEN (s.close / p.close - 1) * 100 END, 6) AS ret
FROM (SELECT DISTINCT name FROM sparse_prices WHERE close IS NOT NULL) n CROSS JOIN cal
LEFT JOIN sparse_prices s ON s.name = n.name AND s.date = cal.date
LEFT JOIN sparse_prices p ON p.name = n.name AND p.date = cal.prev"""

ORACLE["rolling_volatility"] = with_(SPARSE_PRICES, SPARSE_RETURNS) + """
SELECT name, CAST(date AS VARCHAR) AS date,
       round(CASE WHEN count(ret) OVER w >= 90 THEN stddev_samp(ret) OVER w END, 3) AS rolling_std
FROM sparse_returns WHERE ret IS NOT NULL
WINDOW w AS (PARTITION BY name ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)"""

ORACLE["indexed_performance"] = with_(BARS) + """
SELECT name, CAST(date AS VARCHAR) AS date,
       round(CASE WHEN f <> 0 THEN close / f * 100 END, 6) AS indexed
FROM bars JOIN (SELECT name AS n, arg_min(close, date) AS f FROM bars WHERE close IS NOT NULL GROUP BY 1) ON name = n"""

ORACLE["final_performance"] = with_(BARS) + """
SELECT name, round(CASE WHEN arg_min(close, date) <> 0
                        THEN arg_max(close, date) / arg_min(close, date) * 100 - 100 END, 1) AS performance_pct
FROM bars WHERE close IS NOT NULL GROUP BY name"""

ORACLE["latest_change"] = with_(SPARSE_PRICES) + """,
r AS (SELECT name, date, close, row_number() OVER (PARTITION BY name ORDER BY date DESC) AS k
      FROM sparse_prices WHERE close IS NOT NULL)
SELECT a.name, CAST(a.date AS VARCHAR) AS last_date, round(a.close, 6) AS last_value,
       round(b.close, 6) AS prev_value,
       round(CASE WHEN b.close <> 0 THEN (a.close / b.close - 1) * 100 END, 6) AS change_pct
FROM r a LEFT JOIN r b ON a.name = b.name AND b.k = 2 WHERE a.k = 1"""

ORACLE["describe_returns"] = with_(BARS, BAR_RETURNS) + """
SELECT name, round(avg(ret), 3) AS mean, round(stddev_samp(ret), 3) AS std, round(min(ret), 3) AS min,
       round(max(ret), 3) AS max, count(ret) AS n
FROM bar_returns GROUP BY name"""

ORACLE["noise_share"] = with_(BARS, BAR_RETURNS) + """
SELECT name, count(*) FILTER (WHERE abs(ret) > 0.5) AS n_noisy, count(*) AS n_days,
       round(count(*) FILTER (WHERE abs(ret) > 0.5) / count(*) * 100, 1) AS noise_pct
FROM bar_returns WHERE ret IS NOT NULL GROUP BY name"""

ORACLE["sector_volatility"] = with_(SPARSE_PRICES, SPARSE_RETURNS, NATION_DIM) + """
SELECT d.sector, round(avg(s.sd), 6) AS avg_volatility, count(*) AS n_members
FROM (SELECT name, stddev_samp(ret) AS sd FROM sparse_returns GROUP BY name) s
JOIN nation_dim d ON s.name = d.name GROUP BY d.sector"""

ORACLE["sector_returns"] = with_(SPARSE_PRICES, SPARSE_RETURNS, NATION_DIM) + """
SELECT d.sector, CAST(s.date AS VARCHAR) AS date, round(avg(s.ret), 6) AS sector_ret
FROM sparse_returns s JOIN nation_dim d ON s.name = d.name GROUP BY 1, 2"""

ORACLE["sector_market_corr"] = with_(SPARSE_PRICES, SPARSE_RETURNS, NATION_DIM, MARKET) + """,
sec AS (SELECT d.sector, s.date, avg(s.ret) AS sector_ret
        FROM sparse_returns s JOIN nation_dim d ON s.name = d.name GROUP BY 1, 2)
SELECT sec.sector, round(corr(sec.sector_ret, m.ret), 6) AS corr, count(*) AS n_dates
FROM sec JOIN market_returns m ON sec.date = m.date GROUP BY 1"""

ORACLE["corr_matrix"] = with_(SPARSE_PRICES, SPARSE_RETURNS) + """
SELECT x.name AS name_a, y.name AS name_b, round(corr(x.ret, y.ret), 6) AS corr, count(x.ret * y.ret) AS n_dates
FROM sparse_returns x JOIN sparse_returns y ON x.date = y.date AND x.name <= y.name
WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2"""

ORACLE["return_histogram"] = with_(SPARSE_PRICES, SPARSE_RETURNS) + """,
lh AS (SELECT min(ret) AS lo, max(ret) AS hi FROM sparse_returns),
b AS (SELECT least(CAST(floor(80 * (ret - lo) / (hi - lo)) AS BIGINT) + 1, 80) AS bin, lo, hi
      FROM sparse_returns, lh WHERE ret IS NOT NULL)
SELECT CAST(bin AS INTEGER) AS bin, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 80, 6) AS lower,
       round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 80, 6) AS upper, count(*) AS n
FROM b GROUP BY bin"""

ORACLE["series_coverage"] = with_(SPARSE_PRICES) + """
SELECT name, CAST(min(date) FILTER (WHERE close IS NOT NULL) AS VARCHAR) AS first_date,
       CAST(max(date) FILTER (WHERE close IS NOT NULL) AS VARCHAR) AS last_date,
       count(close) AS n_rows, round(count(close) / 252, 2) AS years,
       CAST(count(close) > 0 AS INTEGER) AS loaded
FROM sparse_prices GROUP BY name"""

ORACLE["overlay_series"] = with_(SPARSE_PRICES) + """,
fresh AS (
  SELECT n.n_name AS name, CAST(o.o_orderdate AS DATE) + 1 AS date, arg_min(o.o_totalprice, o.o_orderkey) AS close
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)
SELECT coalesce(f.name, e.name) AS name, CAST(coalesce(f.date, e.date) AS VARCHAR) AS date,
       round(coalesce(f.close, e.close), 6) AS close
FROM sparse_prices e FULL JOIN fresh f ON e.name = f.name AND e.date = f.date"""

# ---------------------------------------------------------------- text
import re as _re  # noqa: E402

from tidings.operators.text import LABEL_RULES, RULE_PATTERNS  # noqa: E402
from tidings.sources.standins import ENTITY_TERMS, INDEX_TICKER, TOPIC_SECTORS  # noqa: E402

NW = r"[^\p{L}\p{N}_]"  # a non-word character (Unicode), RE2 has no Unicode \b


def re2_words(alts: str) -> str:
    return f"(?i)(^|{NW})(?:{alts})({NW}|$)"


def sql_str(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


NEWS = """
news AS (
  SELECT d.doc_id AS id, d.lang AS topic, d.text AS headline, d.text AS body, d.source,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d.doc_id % 30 AS INTEGER)) AS published_at,
         CASE WHEN l.quality IS NULL THEN NULL WHEN d.doc_id % 3 = 0 THEN 'neutral'
              WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment_label,
         round(0.5 + (d.doc_id % 50) / 100.0, 6) AS sentiment_confidence
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _rule_case() -> str:
    flags = {k: f"regexp_matches(body, '{re2_words(p)}')" for k, p in RULE_PATTERNS.items()}
    whens = []
    for name, need, absent, applies, new in LABEL_RULES:
        conds = ["sentiment_label IN (" + ", ".join(sql_str(a) for a in applies) + ")"]
        conds += [flags[p] for p in need] + [f"NOT {flags[p]}" for p in absent]
        whens.append((" AND ".join(conds), new, name))
    lab = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in whens) + " ELSE sentiment_label END"
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in whens) + " ELSE NULL END"
    return f"""
ruled AS (
  SELECT id, sentiment_label AS sentiment_label_original, {lab} AS new_label, {rule} AS rule FROM news)"""


RULED = _rule_case()

ORACLE["label_rules"] = with_(NEWS, RULED) + """
SELECT id, sentiment_label_original, new_label AS sentiment_label, rule FROM ruled"""

ORACLE["rule_counts"] = with_(NEWS, RULED) + """
SELECT rule, sentiment_label_original AS original_label, new_label AS corrected_label, count(*) AS n
FROM ruled WHERE rule IS NOT NULL AND new_label <> sentiment_label_original GROUP BY 1, 2, 3"""

DICT = "dict(ticker, name, sector, pat) AS (VALUES " + ", ".join(
    f"({sql_str(t)}, {sql_str(n)}, {sql_str(s)}, {sql_str(_re.escape(n))})" for t, n, s in ENTITY_TERMS) + ")"
TOPICS = "topics(topic, sector) AS (VALUES " + ", ".join(
    f"({sql_str(t)}, {sql_str(s)})" for t, s in TOPIC_SECTORS) + ")"

MATCHES = r"""
raw_matches AS MATERIALIZED (
  SELECT n.id, d.ticker, d.name, d.sector,
         length(regexp_extract(n.body, '(?s)^(.*?(?:^|' || '""" + NW + r"""' || '))(?i:' || d.pat || ')(?:'
                || '""" + NW + r"""' || '|$)', 1)) + 1 AS start,
         length(d.name) AS len
  FROM news n, dict d
  WHERE d.sector <> 'Index' AND contains(lower(n.body), lower(d.name))
    AND regexp_matches(n.body, '(?i)(?:^|' || '""" + NW + r"""' || ')(?:' || d.pat || ')(?:' || '""" + NW + r"""'
                       || '|$)')),
matches AS MATERIALIZED (
  SELECT a.id, a.ticker, a.name, a.sector, a.start, a.start + a.len AS "end" FROM raw_matches a
  WHERE NOT EXISTS (
    SELECT 1 FROM raw_matches b
    WHERE b.id = a.id AND b.ticker <> a.ticker AND b.start <= a.start AND b.start + b.len >= a.start + a.len
      AND (b.len > a.len OR (b.start = a.start AND b.len = a.len AND b.ticker < a.ticker))))"""

ORACLE["term_matches"] = with_(NEWS, DICT, MATCHES) + """
SELECT id AS article_id, ticker, CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end" FROM matches"""

#: Terms are sought in labelled articles alone where only those are routed.
LABELED_MATCHES = MATCHES.replace("FROM news n, dict d", "FROM (SELECT * FROM news WHERE sentiment_label IS NOT NULL) n, dict d")

ROUTED = """
labeled AS (SELECT * FROM news WHERE sentiment_label IS NOT NULL),
by_name AS (
  SELECT n.id AS article_id, n.headline, n.topic, n.source, n.published_at, n.sentiment_label,
         n.sentiment_confidence, m.ticker, m.name AS company_name, m.sector, 'company_name' AS matched_via
  FROM matches m JOIN labeled n ON m.id = n.id),
fan AS (
  SELECT n.id AS article_id, n.headline, n.topic, n.source, n.published_at, n.sentiment_label,
         n.sentiment_confidence, d.ticker, d.name AS company_name, t.sector
  FROM labeled n JOIN topics t ON n.topic = t.topic
  JOIN dict d ON (t.sector <> 'Index' AND d.sector = t.sector)
              OR (t.sector = 'Index' AND d.ticker = '""" + INDEX_TICKER + """')),
by_topic AS (
  SELECT f.*, 'topic_macro' AS matched_via FROM fan f
  WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.id = f.article_id AND m.ticker = f.ticker)),
routed AS (SELECT * FROM by_name UNION ALL SELECT * FROM by_topic)"""

ORACLE["routed_events"] = with_(NEWS, DICT, TOPICS, LABELED_MATCHES, ROUTED) + """
SELECT article_id, headline, topic, source, strftime(published_at, '%Y-%m-%d') AS published_at, sentiment_label,
       round(sentiment_confidence, 6) AS sentiment_confidence, ticker, company_name, sector, matched_via
FROM routed"""

ORACLE["routing_summary"] = with_(NEWS, DICT, TOPICS, LABELED_MATCHES, ROUTED) + """
SELECT 'matched_via' AS dimension, matched_via AS value, count(*) AS n_rows, count(DISTINCT article_id) AS n_articles
FROM routed GROUP BY 2
UNION ALL
SELECT 'sector', sector, count(*), count(DISTINCT article_id) FROM routed GROUP BY 2
UNION ALL
SELECT 'sentiment_label', sentiment_label, count(*), count(DISTINCT article_id) FROM routed GROUP BY 2"""

ORACLE["unrouted_articles"] = with_(NEWS, DICT, TOPICS, LABELED_MATCHES, ROUTED) + """
SELECT id, topic, source FROM labeled WHERE id NOT IN (SELECT article_id FROM routed)"""

# ---------------------------------------------------------------- features
from tidings.sources.standins import MARKET_SERIES, TICKER_SERIES  # noqa: E402


def ctx_sql(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT name, date, close, row_number() OVER w AS rn, lag(close, 1) OVER w AS prev1_close,
         lag(close, 3) OVER w AS prev3_close, lead(close, 1) OVER w AS next_close
  FROM {source} WHERE close IS NOT NULL WINDOW w AS (PARTITION BY name ORDER BY date))"""


TSERIES = "tseries(ticker, series) AS (VALUES " + ", ".join(
    f"({sql_str(t)}, {sql_str(s)})" for t, s in TICKER_SERIES) + ")"
MSERIES = "mseries(series, col) AS (VALUES " + ", ".join(
    f"({sql_str(s)}, {sql_str(c)})" for s, c in MARKET_SERIES.items()) + ")"

DAILY = """
rt AS (
  SELECT *, CAST(published_at AS DATE) AS date,
         CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END
           * sentiment_confidence AS w
  FROM routed),
daily AS (
  SELECT ticker, date, count(headline) AS n_headlines,
         count(*) FILTER (WHERE sentiment_label = 'positive') AS n_positive,
         count(*) FILTER (WHERE sentiment_label = 'negative') AS n_negative,
         count(*) FILTER (WHERE sentiment_label = 'neutral') AS n_neutral,
         avg(sentiment_confidence) AS avg_confidence, avg(w) AS net_sentiment
  FROM rt GROUP BY 1, 2),
daily2 AS (
  SELECT *, n_positive / n_headlines AS pct_positive, n_negative / n_headlines AS pct_negative,
         n_neutral / n_headlines AS pct_neutral FROM daily)"""

ORACLE["daily_sentiment"] = with_(NEWS, DICT, TOPICS, MATCHES, ROUTED, DAILY) + """
SELECT ticker, CAST(date AS VARCHAR) AS date, n_headlines, n_positive, n_negative, n_neutral,
       round(avg_confidence, 6) AS avg_confidence, round(net_sentiment, 6) AS net_sentiment,
       round(pct_positive, 6) AS pct_positive, round(pct_negative, 6) AS pct_negative,
       round(pct_neutral, 6) AS pct_neutral
FROM daily2"""

_mk_cols = ",\n         ".join(
    f"coalesce(max(r) FILTER (WHERE col = '{c}'), 0.0) AS {c}" for c in MARKET_SERIES.values())

FEATURES = """
eprices AS (
  SELECT d.name, b.date, b.close FROM bars b JOIN tseries t ON b.name = t.series JOIN dict d ON d.ticker = t.ticker),
""" + ctx_sql("ectx", "eprices").strip() + """,
""" + ctx_sql("mctx", "bars").strip() + """,
pairs AS (
  SELECT DISTINCT r.ticker, r.company_name, r.date, coalesce(d.name, r.ticker) AS mom_name
  FROM rt r LEFT JOIN dict d ON r.ticker = d.ticker),
nxt AS (
  SELECT p.ticker, p.date,
         CASE WHEN c.close <> 0 THEN (c.next_close / c.close - 1) * 100 END AS next_session_return
  FROM pairs p ASOF LEFT JOIN ectx c ON c.name = p.company_name AND p.date >= c.date),
mom AS (
  SELECT DISTINCT p.ticker, p.date,
         CASE WHEN c.rn >= 4 AND c.prev1_close <> 0 THEN (c.close / c.prev1_close - 1) * 100 END AS p1,
         CASE WHEN c.rn >= 4 AND c.prev3_close <> 0 THEN (c.close / c.prev3_close - 1) * 100 END AS p3
  FROM pairs p ASOF LEFT JOIN ectx c ON c.name = p.mom_name AND p.date >= c.date),
mdates AS (SELECT DISTINCT date FROM daily2),
mret AS (
  SELECT p.date, p.col,
         CASE WHEN c.rn >= 4 AND c.prev1_close <> 0 THEN (c.close / c.prev1_close - 1) * 100 END AS r
  FROM (SELECT m.date, s.series, s.col FROM mdates m, mseries s) p
  ASOF LEFT JOIN mctx c ON c.name = p.series AND p.date >= c.date),
mk AS (
  SELECT date,
         """ + _mk_cols + """
  FROM mret GROUP BY date),
idx AS (SELECT date, net_sentiment AS mns FROM daily2 WHERE ticker = '""" + INDEX_TICKER + """'),
feat AS (
  SELECT f.*, d.sector, n.next_session_return,
         CASE WHEN n.next_session_return IS NULL THEN NULL WHEN n.next_session_return > 0.3 THEN 'UP'
              WHEN n.next_session_return < -0.3 THEN 'DOWN' ELSE 'FLAT' END AS label,
         coalesce(m.p1, 0.0) AS prior_1d_return, coalesce(m.p3, 0.0) AS prior_3d_return,
         coalesce(i.mns, 0.0) AS market_net_sentiment, mk.* EXCLUDE (date),
         isodow(f.date) - 1 AS day_of_week
  FROM daily2 f LEFT JOIN dict d ON f.ticker = d.ticker
  LEFT JOIN nxt n ON f.ticker = n.ticker AND f.date = n.date
  LEFT JOIN mom m ON f.ticker = m.ticker AND f.date = m.date
  LEFT JOIN idx i ON f.date = i.date
  LEFT JOIN mk ON f.date = mk.date)"""

ORACLE["daily_features"] = with_(NEWS, DICT, TOPICS, MATCHES, ROUTED, DAILY, BARS, TSERIES, MSERIES,
                                 FEATURES) + """
SELECT ticker, CAST(date AS VARCHAR) AS date, n_headlines, n_positive, n_negative, n_neutral,
       round(avg_confidence, 6) AS avg_confidence, round(net_sentiment, 6) AS net_sentiment,
       round(pct_positive, 6) AS pct_positive, round(pct_negative, 6) AS pct_negative,
       round(pct_neutral, 6) AS pct_neutral, sector, round(next_session_return, 6) AS next_session_return,
       label, round(prior_1d_return, 6) AS prior_1d_return, round(prior_3d_return, 6) AS prior_3d_return,
       round(market_net_sentiment, 6) AS market_net_sentiment, """ + ", ".join(
    f"round({c}, 6) AS {c}" for c in MARKET_SERIES.values()) + """,
       CAST(day_of_week AS INTEGER) AS day_of_week
FROM feat"""

# ---------------------------------------------------------------- evaluation
PREDICTIONS = """
preds AS (
  SELECT name, date, label, next_session_return, prior_1d_return, prior_3d_return,
         CASE WHEN prior_1d_return > 0.3 THEN 'UP' WHEN prior_1d_return < -0.3 THEN 'DOWN' ELSE 'FLAT' END
           AS predicted_label
  FROM labelled WHERE label IS NOT NULL AND prior_1d_return IS NOT NULL)"""

_PRED = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS, PREDICTIONS)

ORACLE["prediction_agreement"] = _PRED + """
SELECT label AS class, round(avg(CAST(label = predicted_label AS INTEGER)), 6) AS accuracy, count(*) AS n
FROM preds GROUP BY label
UNION ALL
SELECT 'ALL', round(avg(CAST(label = predicted_label AS INTEGER)), 6), count(*) FROM preds"""

ORACLE["confusion_matrix"] = _PRED + """
SELECT label AS actual, count(*) FILTER (WHERE predicted_label = 'DOWN') AS "DOWN",
       count(*) FILTER (WHERE predicted_label = 'FLAT') AS "FLAT",
       count(*) FILTER (WHERE predicted_label = 'UP') AS "UP"
FROM preds GROUP BY label"""

ORACLE["classification_report"] = _PRED + """,
cls(class) AS (VALUES ('DOWN'), ('FLAT'), ('UP')),
t AS (
  SELECT c.class,
         (SELECT count(*) FROM preds WHERE label = c.class) AS support,
         (SELECT count(*) FROM preds WHERE label = c.class AND predicted_label = c.class) AS tp,
         (SELECT count(*) FROM preds WHERE predicted_label = c.class) AS predicted
  FROM cls c),
m AS (
  SELECT class, support,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM t),
per AS (
  SELECT class, precision, recall,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
         support FROM m)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM per
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per"""

ORACLE["run_metrics"] = _PRED + """,
dates AS (SELECT date, row_number() OVER (ORDER BY date) AS rn FROM (SELECT DISTINCT date FROM preds)),
nd AS (SELECT count(*) AS n FROM dates),
sd AS (SELECT d.date AS split FROM dates d, nd
       WHERE d.rn = least(greatest(1, CAST(floor(nd.n * 0.8) AS BIGINT)) + 1, nd.n)),
p AS (SELECT preds.*, CASE WHEN date < sd.split THEN 'train' ELSE 'test' END AS part FROM preds, sd),
maj AS (SELECT label AS majority_label FROM p WHERE part = 'train' GROUP BY label
        ORDER BY count(*) DESC, label LIMIT 1)
SELECT count(*) AS n_labeled_rows, count(DISTINCT date) AS n_dates,
       count(*) FILTER (WHERE part = 'train') AS train_rows, count(*) FILTER (WHERE part = 'test') AS test_rows,
       CAST(min(date) FILTER (WHERE part = 'test') AS VARCHAR) AS split_date,
       round(avg(CAST(label = predicted_label AS INTEGER)) FILTER (WHERE part = 'test'), 6) AS model_accuracy,
       round(avg(CAST(label = (SELECT majority_label FROM maj) AS INTEGER)) FILTER (WHERE part = 'test'), 6)
         AS baseline_accuracy,
       (SELECT majority_label FROM maj) AS majority_label,
       round((avg(CAST(label = predicted_label AS INTEGER)) FILTER (WHERE part = 'test')
              - avg(CAST(label = (SELECT majority_label FROM maj) AS INTEGER)) FILTER (WHERE part = 'test')) * 100, 6)
         AS lift_pts
FROM p"""

ORACLE["class_weights"] = """
SELECT quality, count(*) AS n_c,
       round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
FROM labels GROUP BY quality"""

FOLDS = """
folds AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY quality ORDER BY ((doc_id + 42) * 2654435761) % 4294967296, doc_id) - 1)
                 % 5 AS INTEGER) AS fold
  FROM labels)"""

ORACLE["stratified_folds"] = with_(FOLDS) + """
SELECT fold, quality, count(*) AS n FROM folds GROUP BY 1, 2"""

ORACLE["fold_summary"] = with_(FOLDS) + """,
per AS (SELECT fold, avg(CAST(quality = 1 - toxic AS INTEGER)) AS accuracy FROM folds GROUP BY fold)
SELECT round(avg(accuracy), 6) AS mean, round(stddev_pop(accuracy), 6) AS std, count(*) AS n_folds FROM per"""

ORACLE["holdout_split"] = """
SELECT CAST(rn <= greatest(1, CAST(floor((SELECT count(*) FROM documents) * 0.2) AS BIGINT)) AS INTEGER) AS holdout,
       lang, count(*) AS n
FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY ((doc_id + 42) * 2654435761) % 4294967296, doc_id) AS rn
      FROM documents)
GROUP BY 1, 2"""

ORACLE["training_guard"] = with_(NEWS, DICT, TOPICS, MATCHES, ROUTED, DAILY, BARS, TSERIES, MSERIES,
                                 FEATURES) + """
SELECT CAST(count(*) >= 40 AND count(DISTINCT label) >= 2 AS INTEGER) AS ok,
       CASE WHEN count(*) < 40 THEN 'only ' || count(*) || ' labelled rows (< 40)'
            WHEN count(DISTINCT label) < 2 THEN 'fewer than 2 classes' END AS reason,
       count(*) AS n, count(DISTINCT label) AS k
FROM feat WHERE label IS NOT NULL"""

# ---------------------------------------------------------------- learning
from tidings.operators.learning import SIGNAL_FEATURES  # noqa: E402

SIG_OUTCOMES = """
sig_outcomes AS (
  SELECT name, CASE WHEN abs(prior_1d_return) >= abs(coalesce(prior_3d_return, 0.0))
                    THEN CASE WHEN prior_1d_return > 0 THEN 'stock_momentum' ELSE 'nifty_momentum' END
                    WHEN prior_3d_return > 20 THEN NULL WHEN prior_3d_return > 0 THEN 'sector'
                    ELSE 'market_sentiment' END AS signal, date,
         CAST(label = predicted_label AS INTEGER) AS c
  FROM preds)"""

_CL = "least(greatest({x}, 0.2), 2.0)"


_SIGNALS = ", ".join(sql_str(s) for s in SIGNAL_FEATURES)
NO_STATE = "SELECT NULL::VARCHAR AS name, NULL::VARCHAR AS signal, 1.0 AS w, 0 AS cw, 0 AS cc, 0 AS wa, 0 AS ca, NULL AS pd WHERE false"
STORED_STATE = """SELECT n_name AS name, 'stock_momentum' AS signal, 0.7 AS w, 1 AS cw, 0 AS cc, 2 AS wa, 3 AS ca, 1.4 AS pd
       FROM nation WHERE n_nationkey % 2 = 0
       UNION ALL SELECT n_name, 'day_of_week', 1.3, 2, 0, 4, 0, NULL FROM nation WHERE n_nationkey % 5 = 0"""


def _fold_sql(source: str = "sig_outcomes", name: str = "name", stored: str = NO_STATE) -> str:
    cl = _CL.format
    return f"""
o AS (SELECT {name} AS name, signal, date, c, row_number() OVER (PARTITION BY {name}, signal ORDER BY date) AS k
      FROM {source} WHERE signal IN ({_SIGNALS})),
stored AS ({stored}),
st AS (
  SELECT DISTINCT o.name, o.signal, CAST(0 AS BIGINT) AS k, NULL::DATE AS date, coalesce(s.w, 1.0)::DOUBLE AS w,
         coalesce(s.cw, 0) AS cw, coalesce(s.cc, 0) AS cc, coalesce(s.wa, 0) AS wa, coalesce(s.ca, 0) AS ca,
         s.pd::DOUBLE AS pd, 0.0::DOUBLE AS drift,
         NULL::VARCHAR AS e1, NULL::DOUBLE AS b1, NULL::DOUBLE AS a1,
         NULL::VARCHAR AS e2, NULL::DOUBLE AS b2, NULL::DOUBLE AS a2
  FROM (SELECT name, signal FROM o UNION SELECT name, signal FROM stored) o
  LEFT JOIN stored s ON s.name = o.name AND s.signal = o.signal
  UNION ALL
  SELECT name, signal, k, date, w3, cw2, cc2, wa3, ca3, pd2, drift + abs(w2 - w0) + abs(w3 - w2),
         CASE WHEN dec THEN 'decay' WHEN res THEN 'restore' END, CASE WHEN dec OR res THEN w0 END,
         CASE WHEN dec OR res THEN w2 END,
         CASE WHEN dn THEN 'down' WHEN up THEN 'up' END, CASE WHEN dn OR up THEN w2 END,
         CASE WHEN dn OR up THEN w3 END
  FROM (
    SELECT *, CASE WHEN dn THEN {cl(x='0.9 * w2')} WHEN up THEN {cl(x='1.1 * w2')} ELSE w2 END AS w3,
           CASE WHEN dn THEN 0 ELSE wa1 END AS wa3, CASE WHEN up THEN 0 ELSE ca1 END AS ca3
    FROM (
      SELECT *, CASE WHEN dec THEN {cl(x='0.5 * w0')} WHEN res THEN {cl(x='pd0')} ELSE w0 END AS w2,
             CASE WHEN dec THEN w0 WHEN res THEN NULL ELSE pd0 END AS pd2,
             CASE WHEN dec THEN 0 ELSE cw1 END AS cw2, CASE WHEN res THEN 0 ELSE cc1 END AS cc2,
             wa1 >= 5 AS dn, wa1 < 5 AND ca1 >= 5 AS up
      FROM (
        SELECT *, cw1 >= 3 AND pd0 IS NULL AS dec, NOT (cw1 >= 3 AND pd0 IS NULL) AND cc1 >= 2 AND pd0 IS NOT NULL AS res
        FROM (
          SELECT st.name, st.signal, o.k, o.date, st.w AS w0, st.pd AS pd0, st.drift,
                 CASE WHEN o.c = 1 THEN 0 ELSE st.cw + 1 END AS cw1,
                 CASE WHEN o.c = 1 THEN st.cc + 1 ELSE 0 END AS cc1,
                 st.wa + 1 - o.c AS wa1, st.ca + o.c AS ca1
          FROM st JOIN o ON o.name = st.name AND o.signal = st.signal AND o.k = st.k + 1)))))"""


def _learn_head(stored: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in (
        SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS, PREDICTIONS, SIG_OUTCOMES,
        _fold_sql(stored=stored))) + "\n"


_LEARN_HEAD = _learn_head(STORED_STATE)
FINAL_STATE = """
SELECT name, signal, round(w, 6) AS current_weight, cw AS consecutive_wrong, cc AS consecutive_correct,
       wa AS wrong_since_adjustment, ca AS correct_since_adjustment, round(pd, 6) AS pre_decay_weight,
       round(drift, 6) AS drift, CAST(k AS INTEGER) AS n_outcomes
FROM st WHERE (name, signal, k) IN (SELECT name, signal, max(k) FROM st GROUP BY 1, 2)"""

ORACLE["signal_weights"] = _LEARN_HEAD + FINAL_STATE

ORACLE["weight_changes"] = _LEARN_HEAD + """
SELECT name, signal, CAST(date AS VARCHAR) AS date,
       CASE e1 WHEN 'decay' THEN '3 consecutive wrong predictions' ELSE 'restored after 2 consecutive correct' END
         AS reason, round(b1, 6) AS weight_before, round(a1, 6) AS weight_after,
       CASE e1 WHEN 'decay' THEN 1 ELSE 0 END AS decay_triggered, e1 AS kind
FROM st WHERE e1 IS NOT NULL
UNION ALL
SELECT name, signal, CAST(date AS VARCHAR),
       CASE e2 WHEN 'down' THEN '5 wrong attributions reached' ELSE '5 correct attributions reached' END,
       round(b2, 6), round(a2, 6), 0, e2
FROM st WHERE e2 IS NOT NULL"""

ORACLE["outcome_streaks"] = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS, PREDICTIONS,
                                  SIG_OUTCOMES) + """,
g AS (SELECT name, date, c, row_number() OVER (PARTITION BY name ORDER BY date)
             - row_number() OVER (PARTITION BY name, c ORDER BY date) AS isl FROM sig_outcomes)
SELECT name, CAST(date AS VARCHAR) AS date, c AS correct,
       CAST(row_number() OVER (PARTITION BY name, c, isl ORDER BY date) AS INTEGER) AS streak
FROM g"""

_sig = {c: s for s, cols in SIGNAL_FEATURES.items() for c in cols if c in MARKET_SERIES.values()}
INDEX_LOG = """
""" + ctx_sql("ictx", "bars").strip() + """,
iret AS (
  SELECT name, date,
         CASE WHEN rn >= 4 AND prev1_close <> 0 THEN (close / prev1_close - 1) * 100 END AS p1,
         CASE WHEN rn >= 4 AND prev3_close <> 0 THEN (close / prev3_close - 1) * 100 END AS p3,
         CASE WHEN close <> 0 THEN (next_close / close - 1) * 100 END AS nsr
  FROM ictx),
sigs AS (
  SELECT i.date, m.signal, coalesce(j.p1, 0.0) AS contribution
  FROM iret i, (VALUES """ + ", ".join(f"('{s}', '{n}')" for s, n in ((s, _sig[c]) for s, c in MARKET_SERIES.items())) + """)
       m(series, signal)
  LEFT JOIN iret j ON j.name = m.series AND j.date = i.date
  WHERE i.name = 'view'),
top1 AS (SELECT date, arg_min(signal, (-abs(contribution), signal)) AS top_signal FROM sigs GROUP BY date),
ilog AS (
  SELECT i.date + 1 AS date, CASE WHEN i.p1 > 0.3 THEN 'UP' WHEN i.p1 < -0.3 THEN 'DOWN' ELSE 'FLAT' END AS prediction,
         t.top_signal, CASE WHEN i.p3 IS NOT NULL THEN round(least(abs(i.p3) / 10, 1.0), 3) END AS sim,
         i.date AS news_date, i.nsr
  FROM iret i JOIN top1 t ON t.date = i.date WHERE i.name = 'view' AND i.p1 IS NOT NULL),
outc AS (
  SELECT date, prediction AS predicted,
         CASE WHEN nsr > 0.3 THEN 'UP' WHEN nsr < -0.3 THEN 'DOWN' ELSE 'FLAT' END AS actual_direction,
         nsr AS actual_pct_change,
         CAST((CASE WHEN nsr > 0.3 THEN 'UP' WHEN nsr < -0.3 THEN 'DOWN' ELSE 'FLAT' END) = prediction AS INTEGER)
           AS correct, top_signal, sim, news_date
  FROM ilog WHERE nsr IS NOT NULL AND news_date >= DATE '2024-01-05'),
outcomes AS (
  SELECT date, predicted, actual_direction, actual_pct_change, correct,
         CASE WHEN correct = 1 THEN 0.0 ELSE abs(actual_pct_change) END AS error_magnitude,
         CASE WHEN correct = 1 THEN NULL WHEN sim IS NULL OR sim < 0.15 THEN 'no_precedent' ELSE top_signal END
           AS main_error_signal,
         top_signal AS judged_signal, news_date
  FROM outc)"""

ORACLE["resolved_outcomes"] = with_(BARS, INDEX_LOG) + """
SELECT CAST(date AS VARCHAR) AS date, predicted, actual_direction, round(actual_pct_change, 6) AS actual_pct_change,
       correct, round(error_magnitude, 6) AS error_magnitude, main_error_signal, judged_signal,
       CAST(news_date AS VARCHAR) AS news_date
FROM outcomes"""

ORACLE["source_credibility"] = with_(NEWS, DICT, TOPICS, MATCHES, ROUTED, BARS, INDEX_LOG) + """,
srcs AS (SELECT DISTINCT source, CAST(published_at AS DATE) AS news_date FROM routed
         WHERE ticker = '""" + INDEX_TICKER + """' AND source IS NOT NULL),
ev AS (
  SELECT s.source, o.date, o.correct,
         count(*) OVER w AS total_predictions, sum(o.correct) OVER w AS correct_predictions
  FROM srcs s JOIN outcomes o ON s.news_date = o.news_date
  WINDOW w AS (PARTITION BY s.source ORDER BY o.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ev2 AS (
  SELECT *, correct_predictions / total_predictions AS acc,
         CASE WHEN total_predictions >= 20 AND correct_predictions / total_predictions < 0.4 THEN 0.3
              WHEN total_predictions >= 20 AND correct_predictions / total_predictions > 0.65 THEN 1.5 END AS t
  FROM ev)
SELECT source AS source_name, CAST(date AS VARCHAR) AS date, total_predictions,
       CAST(correct_predictions AS BIGINT) AS correct_predictions, round(acc, 6) AS accuracy_rate,
       CAST(round(coalesce(last_value(t IGNORE NULLS) OVER (PARTITION BY source ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0), 6) AS DOUBLE) AS current_weight
FROM ev2"""

IDX_SIG = """
idx_sig AS (SELECT 'all' AS grp, judged_signal AS signal, CAST(date AS DATE) AS date, correct AS c FROM outcomes)"""

ORACLE["retrain_trigger"] = ("WITH RECURSIVE " + ",\n".join(c.strip() for c in (
    NEWS, BARS, INDEX_LOG, IDX_SIG, _fold_sql("idx_sig", "grp"))) + """,
drift AS (SELECT coalesce(sum(coalesce(abs(a1 - b1), 0) + coalesce(abs(a2 - b2), 0)), 0.0) AS d FROM st
          WHERE date > DATE '2024-01-15'),
lab AS (SELECT count(*) AS n FROM news WHERE sentiment_label IS NOT NULL),
rec AS (SELECT avg(correct) AS acc, count(*) AS n FROM (SELECT correct FROM outcomes ORDER BY date DESC LIMIT 10)),
r AS (
  SELECT lab.n AS new_rows, drift.d, rec.acc, rec.n AS last_n,
         CASE WHEN lab.n >= 50 THEN lab.n || ' new labeled headlines since last training'
              WHEN drift.d > 0.2 THEN 'cumulative signal weight drift ' || printf('%.2f', drift.d) || ' > 0.20'
              WHEN rec.n >= 10 AND rec.acc < 0.38
                THEN 'accuracy over last 10 predictions (' || CAST(round(rec.acc * 100) AS INTEGER) || '%) below 38%'
         END AS reason
  FROM lab, drift, rec)
SELECT CAST(reason IS NOT NULL AS INTEGER) AS should_retrain, reason, CAST(new_rows AS BIGINT) AS new_rows,
       round(d, 6) AS cumulative_weight_drift, round(acc, 6) AS last_n_accuracy, last_n
FROM r""")

_FWD_RULES = [
    ("crude_oil_spike", "purchase", ">", 2.0, ["Aviation"], 5.0),
    ("us_markets_fell", "click", "<", -1.0, ["Beta"], 3.0),
    ("risk_off_gold", "error", ">", 1.0, ["Gamma", "Delta"], 3.0),
    ("usdinr_move", "signup", "abs>", 0.5, ["Beta"], 1.5),
]
FWD = "rules(signal_type, series, op, threshold, sector, divisor) AS (VALUES " + ", ".join(
    f"('{t}', '{s}', '{o}', {th}, '{sec}', {d})" for t, s, o, th, secs, d in _FWD_RULES for sec in secs) + ")"

ORACLE["forward_signals"] = with_(NEWS, BARS, DICT, FWD) + """,
asofs AS (SELECT max(date) AS d FROM bars UNION SELECT max(date) - 7 FROM bars),
b AS (SELECT a.d AS upto, bars.*, row_number() OVER (PARTITION BY a.d, name ORDER BY date DESC) AS k
      FROM bars JOIN asofs a ON bars.date <= a.d WHERE close IS NOT NULL),
lastd AS (SELECT upto, max(date) AS last_day FROM b GROUP BY upto),
ch AS (SELECT x.upto, x.name AS series, CASE WHEN y.close <> 0 THEN (x.close / y.close - 1) * 100 END AS change_pct
       FROM b x LEFT JOIN b y ON x.upto = y.upto AND x.name = y.name AND y.k = 2 WHERE x.k = 1),
fired AS (
  SELECT ch.upto, r.signal_type, r.sector, least(abs(ch.change_pct) / r.divisor, 1.0) AS confidence,
         NULL AS source_headline, printf('%s moved %+.2f%%', ch.series, ch.change_pct) AS reasoning
  FROM rules r JOIN ch ON r.series = ch.series
  WHERE (r.op = '>' AND ch.change_pct > r.threshold) OR (r.op = '<' AND ch.change_pct < r.threshold)
     OR (r.op = 'abs>' AND abs(ch.change_pct) > r.threshold)
  UNION ALL
  SELECT l.upto, 'rbi_news', 'Gamma', 0.6, min(headline), 'topic news on the last price date'
  FROM news JOIN lastd l ON CAST(published_at AS DATE) = l.last_day
  WHERE sentiment_label IS NOT NULL AND topic = 'de' GROUP BY l.upto)
SELECT CAST(l.last_day + 1 AS VARCHAR) AS date, f.sector, d.ticker AS stock, f.signal_type, f.reasoning, f.source_headline,
       round(f.confidence, 6) AS confidence
FROM fired f JOIN lastd l ON f.upto = l.upto LEFT JOIN dict d ON d.sector = f.sector"""

# ---------------------------------------------------------------- similarity
STOP = "stop(term) AS (VALUES " + ", ".join(f"({sql_str(w)})" for w in ENGLISH_STOP_WORDS) + ")"
WORD_RUN = r"[\p{L}\p{N}_]{2,}"

TFIDF = """
ctok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '""" + WORD_RUN + """')) AS term FROM documents),
ctf AS (SELECT doc_id, term, count(*) AS tf FROM ctok WHERE term NOT IN (SELECT term FROM stop) GROUP BY 1, 2),
ndocs AS (SELECT count(*) AS n FROM documents),
vocab AS (
  SELECT term, sum(tf) AS cf, count(*) AS df FROM ctf GROUP BY term ORDER BY cf DESC, term ASC LIMIT 2000),
vocab2 AS (SELECT vocab.*, ln((1 + n) / (1 + df)) + 1 AS idf, n AS n_docs FROM vocab, ndocs),
cw0 AS (SELECT c.doc_id, c.term, c.tf * v.idf AS w FROM ctf c JOIN vocab2 v ON c.term = v.term),
cw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM cw0),
qtok AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '""" + WORD_RUN + """')) AS term FROM benchmark),
qtf AS (SELECT item_id, term, count(*) AS tf FROM qtok WHERE term NOT IN (SELECT term FROM stop) GROUP BY 1, 2),
qw0 AS (SELECT q.item_id, q.term, q.tf * v.idf AS w FROM qtf q JOIN vocab2 v ON q.term = v.term),
qw AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS weight FROM qw0),
sims AS (SELECT q.item_id, c.doc_id, sum(q.weight * c.weight) AS similarity
         FROM qw q JOIN cw c ON q.term = c.term GROUP BY 1, 2)"""

ORACLE["tfidf_vocabulary"] = with_(STOP, TFIDF) + """
SELECT term, CAST(cf AS BIGINT) AS cf, df, round(idf, 6) AS idf, n_docs FROM vocab2"""

ORACLE["similar_documents"] = with_(STOP, TFIDF, BARS) + """,
best AS (SELECT doc_id, max(similarity) AS similarity FROM sims GROUP BY doc_id HAVING max(similarity) > 0),
top AS (SELECT doc_id, similarity, CAST(row_number() OVER (ORDER BY round(similarity, 10) DESC, doc_id) AS INTEGER) AS rank
        FROM best QUALIFY rank <= 3),
""" + ctx_sql("vctx", "bars").strip() + """,
dated AS (SELECT t.*, CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(t.doc_id % 30 AS INTEGER)) AS DATE) AS date
          FROM top t),
res AS (SELECT d.*, CASE WHEN c.close <> 0 THEN (c.next_close / c.close - 1) * 100 END AS nsr
        FROM dated d ASOF LEFT JOIN (SELECT * FROM vctx WHERE name = 'view') c ON d.date >= c.date)
SELECT doc_id, round(similarity, 6) AS similarity, rank, CAST(date AS VARCHAR) AS date,
       round(nsr, 2) AS next_session_return,
       CASE WHEN nsr IS NULL THEN 'unresolved' WHEN nsr > 0.3 THEN 'UP' WHEN nsr < -0.3 THEN 'DOWN' ELSE 'FLAT' END
         AS outcome
FROM res"""

ORACLE["similar_per_query"] = with_(STOP, TFIDF) + """
SELECT item_id, doc_id, round(similarity, 6) AS similarity,
       CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(similarity, 10) DESC, doc_id) AS INTEGER) AS rank
FROM sims WHERE similarity > 0 QUALIFY rank <= 3"""

# ---------------------------------------------------------------- ingest and tables
ORACLE["feed_roundtrip"] = with_(NEWS) + """
SELECT topic, coalesce(headline, '') AS headline, coalesce(source, 'Unknown') AS source,
       strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at, '' AS url
FROM news"""

APPEND = """
batch AS (SELECT * FROM news WHERE body IS NOT NULL AND length(body) > 0),
firsts AS (SELECT arg_min(id, id) AS id FROM batch GROUP BY body),
newrows AS (SELECT b.* FROM batch b JOIN firsts f ON b.id = f.id
            WHERE b.body NOT IN (SELECT body FROM news WHERE topic = 'en' AND body IS NOT NULL))"""

ORACLE["dedup_append"] = with_(NEWS, APPEND) + """
SELECT id, topic, source FROM newrows"""

ORACLE["ingest_stats"] = with_(NEWS, APPEND) + """
SELECT (SELECT count(*) FROM news) AS fetched,
       (SELECT count(*) FROM news WHERE body IS NULL OR length(body) = 0) AS skipped,
       (SELECT count(*) FROM newrows) AS inserted,
       (SELECT count(*) FROM news) - (SELECT count(*) FROM news WHERE body IS NULL OR length(body) = 0)
         - (SELECT count(*) FROM newrows) AS duplicates,
       (SELECT count(*) FROM news WHERE topic = 'en') + (SELECT count(*) FROM newrows) AS total"""

ORACLE["first_copy"] = """
SELECT d.doc_id, d.lang, d.source FROM documents d
JOIN (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text) f ON d.doc_id = f.doc_id"""

VERSIONS = """
target AS (SELECT doc_id, quality, toxic, 0 AS version FROM labels),
updates AS (SELECT doc_id, CAST(n_chars > 2000 AS INTEGER) AS quality, 0 AS toxic, 1 AS version
            FROM documents)"""

ORACLE["upsert_labels"] = with_(VERSIONS) + """
SELECT doc_id, arg_max(quality, (version, src)) AS quality, arg_max(toxic, (version, src)) AS toxic,
       max(version) AS version
FROM (SELECT *, 0 AS src FROM target UNION ALL SELECT *, 1 AS src FROM updates) GROUP BY doc_id"""

ORACLE["insert_ignore_labels"] = with_(VERSIONS) + """
SELECT * FROM target
UNION ALL
SELECT * FROM updates WHERE doc_id NOT IN (SELECT doc_id FROM target)"""

ORACLE["patch_labels"] = with_(VERSIONS) + """
SELECT t.doc_id, coalesce(u.quality, t.quality) AS quality, t.toxic, t.version
FROM target t LEFT JOIN updates u ON t.doc_id = u.doc_id"""

ORACLE["seed_signal_weights"] = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS, PREDICTIONS,
                                      SIG_OUTCOMES) + """
SELECT DISTINCT signal AS signal_name, CAST(1.0 AS DOUBLE) AS current_weight, 0 AS consecutive_wrong,
       CAST(NULL AS DOUBLE) AS pre_decay_weight
FROM sig_outcomes"""

# ---------------------------------------------------------------- views
_ROUT = with_(NEWS, DICT, TOPICS, LABELED_MATCHES, ROUTED)

ORACLE["sentiment_by_day"] = _ROUT + """
SELECT CAST(CAST(published_at AS DATE) AS VARCHAR) AS day,
       count(*) FILTER (WHERE sentiment_label = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS negative
FROM routed GROUP BY 1"""

ORACLE["sector_sentiment"] = _ROUT + """
SELECT sector, round(avg(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1
                                               WHEN 'neutral' THEN 0 END), 6) AS mean_sign, count(*) AS n,
       CASE WHEN avg(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END) > 0.05
            THEN 'positive'
            WHEN avg(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END) < -0.05
            THEN 'negative' ELSE 'neutral' END AS band
FROM routed GROUP BY sector"""

ORACLE["top_sources"] = _ROUT + """
SELECT source, count(*) AS n FROM routed GROUP BY source ORDER BY n DESC, source LIMIT 10"""

ORACLE["latest_events"] = _ROUT + """
SELECT article_id, ticker, strftime(published_at, '%Y-%m-%d') AS published_at, matched_via
FROM routed ORDER BY published_at DESC, article_id DESC, ticker LIMIT 50"""

ORACLE["label_frequency"] = _ROUT + """
SELECT r.sentiment_label, count(*) AS n, any_value(o.position) AS position
FROM routed r JOIN (VALUES ('positive', 0), ('neutral', 1), ('negative', 2)) o(label, position)
  ON r.sentiment_label = o.label
GROUP BY 1"""

ORACLE["selected_events"] = _ROUT + """
SELECT article_id, ticker, sector, sentiment_label FROM routed
WHERE sector IN ('Alpha', 'Gamma') AND sentiment_label IN ('positive', 'negative')"""

ORACLE["recent_prices"] = with_(SPARSE_PRICES) + """
SELECT name, count(*) AS n, CAST(min(date) AS VARCHAR) AS first_date FROM sparse_prices
WHERE date >= (SELECT max(date) FROM sparse_prices) - INTERVAL 180 DAY GROUP BY name"""

ORACLE["annotated_bars"] = with_(BARS) + """
SELECT name, CAST(b.date AS VARCHAR) AS date, round(open, 6) AS open, round(high, 6) AS high,
       round(low, 6) AS low, round(close, 6) AS close, volume, e.marker
FROM bars b LEFT JOIN (VALUES (DATE '2024-01-08', 'second week'), (DATE '2024-01-15', 'mid-month'),
                              (DATE '2024-01-29', 'last week')) e(date, marker) ON b.date = e.date"""

ORACLE["routing_coverage"] = _ROUT + """
SELECT count(DISTINCT ticker) AS n_tickers, count(DISTINCT source) AS n_sources,
       count(DISTINCT article_id) AS n_articles, count(DISTINCT CAST(published_at AS DATE)) AS n_days,
       CAST(min(CAST(published_at AS DATE)) AS VARCHAR) AS first_day,
       CAST(max(CAST(published_at AS DATE)) AS VARCHAR) AS last_day, count(*) AS n_rows
FROM routed"""

ORACLE["latest_in_flight"] = with_(SPARSE_PRICES, SHIP_PROBES, PRICE_CONTEXT, SESSION_RETURNS) + """
SELECT name, CAST(max(date) AS VARCHAR) AS date, round(arg_max(close, date), 6) AS close
FROM labelled WHERE label IS NULL GROUP BY name"""

# ---------------------------------------------------------------- streaming
ORACLE["stream_ingest"] = with_(NEWS) + """
SELECT DISTINCT sha256(body) AS text_sha256 FROM news WHERE body IS NOT NULL AND length(body) > 0"""

ORACLE["stream_daily_counts"] = with_(NEWS) + """
SELECT CAST(CAST(published_at AS DATE) AS VARCHAR) AS day, topic, count(*) AS n_headlines,
       count(*) FILTER (WHERE sentiment_label = 'positive') AS n_positive,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS n_negative,
       count(*) FILTER (WHERE sentiment_label = 'neutral') AS n_neutral,
       round(avg(sentiment_confidence), 6) AS avg_confidence,
       round(avg(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END
                 * sentiment_confidence), 6) AS net_sentiment
FROM news GROUP BY 1, 2"""

ORACLE["stream_signal_weights"] = ORACLE["signal_weights"]

ORACLE["influential_headlines"] = _ROUT + """,
s AS (SELECT *, sentiment_confidence * greatest(abs(CASE sentiment_label WHEN 'positive' THEN 1
             WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END), 0.01) AS strength,
             CAST(published_at AS DATE) AS d FROM routed),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY ticker, d ORDER BY strength DESC, article_id) AS INTEGER) AS rank
      FROM s)
SELECT ticker, CAST(d AS VARCHAR) AS date, article_id, source, sentiment_label, round(strength, 6) AS strength, rank
FROM r WHERE rank <= 5"""

ORACLE["event_props"] = """
SELECT event_type, round(avg(CAST(json_extract(props, '$.k') AS INTEGER)), 6) AS mean_k,
       max(CAST(json_extract(props, '$.k') AS INTEGER)) AS max_k, count(*) AS n
FROM events GROUP BY event_type"""


ORACLE["stream_dedup_watermark"] = ORACLE["stream_ingest"]
ORACLE["stream_outcomes"] = ORACLE["resolved_outcomes"]
ORACLE["stream_ingest_stats"] = ORACLE["ingest_stats"]
ORACLE["stream_source_credibility"] = ORACLE["source_credibility"]
ORACLE["stream_retrain_check"] = ORACLE["retrain_trigger"]

ORACLE["stream_routed"] = with_(NEWS, DICT, TOPICS, LABELED_MATCHES, ROUTED) + """,
f AS (SELECT arg_min(id, (published_at, source, topic, sentiment_confidence)) AS id FROM labeled WHERE length(body) > 0 GROUP BY body)
SELECT sha256(r.headline) AS text_sha256, r.source, r.ticker, r.sector, r.matched_via
FROM routed r JOIN f ON r.article_id = f.id"""

# ---------------------------------------------------------------- operators on their own
ORACLE["prices_wide"] = with_(SPARSE_PRICES, BARS) + """
SELECT name, CAST(date AS VARCHAR) AS date, round(close, 6) AS close FROM sparse_prices WHERE close IS NOT NULL
UNION ALL SELECT name, CAST(date AS VARCHAR), round(close, 6) FROM bars"""

ORACLE["sector_dimension"] = with_(NATION_DIM) + """
SELECT ticker, name, CASE WHEN sector = 'ASIA' THEN 'Index' ELSE sector END AS sector FROM nation_dim"""

ORACLE["evolved_labels"] = """
SELECT doc_id, quality, toxic, false AS reviewed, CAST(NULL AS VARCHAR) AS note FROM labels"""

ORACLE["labeling_template"] = with_(NEWS) + """
SELECT headline, source, topic, strftime(published_at, '%Y-%m-%d') AS published_at, '' AS sentiment_label FROM news"""

ORACLE["renamed_prices"] = with_(BARS) + """,
m(series, ticker) AS (VALUES """ + ", ".join(f"({sql_str(s)}, {sql_str(t)})" for t, s in TICKER_SERIES[:5]) + """),
b AS (SELECT CASE WHEN name = 'error' THEN 'unknown' ELSE name END AS name, date, close FROM bars)
SELECT b.name, coalesce(m.ticker, b.name) AS display, CAST(b.date AS VARCHAR) AS date, round(b.close, 6) AS close
FROM b LEFT JOIN m ON b.name = m.series"""

ORACLE["complete_dates"] = with_(BARS) + """,
b AS (SELECT name, date, close FROM bars WHERE NOT (name = 'click' AND day(date) % 3 = 0))
SELECT name, CAST(date AS VARCHAR) AS date, round(close, 6) AS close FROM b
WHERE date IN (SELECT date FROM b WHERE close IS NOT NULL GROUP BY date
               HAVING count(DISTINCT name) = (SELECT count(DISTINCT name) FROM b))"""

ORACLE["clean_labels"] = with_(NEWS) + """
SELECT id, sentiment_label AS label FROM news WHERE id % 5 <> 0 AND id % 7 <> 0 AND sentiment_label IS NOT NULL"""

ORACLE["day_fields"] = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 3 AS VARCHAR) AS shifted,
       CAST(CAST(o_orderdate AS DATE) < DATE '1995-06-17' AS INTEGER) AS before,
       strftime(o_orderdate, '%Y%m') AS month, lower(o_orderstatus) AS status, CAST(length(o_orderpriority) AS INTEGER) AS n
FROM orders"""

ORACLE["latest_run"] = with_(BARS) + """
SELECT CAST(date AS VARCHAR) AS date, round(close, 6) AS close, volume FROM bars WHERE name = 'view' ORDER BY bars.date DESC LIMIT 1"""

ORACLE["weight_snapshots"] = _LEARN_HEAD + """,
f AS (SELECT name, signal, w FROM st WHERE (name, signal, k) IN (SELECT name, signal, max(k) FROM st GROUP BY 1, 2))
SELECT name, CAST(count(*) AS INTEGER) AS n_signals, round(max(w) FILTER (WHERE signal = 'stock_momentum'), 6) AS stock_momentum
FROM f GROUP BY name"""

ORACLE["feed_failures"] = with_(NEWS) + """
SELECT topic, CAST(count(*) AS BIGINT) AS n_articles, CAST(CASE WHEN topic IN ('de', 'fr') THEN 1 ELSE 0 END AS BIGINT) AS n_malformed,
       CASE WHEN topic IN ('de', 'fr') THEN 1 ELSE 0 END AS failed
FROM news GROUP BY topic"""

ORACLE["split_guard"] = with_(NEWS, DICT, TOPICS, MATCHES, ROUTED, DAILY, BARS, TSERIES, MSERIES, FEATURES) + """,
p AS (SELECT * FROM feat WHERE label IS NOT NULL),
dates AS (SELECT date, row_number() OVER (ORDER BY date) AS rn FROM (SELECT DISTINCT date FROM p)),
nd AS (SELECT count(*) AS n FROM dates),
sd AS (SELECT d.date AS split FROM dates d, nd WHERE d.rn = least(greatest(1, CAST(floor(nd.n * 0.8) AS BIGINT)) + 1, nd.n)),
g AS (SELECT count(*) AS rows, count(*) FILTER (WHERE date < split) AS train, count(*) FILTER (WHERE date >= split) AS test,
             count(DISTINCT CASE WHEN date < split THEN label END) AS classes FROM p, sd)
SELECT CAST(rows >= 40 AND test > 0 AND classes >= 2 AS INTEGER) AS ok,
       CASE WHEN rows < 40 THEN 'only ' || rows || ' labelled rows (< 40)' WHEN test = 0 THEN 'empty test slice'
            WHEN classes < 2 THEN 'fewer than 2 classes in the train slice' END AS reason, rows, train, test, classes
FROM g"""
