import random
import re

from pyspark.sql import functions as F

from tidings.operators import routing as rt
from tidings.operators import text as tx

RULE_ROWS = [
    ("Fed holds rates steady", "negative", "neutral", "rate_hold"),
    ("RBI hikes repo rate", "positive", "negative", "rate_hike"),
    ("RBI cuts repo rate", "negative", "positive", "rate_cut"),
    ("Nifty rallies", "neutral", "positive", "market_rally"),
    ("Sensex falls", "neutral", "negative", "market_fall"),
    ("Sensex falls, Nifty gains", "neutral", "neutral", None),
    ("Week ahead: what to expect", "positive", "neutral", "preview_digest"),
    ("Debt supply stalls bond rally", "negative", "negative", None),
]


def test_label_rules_cascade_and_idempotence(spark):
    df = spark.createDataFrame([(i, h, l) for i, (h, l, _, _) in enumerate(RULE_ROWS)],
                               "id int, headline string, sentiment_label string")
    once = tx.apply_label_rules(df)
    got = {r.id: (r.sentiment_label, r.rule) for r in once.collect()}
    for i, (_, _, new, rule) in enumerate(RULE_ROWS):
        assert got[i] == (new, rule), RULE_ROWS[i]
    twice = tx.apply_label_rules(once.drop("rule"))
    assert {r.id: (r.sentiment_label, r.rule) for r in twice.collect()} == got


DIM = [("SBIN", "SBI", "Banking"), ("SBILIFE", "SBI Life", "Finance"), ("TCS", "TCS", "IT"),
       ("ITC", "ITC", "FMCG"), ("MM", "Mahindra & Mahindra", "Auto"), ("DRR", "Dr Reddy's", "Pharma"),
       ("IDX", "NIFTY 50 Index", "Index")]


def _route_names(spark, texts):
    dim = spark.createDataFrame(DIM, "ticker string, name string, sector string").where(F.col("sector") != "Index")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    m = tx.suppress_contained(tx.match_terms(df, "id", "text", dim), "id", "ticker")
    out = {}
    for r in m.collect():
        out.setdefault(r.id, set()).add(r.ticker)
    return out


def test_dictionary_match_examples(spark):
    got = _route_names(spark, ["SBI Life beats SBI", "SBI and SBI Life", "tcs gains", "PITCH deck",
                               "Mahindra & Mahindra and Dr Reddy's up", "SBIN"])
    assert got.get(0) == {"SBILIFE"}
    assert got.get(1) == {"SBIN", "SBILIFE"}
    assert got.get(2) == {"TCS"}
    assert 3 not in got
    assert got.get(4) == {"MM", "DRR"}
    assert 5 not in got


def _all_spans(texts, dim):
    """Every name's first span, then without those inside a longer one."""
    res = {}
    for i, t in enumerate(texts):
        first = {tick: re.search(r"(?i)\b" + re.escape(name) + r"\b", t) for tick, name, sector in dim if sector != "Index"}
        spans = {tick: m.span() for tick, m in first.items() if m}
        kept = {tick for tick, (s, e) in spans.items()
                if not any(a <= s and e <= b and b - a > e - s for a, b in spans.values())}
        if kept:
            res[i] = kept
    return res


def test_dictionary_match_equals_all_spans(spark):
    rnd = random.Random(3)
    words = ["SBI", "Life", "TCS", "tcs", "ITC", "PITCH", "Mahindra", "&", "Dr", "Reddy's", "é", "and", "x"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    want = _all_spans(texts, DIM)
    assert _route_names(spark, texts) == want


def test_route_branches(spark):
    dim = spark.createDataFrame(DIM, "ticker string, name string, sector string")
    topics = spark.createDataFrame([("RBI", "Banking"), ("NIFTY", "Index")], "topic string, sector string")
    news = spark.createDataFrame([
        (1, "RBI", "SBI raises deposit rates", "s", None, "positive", 0.9),
        (2, "NIFTY", "Markets open flat", "s", None, "neutral", 0.5),
        (3, "Other", "Nothing here", "s", None, "neutral", 0.5),
    ], "id long, topic string, headline string, source string, published_at timestamp, "
       "sentiment_label string, sentiment_confidence double")
    r = rt.route(news, dim, topics, "IDX").collect()
    got = sorted((x.article_id, x.ticker, x.matched_via) for x in r)
    assert got == [(1, "SBIN", "company_name"), (2, "IDX", "topic_macro")]
