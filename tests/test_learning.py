import datetime as dt
import random

from pyspark.sql import functions as F

from tidings.operators import learning as lr
from tidings.streaming.state import fold


def _weights(spark, seqs):
    rows = []
    for key, seq in seqs.items():
        for i, ch in enumerate(seq):
            rows.append((key, dt.date(2024, 1, 1) + dt.timedelta(days=i), 1 if ch == "C" else 0))
    df = spark.createDataFrame(rows, "signal string, date date, correct int")
    return {r.signal: r for r in lr.adjust_weights(df, ["signal"], signals=list(seqs)).collect()}


def test_weights_skip_and_stored_state(spark):
    rows = [(s, dt.date(2024, 1, i), 0) for s in ("sector", None, "sp500", "usdinr") for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "signal string, date date, correct int")
    stored = spark.createDataFrame([("usdinr", 0.7, 0, 0, 3, 0, 1.4)], "signal string, current_weight double, "
                                   "consecutive_wrong int, consecutive_correct int, wrong_since_adjustment int, "
                                   "correct_since_adjustment int, pre_decay_weight double")
    state = lr.adjust_weights(df, ["signal"], stored=stored)
    got = {r.signal: r for r in state.collect()}
    assert set(got) == {"sp500", "usdinr"}  # "sector" and NULL are not judged
    assert got["sp500"].current_weight == 0.5
    # already decayed: no second decay; the 5th wrong attribution takes 10 % off
    assert abs(got["usdinr"].current_weight - 0.63) < 1e-12 and got["usdinr"].pre_decay_weight == 1.4
    assert abs(lr.drift_since(state, ["signal"], None).first()[0] - 0.57) < 1e-12
    assert abs(lr.drift_since(state, ["signal"], "2024-01-02").first()[0] - 0.5) < 1e-12
    assert lr.drift_since(state, ["signal"], "2024-01-03").first()[0] == 0.0


def test_weight_machine_examples(spark):
    seqs = {"a": "WWW", "b": "WWWCC", "c": "WWWWW", "d": "WWWWWCCCCC", "e": "W" * 60}
    got = _weights(spark, seqs)
    assert abs(got["a"].current_weight - 0.5) < 1e-12
    assert abs(got["b"].current_weight - 1.0) < 1e-12
    assert abs(got["c"].current_weight - 0.45) < 1e-12
    assert abs(got["d"].current_weight - 1.1) < 1e-12
    assert abs(got["e"].current_weight - 0.2) < 1e-12
    assert sum(1 for x in got["e"].log if x.kind == "decay") == 1


def test_weight_machine_equals_python_fold(spark):
    rnd = random.Random(11)
    seqs = {f"s{i}": "".join(rnd.choice("CW") for _ in range(rnd.randint(1, 120))) for i in range(30)}
    got = _weights(spark, seqs)
    for k, seq in seqs.items():
        w, cw, cc, wa, ca, pd_, drift, n = fold((1.0, 0, 0, 0, 0, None, 0.0, 0), [c == "C" for c in seq])
        r = got[k]
        assert abs(r.current_weight - w) < 1e-12 and r.consecutive_wrong == cw and r.consecutive_correct == cc
        assert r.wrong_since_adjustment == wa and r.correct_since_adjustment == ca
        assert (r.pre_decay_weight is None) == (pd_ is None) and abs(r.drift - drift) < 1e-9


def test_source_credibility_sticky(spark):
    # one source; 19 wrong, then 1 right (20 seen, 5 %) -> 0.3; then many right -> climbs past 50 % but stays 0.3
    n = 19 + 1 + 20
    outcomes = spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=i), dt.date(2024, 1, 1) + dt.timedelta(days=i),
          0 if i < 19 else 1) for i in range(n)], "news_date date, date date, correct int")
    routed = spark.createDataFrame(
        [("IDX", "src", dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(n)],
        "ticker string, source string, published_at timestamp")
    c = {r.date: r for r in lr.source_credibility(outcomes, routed, "IDX").collect()}
    days = sorted(c)
    assert c[days[18]].current_weight == 1.0 and c[days[18]].total_predictions == 19
    assert c[days[19]].current_weight == 0.3
    assert c[days[-1]].accuracy_rate > 0.5 and c[days[-1]].current_weight == 0.3


def _trigger(spark, new_rows, drift, last):
    state = spark.createDataFrame([(0, drift)], "last_retrain_headline_count long, cumulative_weight_drift double")
    lab = spark.createDataFrame([(new_rows,)], "total_labeled long")
    outc = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(last)],
                                 "date date, correct int")
    return lr.retrain_trigger(state, lab, lr.last_n_accuracy(outc)).first()


def test_retrain_trigger(spark):
    assert _trigger(spark, 49, 0.0, [1] * 10).should_retrain == 0
    assert _trigger(spark, 50, 0.0, [1] * 10).should_retrain == 1
    assert _trigger(spark, 0, 0.20, [1] * 10).should_retrain == 0
    assert _trigger(spark, 0, 0.21, [1] * 10).should_retrain == 1
    assert _trigger(spark, 0, 0.0, [0] * 9).should_retrain == 0
    r = _trigger(spark, 0, 0.0, [1, 1, 1] + [0] * 7)
    assert r.should_retrain == 1 and "30%" in r.reason


def test_forward_signals_thresholds(spark):
    dim = spark.createDataFrame([("I1", "IT"), ("I2", "IT"), ("F1", "FMCG")], "ticker string, sector string")
    rules = spark.createDataFrame([("crude_oil_spike", "crude", ">", 2.0, ["Aviation"], 5.0),
                                   ("us_markets_fell", "sp", "<", -1.0, ["IT"], 3.0)], lr.FORWARD_RULE_SCHEMA)
    for crude, sp, want in [(2.0, -1.0, []), (2.1, -1.1, [("Aviation", None), ("IT", "I1"), ("IT", "I2")])]:
        ch = spark.createDataFrame([("crude", crude), ("sp", sp)], "series string, change_pct double")
        got = sorted((r.sector, r.stock) for r in lr.forward_signals(ch, rules, dim).collect())
        assert got == sorted(want, key=lambda t: (t[0], t[1] or ""))
    assert F is not None
