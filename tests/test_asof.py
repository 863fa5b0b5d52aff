import datetime as dt
import random

from tidings.operators import asof

D = dt.date


def _prices(spark, rows):
    return spark.createDataFrame(rows, "name string, date date, close double")


def test_session_returns_edges(spark):
    # prices for A on days 2, 3, 5, 6, 9; B has a zero baseline on day 3
    prices = _prices(spark, [("A", D(2024, 1, 2), 100.0), ("A", D(2024, 1, 3), 101.0), ("A", D(2024, 1, 5), 99.0),
                             ("A", D(2024, 1, 6), 103.0), ("A", D(2024, 1, 9), 104.0),
                             ("B", D(2024, 1, 2), 5.0), ("B", D(2024, 1, 3), 0.0), ("B", D(2024, 1, 4), 3.0)])
    probes = spark.createDataFrame([
        ("A", D(2024, 1, 1)),  # before the first price
        ("A", D(2024, 1, 3)),  # on a trading day: same-day close is the baseline
        ("A", D(2024, 1, 4)),  # in a gap: previous close
        ("A", D(2024, 1, 6)),  # 4th price: momentum available
        ("A", D(2024, 1, 9)),  # last day: no next close
        ("C", D(2024, 1, 3)),  # unknown name
        ("B", D(2024, 1, 3)),  # zero baseline
    ], "name string, date date")
    r = {(x.name, x.date): x for x in asof.session_returns(probes, prices).collect()}
    assert r[("A", D(2024, 1, 1))].close is None and r[("A", D(2024, 1, 1))].label is None
    a3 = r[("A", D(2024, 1, 3))]
    assert a3.close == 101.0 and a3.next_close == 99.0
    assert abs(a3.next_session_return - (99.0 / 101.0 - 1) * 100) < 1e-12 and a3.label == "DOWN"
    assert a3.prior_1d_return is None  # only 2 prices at or before
    a4 = r[("A", D(2024, 1, 4))]
    assert a4.close == 101.0 and a4.next_close == 99.0
    a6 = r[("A", D(2024, 1, 6))]
    assert abs(a6.prior_1d_return - (103.0 / 99.0 - 1) * 100) < 1e-12
    assert abs(a6.prior_3d_return - (103.0 / 100.0 - 1) * 100) < 1e-12
    assert r[("A", D(2024, 1, 9))].next_session_return is None
    assert r[("C", D(2024, 1, 3))].close is None
    assert r[("B", D(2024, 1, 3))].next_session_return is None


def _brute(prices, probes, direction, exact):
    out = {}
    for name, t in probes:
        ts = sorted(d for n, d, _ in prices if n == name)
        vals = {d: v for n, d, v in prices if n == name}
        if direction == "backward":
            c = [d for d in ts if (d <= t if exact else d < t)]
            out[(name, t)] = vals[c[-1]] if c else None
        else:
            c = [d for d in ts if (d >= t if exact else d > t)]
            out[(name, t)] = vals[c[0]] if c else None
    return out


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    prices, seen = [], set()
    for _ in range(300):
        n = rnd.choice("ABCD") if rnd.random() < 0.6 else "HOT"
        d = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
        if (n, d) not in seen:
            seen.add((n, d))
            prices.append((n, d, float(rnd.randint(1, 1000))))
    probes = sorted({(rnd.choice("ABCDEH") if rnd.random() < 0.7 else "HOT",
                      D(2019, 12, 1) + dt.timedelta(days=rnd.randint(0, 480))) for _ in range(400)})
    right = spark.createDataFrame(prices, "name string, t date, v double")
    left = spark.createDataFrame(probes, "name string, t date")
    for direction in ("backward", "forward"):
        for exact in (True, False):
            for width in (None, 3):  # small buckets exercise intervals spanning many buckets
                got = asof.asof_join(left, right, "name", "t", "t", ["v"], direction, exact, bucket_width=width)
                g = {(r.name, r.t): r.v for r in got.collect()}
                assert g == _brute(prices, probes, direction, exact), (direction, exact, width)


def test_sequence_and_neighbours(spark):
    rows = [("K", D(2024, 1, 1) + dt.timedelta(days=3 * i), float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "name string, date date, close double")
    seq = asof.sequence(df, "name", "date", "rn", bucket_width=7)
    got = sorted((r.rn, r.close) for r in seq.collect())
    assert got == [(i + 1, float(i)) for i in range(50)]
    nb = asof.with_neighbours(seq, "name", "rn", ["close"], {"p": 1, "n": -1}).collect()
    for r in nb:
        assert r.p_close == (r.close - 1 if r.rn > 1 else None)
        assert r.n_close == (r.close + 1 if r.rn < 50 else None)
