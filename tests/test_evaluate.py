import datetime as dt

from tidings.operators import evaluate as ev

# Golden confusion matrix of 46 published test predictions
# (rows actual, columns predicted: DOWN, FLAT, UP).
GOLDEN = {"DOWN": (5, 4, 8), "FLAT": (4, 6, 4), "UP": (5, 1, 9)}


def _rows():
    out, i = [], 0
    for actual, counts in GOLDEN.items():
        for pred, n in zip(("DOWN", "FLAT", "UP"), counts):
            for _ in range(n):
                out.append((i, actual, pred))
                i += 1
    return out


def test_golden_accuracy_and_matrix(spark):
    df = spark.createDataFrame(_rows(), "id int, label string, predicted_label string")
    acc = {r["class"]: r.accuracy for r in ev.agreement(df, "label", "predicted_label").collect()}
    assert abs(acc["ALL"] - 20 / 46) < 1e-12
    cm = {r.actual: (r.DOWN, r.FLAT, r.UP) for r in ev.confusion_matrix(df, "label", "predicted_label").collect()}
    assert cm == GOLDEN
    rep = {r["class"]: r for r in ev.classification_report(df, "label", "predicted_label").collect()}
    assert rep["UP"].support == 15 and abs(rep["UP"].recall - 9 / 15) < 1e-12
    assert abs(rep["UP"].precision - 9 / 21) < 1e-12
    base = ev.majority_baseline(df, df, "label").first()
    assert base.majority_label == "DOWN"  # 17 rows
    assert abs(base.baseline_accuracy - 17 / 46) < 1e-12


def test_majority_tie_and_never_predicted(spark):
    df = spark.createDataFrame([("UP", "UP"), ("DOWN", "UP"), ("FLAT", "UP"), ("FLAT", "UP"), ("UP", "UP")],
                               "label string, predicted_label string")
    assert ev.majority_label(df, "label").first()[0] == "FLAT"  # FLAT and UP tie at 2 -> smaller
    rep = {r["class"]: r for r in ev.classification_report(df, "label", "predicted_label").collect()}
    assert rep["DOWN"].precision == 0.0 and rep["FLAT"].f1 == 0.0


def test_time_split_index(spark):
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(29)]
    df = spark.createDataFrame([(d,) for d in dates], "date date")
    s = ev.split_date(df).first()
    assert s.split_date == dates[23] and s.n_dates == 29
    one = spark.createDataFrame([(dates[0],)], "date date")
    assert ev.split_date(one).first().split_date == dates[0]
    g = ev.training_guard(spark.createDataFrame([("UP",)] * 39 + [(None,)], "label string"), "label").first()
    assert g.ok == 0 and "39" in g.reason


def test_folds_are_balanced(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "id long, y int")
    f = ev.stratified_folds(df, "id", "y", 5)
    counts = {(r.fold, r.y): r["count"] for r in f.groupBy("fold", "y").count().collect()}
    assert set(counts.values()) == {20}
    h = ev.holdout(df, "id", 0.1)
    assert h.where("holdout = 1").count() == 30


def test_folds_and_holdout_with_large_ids(spark):
    ids = [5, 5 + (1 << 32), 4_000_000_000, 9_000_000_000_000_000_000, -7, 12, 13, 14, 15, 16]
    df = spark.createDataFrame([(i, "a") for i in ids], "id long, label string")
    f = [r.fold for r in ev.stratified_folds(df, "id", "label", 5).collect()]
    assert sorted(f) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    one = {r.id for r in ev.holdout(df, "id", 0.3).where("holdout = 1").collect()}
    assert len(one) == 3 and one == {r.id for r in ev.holdout(df.repartition(3), "id", 0.3).where("holdout = 1").collect()}


def test_live_models_are_refused_with_a_reason(spark):
    import datetime as dt
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = lambda n, labels: spark.createDataFrame([(day(i), labels[i % len(labels)]) for i in range(n)], "date date, label string")
    assert ev.refusal(rows(19, ["UP", "DOWN"])) == "only 19 labelled rows (< 20)"
    assert ev.refusal(rows(40, ["UP"])) == "fewer than 2 classes in the train slice"
    assert ev.refusal(rows(40, ["UP", "DOWN"])) is None
