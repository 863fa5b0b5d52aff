"""Evaluation: A17-A21, A24, A25, W13-W15, M13, M14.

All metrics are aggregates over (actual, predicted) rows; per-class
tables have at most (classes x classes) rows. Rankings that need a global
order (folds, hold-out) use ``asof.sequence`` over a hash, so no window
holds a whole class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.columns import DIRECTIONS
from tidings.operators.asof import sequence

TEST_FRACTION = 0.2
MIN_ROWS = 40
LIVE_MIN_ROWS = 20
ROWS_PER_BUCKET = 4096


def seeded_order(id_col, seed: int = 42) -> Column:
    """A reproducible pseudo-random order key for integer ids: a
    multiplicative hash of (id + seed) in [0, 2^32). The id is reduced to 31
    bits first, so no id overflows; ids that then tie are ordered by id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    small = F.pmod(F.pmod(c.cast("long"), F.lit(1 << 31)) + F.lit(seed), F.lit(1 << 31))
    return F.pmod(small * F.lit(2654435761), F.lit(1 << 32))


def _bucket_width(rows: int) -> int:
    """Hash range per bucket so that one holds about ROWS_PER_BUCKET rows."""
    return max(1, (1 << 32) * ROWS_PER_BUCKET // max(rows, ROWS_PER_BUCKET))


def agreement(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Overall and per-actual-class agreement rate."""
    ok = (F.col(actual) == F.col(pred)).cast("int")
    per = df.groupBy(F.col(actual).alias("class")).agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n"))
    allr = df.agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n")).withColumn("class", F.lit("ALL"))
    return per.unionByName(allr)


def confusion_matrix(df: DataFrame, actual: str, pred: str, order=DIRECTIONS) -> DataFrame:
    """Counts with actual classes as rows and predicted classes as
    columns in a fixed order, zeros filled."""
    return df.groupBy(F.col(actual).alias("actual")).pivot(pred, list(order)).agg(F.count(F.lit(1))) \
        .fillna(0, subset=list(order))


def classification_report(df: DataFrame, actual: str, pred: str, order=DIRECTIONS) -> DataFrame:
    """Precision, recall, F1 and support per class plus macro and
    weighted averages; 0 where a denominator is 0."""
    tp = df.groupBy(F.col(actual).alias("class")).agg(
        F.count(F.lit(1)).alias("support"), F.count_if(F.col(actual) == F.col(pred)).alias("tp"))
    pp = df.groupBy(F.col(pred).alias("class")).agg(F.count(F.lit(1)).alias("predicted"))
    classes = df.sparkSession.createDataFrame([(c,) for c in order], "class string")
    t = classes.join(tp, "class", "left").join(pp, "class", "left").fillna(0, ["support", "tp", "predicted"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    t = t.withColumn("precision", prec).withColumn("recall", rec).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                      F.col("precision") + F.col("recall")), F.lit(0.0)))
    per = t.select("class", "precision", "recall", "f1", F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), tot), F.lit(0.0))
                       .alias("precision"),
                       F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), tot), F.lit(0.0))
                       .alias("recall"),
                       F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), tot), F.lit(0.0)).alias("f1"),
                       tot.alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def split_date(df: DataFrame, date_col: str = "date", test_fraction: float = TEST_FRACTION) -> DataFrame:
    """One row (split_date, n_dates): the distinct date at 0-based
    index max(1, floor(n * (1 - test_fraction))) in ascending order, or the
    last date when the index is past the end. Distinct dates are bounded
    by the calendar; their rank comes from ``sequence``."""
    d = df.select(date_col).distinct().withColumn("_g", F.lit(1))
    seq = sequence(d, "_g", date_col, "_rn")
    n = d.count()
    idx = max(1, int(n * (1 - test_fraction)))
    pos = min(idx + 1, n)
    return seq.where(F.col("_rn") == pos).select(F.col(date_col).alias("split_date"),
                                                 F.lit(n).cast("long").alias("n_dates"))


def time_split(df: DataFrame, date_col: str = "date", test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Tag each row ``part`` = train (date < split date) or test. The
    split date is one scalar read from the distinct-date sequence."""
    return _tag_split(df, split_date(df, date_col, test_fraction), date_col)


def _tag_split(df: DataFrame, s: DataFrame, date_col: str) -> DataFrame:
    sd = s.first()
    if sd is None:
        return df.withColumn("part", F.lit(None).cast("string"))
    return df.withColumn("part", F.when(F.col(date_col) < F.lit(sd["split_date"]), "train").otherwise("test"))


def majority_label(df: DataFrame, label: str) -> DataFrame:
    """Most frequent label (ties -> alphabetically smallest), one row."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return c.agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("majority_label"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Majority label of ``train`` and its accuracy on ``test``."""
    m = majority_label(train, label).first()
    maj = m["majority_label"] if m else None
    return test.agg(F.avg((F.col(label) == F.lit(maj)).cast("int")).alias("baseline_accuracy")) \
        .withColumn("majority_label", F.lit(maj))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    t = tot.first()
    return c.withColumn("weight", F.lit(float(t["n"])) / (F.lit(int(t["k"])) * F.col("n_c")))


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """fold = (position within the class in seeded hash order - 1) mod
    k, so every class is spread evenly over the folds."""
    h = df.withColumn("_h", seeded_order(id_col, seed))
    seq = sequence(h, label, "_h", "_rn", _bucket_width(df.count()), [id_col])
    return seq.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn")


def holdout(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """``holdout`` = 1 for the first max(1, floor(n * fraction)) rows in
    seeded hash order."""
    h = df.withColumn("_h", seeded_order(id_col, seed)).withColumn("_g", F.lit(1))
    n = df.count()
    seq = sequence(h, "_g", "_h", "_rn", _bucket_width(n), [id_col])
    cut = max(1, int(n * fraction))
    return seq.withColumn("holdout", (F.col("_rn") <= cut).cast("int")).drop("_h", "_g", "_rn")


def fold_summary(per_fold: DataFrame, score: str = "accuracy") -> DataFrame:
    """Mean and population std of a per-fold score."""
    return per_fold.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"),
                        F.count(F.lit(1)).alias("n_folds"))


def split_guard(parts: DataFrame, label: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """M14 on a time split (``part``): one row (ok, reason, rows, train, test,
    classes): enough labelled rows, a test slice, at least two classes in the
    train slice. Live models pass ``LIVE_MIN_ROWS``."""
    known = F.col(label).isNotNull()
    a = parts.where(known).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("part") == "train").alias("train"),
                               F.count_if(F.col("part") == "test").alias("test"),
                               F.count_distinct(F.when(F.col("part") == "train", F.col(label))).alias("classes"))
    reason = (F.when(F.col("rows") < min_rows, F.concat(F.lit("only "), F.col("rows").cast("string"),
                                                         F.lit(f" labelled rows (< {min_rows})")))
              .when(F.col("test") == 0, F.lit("empty test slice"))
              .when(F.col("classes") < 2, F.lit("fewer than 2 classes in the train slice")))
    return a.select(reason.isNull().cast("int").alias("ok"), reason.alias("reason"), "rows", "train", "test", "classes")


def refusal(labelled: DataFrame, label: str = "label", date_col: str = "date", min_rows: int = LIVE_MIN_ROWS) -> str | None:
    """Why no model may be trained on these rows, or None."""
    return split_guard(time_split(labelled, date_col), label, min_rows).first()["reason"]


def training_guard(df: DataFrame, label: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row (ok, reason): at least ``min_rows`` labelled rows and at
    least two classes."""
    a = df.where(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"),
                                               F.count_distinct(label).alias("k"))
    reason = (F.when(F.col("n") < min_rows, F.concat(F.lit("only "), F.col("n").cast("string"),
                                                      F.lit(f" labelled rows (< {min_rows})")))
              .when(F.col("k") < 2, F.lit("fewer than 2 classes")))
    return a.select(reason.isNull().cast("int").alias("ok"), reason.alias("reason"), "n", "k")
