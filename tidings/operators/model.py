"""Models on Spark ML.

The reference trains boosted trees on one machine and a transformer head
on a GPU. Here: multi-class boosted trees as one-vs-rest GBTs with the
same hyper-parameters; a signal-weighted multinomial logistic model whose
per-feature contributions add up to the margin; and a TF-IDF text
classifier standing in for the pretrained scorer (not available offline).
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import (HashingTF, IDF, RegexTokenizer, StandardScaler, StopWordsRemover, StringIndexer,
                                VectorAssembler, ElementwiseProduct)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.columns import DIRECTIONS, direction_index
from tidings.operators.learning import DEFAULT_WEIGHT, SIGNAL_FEATURES
from tidings.session import literal_table, written

# The feature columns, in order.
FEATURE_COLS = ["n_headlines", "pct_positive", "pct_negative", "pct_neutral", "avg_confidence", "net_sentiment",
                "prior_1d_return", "prior_3d_return", "market_net_sentiment", "day_of_week",
                "nifty_market_prior_1d_return", "sp500_prior_1d_return", "crude_oil_prior_1d_return",
                "usdinr_prior_1d_return", "india_vix_prior_1d_return"]

# Boosted-tree hyper-parameters.
GBT_PARAMS = dict(maxIter=150, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)


def with_label_index(df: DataFrame, label: str = "label", out: str = "label_idx") -> DataFrame:
    """DOWN 0, FLAT 1, UP 2."""
    return df.withColumn(out, direction_index(F.col(label)))


def feature_stages(feature_cols=FEATURE_COLS, sector: str = "sector") -> list:
    """F22 + F23: sector index (unseen -> extra index) + feature vector."""
    idx = StringIndexer(inputCol="_sector_str", outputCol="sector_enc", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    asm = VectorAssembler(inputCols=list(feature_cols) + ["sector_enc"], outputCol="features", handleInvalid="keep")
    return [idx, asm]


def _prep(df: DataFrame, sector: str = "sector") -> DataFrame:
    return with_label_index(df).withColumn("_sector_str", F.coalesce(F.col(sector), F.lit("Unknown")))


def train_boosted(df: DataFrame, feature_cols=FEATURE_COLS, parallelism: int = 3) -> PipelineModel:
    """M8: one-vs-rest boosted trees (GBTClassifier is binary only)."""
    ovr = OneVsRest(classifier=GBTClassifier(**GBT_PARAMS), labelCol="label_idx", featuresCol="features",
                    parallelism=parallelism)
    return Pipeline(stages=feature_stages(feature_cols) + [ovr]).fit(_prep(df))


def feature_weights(weights: dict[str, float], feature_cols=FEATURE_COLS) -> list[float]:
    """per-column weight from the signal weights (sector fixed at 1)."""
    col_sig = {c: s for s, cols in SIGNAL_FEATURES.items() for c in cols}
    return [float(weights.get(col_sig.get(c), DEFAULT_WEIGHT)) for c in feature_cols] + [DEFAULT_WEIGHT]


def train_weighted(df: DataFrame, weights: dict[str, float] | None = None, feature_cols=FEATURE_COLS,
                   reg: float = 0.1) -> PipelineModel:
    """Standardise, scale each column by its signal weight, fit an
    L2-regularised multinomial logistic model (where scale changes the
    penalty, so a weight changes a feature's influence)."""
    w = feature_weights(weights or {}, feature_cols)
    stages = feature_stages(feature_cols) + [
        StandardScaler(inputCol="features", outputCol="_z", withMean=True, withStd=True),
        ElementwiseProduct(scalingVec=Vectors.dense(w), inputCol="_z", outputCol="_zw"),
        LogisticRegression(featuresCol="_zw", labelCol="label_idx", family="multinomial", regParam=reg,
                           elasticNetParam=0.0, standardization=False, maxIter=100),
    ]
    return Pipeline(stages=stages).fit(_prep(df))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted direction, and confidence = highest class probability when
    the model has probabilities (O12)."""
    out = model.transform(_prep(df))
    lab = F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), F.col("prediction").cast("int") + 1)
    out = out.withColumn("predicted_label", lab)
    if "probability" in out.columns:
        out = out.withColumn("confidence", F.array_max(vector_to_array(F.col("probability"))))
    return out


def contributions(model: PipelineModel, scored: DataFrame, feature_cols=FEATURE_COLS, top: int = 3) -> DataFrame:
    """M11 + A27 + O5: per row, each signal's contribution to the predicted
    class's margin (coefficient x weighted standardised value, summed over
    the signal's columns; the sector column counts as "sector"), and the
    ``top`` signals by absolute contribution."""
    lr = model.stages[-1]
    coef = lr.coefficientMatrix.toArray()
    names = list(feature_cols) + ["sector_enc"]
    col_sig = {c: s for s, cols in SIGNAL_FEATURES.items() for c in cols}
    z = vector_to_array(F.col("_zw"))
    pred = F.col("prediction").cast("int")
    per_feature = []
    for j, c in enumerate(names):
        cj = F.lit(0.0)
        for k in range(coef.shape[0]):
            cj = F.when(pred == k, F.lit(float(coef[k][j]))).otherwise(cj)
        per_feature.append((col_sig.get(c, "sector"), cj * z[j]))
    sigs: dict[str, object] = {}
    for s, e in per_feature:
        sigs[s] = e if s not in sigs else sigs[s] + e
    items = F.array(*[F.struct(F.lit(s).alias("signal"), e.alias("contribution")) for s, e in sigs.items()])
    ranked = F.array_sort(items, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                          .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                          .when(a["signal"] < b["signal"], -1).when(a["signal"] > b["signal"], 1).otherwise(0))
    return scored.withColumn("top_signals", F.slice(ranked, 1, top)).withColumn("signal_contributions", items)


def feature_importance(model: PipelineModel, feature_cols=FEATURE_COLS) -> list[tuple[str, float]]:
    """Mean importance over the one-vs-rest trees, largest first."""
    ovr = model.stages[-1]
    names = list(feature_cols) + ["sector_enc"]
    acc = [0.0] * len(names)
    for m in ovr.models:
        imp = m.featureImportances.toArray()
        for i, v in enumerate(imp):
            acc[i] += float(v) / len(ovr.models)
    return sorted(zip(names, acc), key=lambda t: (-t[1], t[0]))


def save_model(model: PipelineModel, path: str, metadata: dict[str, object] | None = None) -> None:
    """Persist the model, and its metadata as a one-row table of text
    values beside it."""
    model.write().overwrite().save(path)
    rows = literal_table(SparkSession.getActiveSession(), [(k, None if v is None else str(v)) for k, v in
                                                           sorted((metadata or {}).items())], "key string, value string")
    rows.agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metadata")) \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}-metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_metadata(path: str) -> dict[str, str]:
    return SparkSession.getActiveSession().read.parquet(f"{path}-metadata").first()["metadata"] or {}


# ---------------------------------------------------------------- text classifier (M1-M4)

def text_terms(text: str = "text", num_features: int = 1 << 18) -> Pipeline:
    """Tokens -> stop words out -> hashed term counts (``_tf``): nothing is
    learned, so one pass over the texts serves every fit on them."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"(?U)\w\w+", gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tok", outputCol="_tok2"),
        HashingTF(inputCol="_tok2", outputCol="_tf", numFeatures=num_features),
    ])


def text_regression(label_idx: str = "label_idx", weight: str | None = "weight", reg: float = 0.01,
                    max_iter: int = 25) -> LogisticRegression:
    """Multinomial logistic regression (class-weighted) on ``tfidf``."""
    lr = LogisticRegression(featuresCol="tfidf", labelCol=label_idx, family="multinomial", regParam=reg,
                            maxIter=max_iter)
    return lr.setWeightCol(weight) if weight else lr


def text_pipeline(text: str = "text", label_idx: str = "label_idx", weight: str | None = "weight",
                  num_features: int = 1 << 18, reg: float = 0.01, max_iter: int = 25) -> Pipeline:
    """M2: tokens -> stop words out -> hashed term counts -> idf ->
    multinomial logistic regression (class-weighted)."""
    return Pipeline(stages=[*text_terms(text, num_features).getStages(), IDF(inputCol="_tf", outputCol="tfidf"),
                            text_regression(label_idx, weight, reg, max_iter)])


def text_cv(folded: DataFrame, regs: tuple[float, ...], text: str = "text", label_idx: str = "label_idx",
            weight: str = "weight", parallelism: int = 2) -> list[tuple[float, int, float]]:
    """M3: (reg, fold, accuracy) of ``text_pipeline`` for every strength and
    ``fold``. Term counts are written once, a fold's idf serves all strengths,
    and ``parallelism`` fits run at a time."""
    counts = written(text_terms(text).fit(folded).transform(folded).select("fold", label_idx, weight, "_tf"), "term-counts")
    folds = sorted(r["fold"] for r in counts.select("fold").distinct().collect())

    def one(fold: int) -> list[tuple[float, int, float]]:
        train, test = counts.where(F.col("fold") != fold), counts.where(F.col("fold") == fold)
        idf = IDF(inputCol="_tf", outputCol="tfidf").fit(train)
        out = []
        for reg in regs:
            m = text_regression(label_idx, weight, reg).fit(idf.transform(train))
            acc = m.transform(idf.transform(test)).agg(
                F.avg((F.col("prediction") == F.col(label_idx)).cast("int"))).first()[0]
            out.append((reg, fold, float(acc)))
        return out

    with ThreadPool(parallelism) as pool:
        return sorted(x for rows in pool.map(inheritable_thread_target(folded.sparkSession)(one), folds) for x in rows)


def score_text(model: PipelineModel, df: DataFrame, classes: list[str]) -> DataFrame:
    """M1: label and score (highest probability, 4 places) per text."""
    out = model.transform(df)
    lab = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int") + 1)
    return out.withColumn("predicted", lab).withColumn(
        "score", F.round(F.array_max(vector_to_array(F.col("probability"))), 4))
