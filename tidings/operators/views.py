"""Filters, frequency tables and report views: P1-P17, A2, A3, A12-A16,
O1-O4, O9, O12, O13."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.columns import nonblank, norm_text, sentiment_sign

SECTOR_BAND = 0.05


def select_in(df: DataFrame, selections: dict[str, list]) -> DataFrame:
    """Conjunction of membership filters (pushed to the scan)."""
    cond = F.lit(True)
    for c, values in selections.items():
        cond = cond & F.col(c).isin(list(values))
    return df.where(cond)


def lookback(df: DataFrame, date_col: str, days: int) -> DataFrame:
    """P10: rows within ``days`` of the data's own latest date (one scalar)."""
    mx = df.agg(F.max(date_col).alias("m")).first()["m"]
    if mx is None:
        return df.limit(0)
    return df.where(F.col(date_col) >= F.date_sub(F.lit(mx), days))


def normalize_label(df: DataFrame, col: str, domain) -> DataFrame:
    """P6 + P7: trim and lower-case a label, keep rows in the domain."""
    return df.where(nonblank(F.col(col))).withColumn(col, norm_text(col)).where(F.col(col).isin(list(domain)))


def assert_domain(df: DataFrame, col: str, domain) -> DataFrame:
    """Fail the job on a value outside the domain (NULL passes)."""
    bad = ~F.col(col).isin(list(domain)) & F.col(col).isNotNull()
    return df.withColumn(col, F.when(bad, F.raise_error(F.concat(F.lit(f"unexpected {col}: "), F.col(col))))
                         .otherwise(F.col(col)))


def value_counts(df: DataFrame, col: str, order: list | None = None) -> DataFrame:
    """A2 / A3: frequency table, descending (ties by value) or in a fixed
    category order with absent categories dropped (``position``)."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if order is None:
        return c
    pos = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order)], f"{col} string, position int")
    return c.join(F.broadcast(pos), col)


def top_n(df: DataFrame, col: str, n: int) -> DataFrame:
    """O3: the ``n`` most frequent values (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), F.col(col).asc()).limit(n)


def latest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """O1 + O2 + O4: the ``n`` first rows in ``order`` (a total order)."""
    return df.orderBy(*order).limit(n)


def daily_counts(df: DataFrame, day_col: str, label: str, domain) -> DataFrame:
    """Per day one count column per label of the domain, zeros filled."""
    return df.groupBy(day_col).pivot(label, list(domain)).agg(F.count(F.lit(1))).fillna(0, subset=list(domain))


def sector_sentiment(df: DataFrame, sector: str = "sector", label: str = "sentiment_label",
                     band: float = SECTOR_BAND) -> DataFrame:
    """Mean sentiment sign per sector and its band (positive above
    +band, negative below -band, else neutral)."""
    m = df.groupBy(sector).agg(F.avg(sentiment_sign(F.col(label))).alias("mean_sign"),
                               F.count(F.lit(1)).alias("n"))
    return m.withColumn("band", F.when(F.col("mean_sign") > band, "positive")
                        .when(F.col("mean_sign") < -band, "negative").otherwise("neutral"))


def rename_by_map(df: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_name: str, out: str) -> DataFrame:
    """Look up a display name, falling back to the key."""
    d = dim.select(F.col(dim_key).alias(key), F.col(dim_name).alias("_nm")).dropDuplicates([key])
    return df.join(d, key, "left").withColumn(out, F.coalesce(F.col("_nm"), F.col(key))).drop("_nm")


def flatten_dim(nested: DataFrame, map_col: str, default_sector: str = "Index") -> DataFrame:
    """MAP<sector, MAP<ticker, name>> to (ticker, name, sector) rows."""
    s = nested.select(F.explode(map_col).alias("sector", "_m"))
    return s.select(F.explode("_m").alias("ticker", "name"), F.coalesce("sector", F.lit(default_sector))
                    .alias("sector"))


def annotate(df: DataFrame, events: DataFrame, on: str) -> DataFrame:
    """Attach fixed event markers (a small table) by date."""
    return df.join(events, on, "left")


def in_flight(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose outcome is not known yet."""
    return df.where(F.col(label).isNull())


def latest_in_flight(df: DataFrame, entity_col: str, entity: str, date_col: str = "date",
                     label: str = "label") -> DataFrame:
    """The last unresolved row of one entity (``max_by`` aggregate)."""
    rows = in_flight(df, label).where(F.col(entity_col) == entity)
    return rows.agg(F.max_by(F.struct(*df.columns), F.col(date_col)).alias("_r")).where(F.col("_r").isNotNull()) \
        .select("_r.*")


def latest_run(metrics: DataFrame, ts: str = "run_at") -> DataFrame:
    """The latest record of a run table."""
    return metrics.agg(F.max_by(F.struct(*metrics.columns), F.col(ts)).alias("_r")).select("_r.*")


def influential(df: DataFrame, keys: list[str], k: int = 5, label: str = "sentiment_label",
                conf: str = "sentiment_confidence", id_col: str = "article_id") -> DataFrame:
    """Per group the ``k`` headlines of highest strength =
    confidence x max(|sign|, 0.01) (ties by id), via the salted top-k."""
    from tidings.operators.similarity import top_k_per_group
    s = df.withColumn("strength", F.col(conf) * F.greatest(F.abs(sentiment_sign(F.col(label))), F.lit(0.01)))
    return top_k_per_group(s, keys, [F.col("strength").desc(), F.col(id_col).asc()], k,
                           salt_col=F.xxhash64(F.col(id_col)))


def json_field(c, schema: str) -> Column:
    """decode a JSON text column with an explicit schema."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)


def validate_labels(df: DataFrame, human: str, model: str) -> tuple[DataFrame, DataFrame]:
    """Agreement per human class and overall, and the disagreements."""
    ok = (F.col(human) == F.col(model)).cast("int")
    per = df.groupBy(F.col(human).alias("class")).agg(F.avg(ok).alias("agreement"), F.count(F.lit(1)).alias("n"))
    allr = df.agg(F.avg(ok).alias("agreement"), F.count(F.lit(1)).alias("n")).withColumn("class", F.lit("ALL"))
    return per.unionByName(allr), df.where(F.col(human) != F.col(model))
