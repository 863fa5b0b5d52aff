"""Importance resampling towards a target distribution. DataFrame functions only.

Every document is a bag of hashed features (runs of one and two words). A
bucket's gain is the log ratio of its smoothed share in the target texts and
in the corpus, and a document's weight is the mean gain of its features: the
table of gains is one array, which scores a document's array of buckets where
it lies. Seeded Gumbel noise turns the top k scores into a draw without
replacement in proportion to exp(weight).

The cutoff needs no sort of all scores. A mergeable quantile sketch proposes a
bracket around the k-th score; exact counts above and inside validate it, and
a bracket that misses the k-th score is widened. Only the rows inside are
sorted, by ranges, to find the cutoff. Drawn rows above the bracket are
numbered in the same way, because their ranks are asked for.

Null text has no words. A document without features weighs 0. Null ids hash as
an empty id and sort after all others; rows of one id and score are told apart
by their place in the written score table, so repeated rows count one by one
and ties never share a rank. Empty corpora and empty targets are allowed (all
gains follow from the smoothing). A very long text is one array of small whole
numbers. Only the named columns are read, so extra columns of any name do no
harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
#: Rank error of the sketch, as one part of the rows.
ACCURACY = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text, A-Z alone lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def feature_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all runs of one and two words, repeats included."""
    def bucket(feature: Column) -> Column:
        return F.pmod(F.crc32(feature), F.lit(buckets)).cast("int")

    def both(found: Column) -> Column:
        following = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
        leading = F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))
        pairs = F.zip_with(leading, following, lambda a, b: bucket(F.concat_ws(" ", a, b)))
        return F.struct(F.size(found).alias("n_words"),
                        F.concat(F.transform(found, bucket), pairs).alias("buckets"))
    return _let(words(text), both)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets) per document."""
    found = docs.select(F.col(id_col).alias("doc_id"), feature_buckets(F.col(text_col), buckets).alias("f"))
    return found.select("doc_id", "f.n_words", "f.buckets")


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n) over all features of the documents."""
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket; ``corpus`` and ``target`` are (bucket, n),
    a bucket without features counts 0."""
    spark = corpus.sparkSession
    total = lambda t: t.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).scalar()
    both = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
            .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left"))
    s, t = F.coalesce("s", F.lit(0)).cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    ratio = (t + 1) * (total(corpus) + float(buckets)) / ((s + 1) * (total(target) + float(buckets)))
    gain = F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long")
    return both.select("bucket", gain.alias("gain"))


def scores(rows: DataFrame, table: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of the documents of
    ``features``. The gains become one constant array in the plan: a whole
    number per bucket, whatever the corpus."""
    held = [r.gain for r in table.orderBy("bucket").collect()]
    g = F.split(F.lit(",".join(map(str, held))), ",").cast("array<long>")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(g, b))
    n = F.size("buckets").cast("long")
    rest = F.pmod("total", F.col("n_features"))
    weight = F.when(F.col("n_features") == 0, F.lit(0).cast("long")) \
        .otherwise(F.floor((F.col("total") - rest) / F.col("n_features")).cast("long"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")
    return (rows.select("doc_id", "n_words", n.alias("n_features"), total.alias("total"))
            .select("doc_id", "n_words", "n_features", weight.alias("weight"), (weight + noise).alias("score")))


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``place`` 1, 2, 3... from the highest score on.

    Rows are cut into ranges of the whole key, sorted there and written; the
    number of rows per range (one row a partition) gives each range's start.
    No task sees more than its range, however many scores tie."""
    order = _order()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged, name).withColumn("part", F.shiftright("at", 33))
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("ahead"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(ahead, "part").select(*rows.columns, (F.col("ahead") + inside + 1).alias("place"))


def bracket(scored: DataFrame, k: int, n: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above): scores low..high hold the k-th highest of ``n``, and
    ``above`` rows score more than high. The sketch proposes, exact counts
    decide; a bracket that misses is doubled until it holds the k-th score."""
    slack = 2.0 / accuracy
    while True:
        share = 1.0 - k / n
        asked = [min(1.0, max(0.0, share - slack)), min(1.0, max(0.0, share + slack))]
        low, high, least, most = scored.agg(
            F.percentile_approx("score", asked, F.lit(accuracy)).alias("q"), F.min("score").alias("least"),
            F.max("score").alias("most")).select(F.col("q")[0], F.col("q")[1], "least", "most").first()
        low, high = (least if asked[0] == 0.0 else low), (most if asked[1] == 1.0 else high)
        above, inside = scored.agg(F.count_if(F.col("score") > high),
                                   F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            return low, high, above
        slack *= 2


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
         accuracy: int = ACCURACY) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): the floor(percent * N / 100)
    highest scores of the N documents of ``min_words`` words and more are
    ranked, ties to the smaller id; all other documents have no rank."""
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    able = scored.where(F.col("n_words") >= min_words)
    n = able.count()
    k = percent * n // 100
    out = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*out, unranked)
    low, high, above = bracket(able, k, n, accuracy)
    inside = numbered(able.where(F.col("score").between(low, high)), "resample-bracket")
    cut = F.col("place") <= k - above
    top = numbered(able.where(F.col("score") > high), "resample-above")
    short = scored.where((F.col("n_words") < min_words) | (F.col("score") < low))
    return (top.select(*out, F.col("place").cast("long").alias("rank"))
            .unionByName(inside.select(*out, F.when(cut, F.col("place") + above).cast("long").alias("rank")))
            .unionByName(short.select(*out, unranked)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
             buckets: int = BUCKETS, accuracy: int = ACCURACY) -> DataFrame:
    """Every document with its weight, score and, if drawn, rank."""
    rows = written(features(docs, id_col, text_col, buckets), "resample-features")
    aim = features(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), buckets=buckets)
    table = written(gains(bucket_counts(rows), bucket_counts(aim), buckets), "resample-gains")
    return draw(scores(rows, table, seed), percent, min_words, accuracy)
