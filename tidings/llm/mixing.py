"""Mixing sources to target weights by Sainte-Lague apportionment.

Only DataFrame functions. The steps:

1. Each document's size is its number of words. Sources in code point order
   (null last) weigh 1, 2, 3, repeating. A source's target is its share of
   all words, stopped at ``cap`` times its own size, the excess reshared by
   weight until no source is above (water filling, solved in closed form on
   the table of sources).
2. A source's documents are dealt by hash to shards of about
   ``rows_per_shard`` rows, so a hot source is many shards.
3. In each shard, blocks of ``block_words`` words are allotted to the sources
   by highest quotients weight / (2 * seats + 1), which gives an integer
   quota per source and shard. The seats that any divisor rounding would give
   are set first (it never gives too many), the rest go one by one by
   quotient; the candidates for those are linear in the number of sources.
4. Each (source, shard) cuts its documents, in seeded order, into blocks and
   takes blocks in that order, going round again when the quota is larger
   than the shard's words. At most one document per source and shard is
   taken in part.

Null text has size 0. Null sources are one source. Rows with a null or a
repeated id are separate documents. An empty table gives an empty result.
``mixed_documents`` carries all columns of the input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, rows, source_size) -> adds source_no, weight and target. One
    row per source, so the windows here are over the table of sources only."""
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_room = Window.partitionBy(F.lit(0)).orderBy("_room", "source_no")
    w = F.array(*[F.lit(x) for x in weights])
    t = (sizes.withColumn("source_no", F.row_number().over(by_name))
         .withColumn("weight", F.get(w, (F.col("source_no") - 1) % len(weights)))
         .withColumn("_room", cap * F.col("source_size") / F.col("weight"))
         .withColumn("_total", F.sum("source_size").over(everything)))
    before = F.coalesce(F.sum(cap * F.col("source_size")).over(by_room.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    rest = F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    t = (t.withColumn("_pos", F.row_number().over(by_room))
         .withColumn("_level", (F.col("_total") - before) / rest))
    fits = F.col("_level") * F.col("weight") <= cap * F.col("source_size")
    level = F.min(F.when(fits, F.struct("_pos", "_level"))).over(everything)["_level"]
    return t.withColumn("target", F.least((cap * F.col("source_size")).cast("double"), level * F.col("weight"))) \
        .select("source", "source_no", "rows", "source_size", "target")


def quotas(groups: DataFrame, block_words: int) -> DataFrame:
    """(shard, source_no, want) -> adds quota: blocks by highest quotients.
    ``want`` is the source's wanted words in the shard, in 1/16 words, an
    integer so that sums agree in any order."""
    shard = Window.partitionBy("shard")
    g = (groups.withColumn("_sum", F.sum("want").over(shard)).withColumn("_n", F.count(F.lit(1)).over(shard))
         .withColumn("_seats", F.floor(F.col("_sum") / (16 * block_words) + 0.5)))
    sure = F.greatest(F.lit(0.0), F.col("_seats") - F.col("_n") / 2)
    g = g.withColumn("_first", F.when(F.col("_sum") > 0, F.floor(F.col("want") * sure / F.col("_sum") + 0.5))
                     .otherwise(0))
    g = g.withColumn("_left", F.col("_seats") - F.sum("_first").over(shard))
    most = F.least(F.col("_left"),
                   F.floor(F.col("want") / F.col("_sum") * (F.col("_left") + F.col("_n"))) + 2)
    rank = Window.partitionBy("shard").orderBy(F.col("_quotient").desc(), "source_no", "_seat")
    more = (g.where((F.col("_left") > 0) & (F.col("want") > 0))
            .select("shard", "source_no", "want", "_first", "_left", F.explode(F.sequence(F.lit(0), most - 1)).alias("_seat"))
            .withColumn("_quotient", F.col("want") / (2 * (F.col("_first") + F.col("_seat")) + 1))
            .withColumn("_rank", F.row_number().over(rank)).where("_rank <= _left")
            .groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("_more")))
    return (g.join(more, ["shard", "source_no"], "left")
            .select("shard", "source_no", (F.col("_first") + F.coalesce("_more", F.lit(0))).alias("quota")))


def _taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           carry: tuple[str, ...] = (), weights: tuple[int, ...] = (1, 2, 3), cap: int = 3,
           block_words: int = 32, rows_per_shard: int = 2000, seed: str = "mix") -> DataFrame:
    """One row per document: id, size, source_size, target, taken, and the
    carried columns as _carry_0 and on."""
    held = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)]
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), *held)
    slim = slim.withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"),
                                                     F.col("size").cast("string"))))
    slim = written(slim, "mix-sizes")
    plan = written(targets(slim.groupBy("source").agg(F.count(F.lit(1)).alias("rows"),
                                                      F.sum("size").alias("source_size")), weights, cap), "mix-targets")
    shards = F.ceil(F.col("rows") / rows_per_shard)
    rows = (slim.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
            .drop("source", "_source")
            .withColumn("shard", F.conv(F.substring("_key", 1, 12), 16, 10).cast("long") % shards))
    groups = (rows.groupBy("shard", "source_no")
              .agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                   F.first("source_size").alias("source_size"))
              .withColumn("want", F.when(F.col("source_size") > 0,
                                         F.floor(16 * F.col("target") * F.col("words") / F.col("source_size") + 0.5))
                          .otherwise(0)))
    taken = (groups.join(quotas(groups, block_words), ["shard", "source_no"])
             .select("shard", "source_no", "words",
                     F.least(F.col("quota") * block_words, cap * F.col("words")).alias("_take")))
    rows = rows.join(written(taken, "mix-quotas"), ["shard", "source_no"])
    order = ["_key", "id"] + [f"_carry_{i}" for i in range(len(carry))]
    ahead = F.coalesce(F.sum("size").over(Window.partitionBy("shard", "source_no").orderBy(*order)
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_take") % F.col("words") - ahead))
    rounds = F.when(F.col("words") > 0, F.floor(F.col("_take") / F.col("words")) * F.col("size") + part).otherwise(0)
    return rows.select("id", "size", "source_size", "target", rounds.cast("long").alias("taken"),
                       *[f"_carry_{i}" for i in range(len(carry))])


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, size, source_size, target (its source's),
    taken (words the mix takes, repeats counted). Options as for ``_taken``."""
    return _taken(docs, id_col, **options).withColumnRenamed("id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix as documents, with the input's columns: each row once for each
    whole time it is taken, and once more if at least half of it is taken
    beyond that. A document without a word stays as it is."""
    carry = [c for c in docs.columns if c != id_col]
    m = _taken(docs, id_col, carry=tuple(carry), **options)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(1).cast("int")
    named = {id_col: "id"} | {c: f"_carry_{i}" for i, c in enumerate(carry)}
    return m.select("*", F.explode(F.array_repeat(F.lit(0), copies))).select(*[F.col(named[c]).alias(c) for c in docs.columns])
