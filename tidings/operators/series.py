"""Price-series analytics on long (name, date, value) tables: W1-W6,
A4-A11, P2-P5, J20.

Per-entity order-dependent work (returns, rolling windows) runs on the
row numbers of ``asof.sequence`` so no task holds a whole entity history:
returns come from the neighbour fold, rolling windows from fixed row blocks
that carry a halo of the previous ``n - 1`` rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.columns import pct
from tidings.operators.asof import sequence, with_neighbours

NOISE_THRESHOLD = 0.5   # percent, strict
ROLLING_WINDOW = 90     # rows
TRADING_DAYS = 252


def returns(df: DataFrame, by: str = "name", t: str = "date", value: str = "close", out: str = "ret",
            fill: str = "pad") -> DataFrame:
    """Percent change from one date of the shared calendar (all dates
    of ``df``) to the next, for every entity on every date.

    With ``fill="pad"`` a missing value counts as the last one before it, so
    a gap day's change is 0 and the next value is compared with the last
    observed one. With ``fill="none"`` a change needs values on both dates.
    Dates before an entity's first value have NULL, and so has its first.

    Calendar positions come from ``sequence`` over the distinct dates; each
    observation knows its own position and its neighbours', and gives the
    rows of the gap behind it (and before the first one), so nothing is
    joined all with all and no task holds an entity.
    """
    if fill not in ("pad", "none"):
        raise ValueError("fill must be 'pad' or 'none'")
    cal = sequence(df.select(t).distinct().withColumn("_g", F.lit(1)), "_g", t, "_pos").select(t, "_pos")
    last = cal.agg(F.max("_pos")).scalar()
    obs = df.select(by, t, value).where(F.col(value).isNotNull()).join(cal, t)
    seq = sequence(obs, by, t, "_rn")
    nb = with_neighbours(seq, by, "_rn", [value, "_pos"], {"_b": 1, "_a": -1})
    prev = F.col(f"_b_{value}")
    own = pct(F.col(value), prev)
    if fill == "none":
        own = F.when(F.col("_b__pos") == F.col("_pos") - 1, own)
    gap_value = F.col(value) if fill == "pad" else F.lit(None).cast("double")
    gap_ret = F.when(F.col(value) != 0, F.lit(0.0)) if fill == "pad" else F.lit(None).cast("double")

    def rows(first: Column, end: Column, v: Column, r: Column) -> Column:
        return F.when(first <= end, F.transform(F.sequence(first, end), lambda p: F.struct(
            p.alias("pos"), v.cast("double").alias("v"), r.cast("double").alias("r")))).otherwise(F.array())

    here = F.array(F.struct(F.col("_pos").alias("pos"), F.col(value).cast("double").alias("v"), own.cast("double").alias("r")))
    behind = rows(F.col("_pos") + 1, F.col("_end"), gap_value, gap_ret)
    ahead = F.when(F.col("_b__pos").isNull(), rows(F.lit(1).cast("long"), F.col("_pos") - 1, F.lit(None), F.lit(None))) \
        .otherwise(F.array())
    return (nb.withColumn("_end", F.coalesce(F.col("_a__pos") - 1, last))
            .select(by, F.explode(F.concat(ahead, here, behind)).alias("_x"))
            .select(by, F.col("_x.pos").alias("_pos"), F.col("_x.v").alias(value), F.col("_x.r").alias(out))
            .join(cal, "_pos").select(by, t, value, out))


def rolling(df: DataFrame, by: str, t: str, value: str, n: int = ROLLING_WINDOW,
            block: int = 4096, full_only: bool = True) -> DataFrame:
    """Sample standard deviation over the last ``n`` rows of each entity,
    NULL until ``n`` observations exist (``full_only``).

    Rows are cut into blocks of ``block`` row numbers; each block also gets
    the ``n - 1`` rows before it (a halo), so the window runs inside one
    (entity, block) partition of at most ``block + n - 1`` rows.
    """
    if block < n:
        block = n
    clean = df.select(by, t, value).where(F.col(value).isNotNull())
    seq = sequence(clean, by, t, "_rn")
    blk = F.floor((F.col("_rn") - 1) / F.lit(block)).cast("long")
    in_halo = ((F.col("_rn") - 1) % F.lit(block)) >= F.lit(block - (n - 1))
    copies = F.when(in_halo, F.array(F.struct(blk.alias("b"), F.lit(False).alias("halo")),
                                     F.struct((blk + 1).alias("b"), F.lit(True).alias("halo"))))\
        .otherwise(F.array(F.struct(blk.alias("b"), F.lit(False).alias("halo"))))
    x = seq.select(by, t, value, "_rn", F.explode(copies).alias("_c")) \
        .select(by, t, value, "_rn", F.col("_c.b").alias("_b"), F.col("_c.halo").alias("_halo"))
    w = Window.partitionBy(by, "_b").orderBy("_rn").rowsBetween(-(n - 1), 0)
    std = F.stddev_samp(value).over(w)
    cnt = F.count(value).over(w)
    res = F.when(cnt >= n, std) if full_only else std
    return x.withColumn("rolling_std", res).where(~F.col("_halo")).select(by, t, value, "rolling_std")


def normalize_base(df: DataFrame, by: str = "name", t: str = "date", value: str = "close",
                   base: float = 100.0, out: str = "indexed") -> DataFrame:
    """Value / first non-null value * base, per entity."""
    first = df.where(F.col(value).isNotNull()).groupBy(by) \
        .agg(F.min_by(value, t).alias("_first"))
    return df.join(first, by, "left") \
        .withColumn(out, F.when(F.col("_first") != 0, F.col(value) / F.col("_first") * base)) \
        .drop("_first")


def final_performance(df: DataFrame, by: str = "name", t: str = "date", value: str = "close") -> DataFrame:
    """Last indexed value - 100 per entity, rounded to 1 place."""
    agg = df.where(F.col(value).isNotNull()).groupBy(by).agg(
        F.min_by(value, t).alias("_first"), F.max_by(value, t).alias("_last"))
    return agg.select(by, F.round(F.when(F.col("_first") != 0, F.col("_last") / F.col("_first") * 100 - 100), 1)
                      .alias("performance_pct"))


def latest_change(df: DataFrame, by: str = "name", t: str = "date", value: str = "close") -> DataFrame:
    """Last value, previous value and their percent change per entity."""
    clean = df.where(F.col(value).isNotNull())
    last = clean.groupBy(by).agg(F.max(t).alias("_last_t"), F.max_by(value, t).alias("last_value"))
    prev = clean.join(last.select(by, "_last_t"), by) \
        .where(F.col(t) < F.col("_last_t")).groupBy(by).agg(F.max_by(value, t).alias("prev_value"))
    return last.join(prev, by, "left").select(
        by, F.col("_last_t").alias("last_date"), "last_value", "prev_value",
        pct(F.col("last_value"), F.col("prev_value")).alias("change_pct"))


def describe(df: DataFrame, by: str, value: str, places: int = 3) -> DataFrame:
    """A4: mean, sample std, min, max, rounded."""
    return df.groupBy(by).agg(
        F.round(F.avg(value), places).alias("mean"), F.round(F.stddev_samp(value), places).alias("std"),
        F.round(F.min(value), places).alias("min"), F.round(F.max(value), places).alias("max"),
        F.count(value).alias("n"))


def noise_share(df: DataFrame, by: str, value: str, threshold: float = NOISE_THRESHOLD) -> DataFrame:
    """A5/P5: share of rows with |value| > threshold, in percent (1 place)."""
    return df.where(F.col(value).isNotNull()).groupBy(by).agg(
        F.count_if(F.abs(value) > threshold).alias("n_noisy"), F.count(F.lit(1)).alias("n_days"),
        F.round(F.count_if(F.abs(value) > threshold) / F.count(F.lit(1)) * 100, 1).alias("noise_pct"))


def sector_volatility(rets: DataFrame, dim: DataFrame, by: str = "name", value: str = "ret",
                      sector: str = "sector") -> DataFrame:
    """Mean over a sector's members of each member's return std."""
    per = rets.groupBy(by).agg(F.stddev_samp(value).alias("_std"))
    return per.join(dim.select(by, sector).dropDuplicates([by]), by) \
        .groupBy(sector).agg(F.avg("_std").alias("avg_volatility"), F.count(F.lit(1)).alias("n_members"))


def sector_returns(rets: DataFrame, dim: DataFrame, by: str = "name", t: str = "date",
                   value: str = "ret", sector: str = "sector") -> DataFrame:
    """Per (sector, date) mean of the members' returns, NULLs skipped."""
    return rets.join(dim.select(by, sector).dropDuplicates([by]), by) \
        .groupBy(sector, t).agg(F.avg(value).alias("sector_ret"))


def corr_with(series: DataFrame, ref: DataFrame, key: str, t: str, value: str, ref_value: str) -> DataFrame:
    """Pearson correlation of each ``key`` series with one reference
    series, over dates where both exist."""
    r = ref.select(t, F.col(ref_value).alias("_ref"))
    return series.join(r, t).groupBy(key).agg(F.corr(value, "_ref").alias("corr"),
                                               F.count(F.lit(1)).alias("n_dates"))


def corr_matrix(df: DataFrame, by: str = "name", t: str = "date", value: str = "ret",
                block: int = 128, dates_per_part: int = 1024) -> DataFrame:
    """A9 (+ A10 lower triangle): pairwise-complete Pearson correlation of
    every pair of series, as long rows (name_a <= name_b).

    Series are numbered and cut into blocks; every pair of blocks and part
    of the dates is one bounded group, whose sums per pair (n, sums, sums of
    squares and of products over dates where both exist) are numpy matrix
    products. One aggregation by pair adds the parts up. The number of
    series is not limited, and no pair rows exist per date.
    """
    names = sequence(df.select(by).distinct().withColumn("_g", F.lit(1)).withColumn("_h", F.xxhash64(by)),
                     "_g", "_h", "_i", 1 << 52, [by]).select(by, (F.col("_i") - 1).alias("_i"))
    size = df.agg(F.count_distinct(by).alias("k"), F.count_distinct(t).alias("d")).first()
    blocks, parts = -(-max(1, size["k"]) // block), -(-max(1, size["d"]) // dates_per_part)
    own = F.floor(F.col("_i") / block).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)),
                       lambda o: F.struct(F.least(own, o).alias("a"), F.greatest(own, o).alias("b")))
    x = (df.select(by, t, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).join(names, by)
         .select("_i", F.xxhash64(t).alias("_t"), "_v", F.pmod(F.xxhash64(t), F.lit(parts)).alias("_part"),
                 F.explode(pair).alias("_p")).select("_i", "_t", "_v", "_part", "_p.a", "_p.b"))

    def sums(g: pd.DataFrame) -> pd.DataFrame:
        a, b = int(g["a"].iloc[0]), int(g["b"].iloc[0])
        day, days = pd.factorize(g["_t"])
        i = g["_i"].to_numpy()
        dense = np.full((2, len(days), block), np.nan)
        for side, at in enumerate((a, b)):
            here = i // block == at
            dense[side, day[here], i[here] % block] = g["_v"].to_numpy()[here]
        m, v = (~np.isnan(dense)).astype(float), np.nan_to_num(dense)
        out = {"n": m[0].T @ m[1], "sa": v[0].T @ m[1], "sb": m[0].T @ v[1], "saa": (v[0] ** 2).T @ m[1],
               "sbb": m[0].T @ v[1] ** 2, "sab": v[0].T @ v[1]}
        ia, ib = np.nonzero(m[0].any(0)[:, None] & m[1].any(0)[None, :] & ((a < b) | (np.arange(block)[:, None] <= np.arange(block))))
        return pd.DataFrame({"i": ia + a * block, "j": ib + b * block} | {k: z[ia, ib] for k, z in out.items()})

    total = (x.groupBy("a", "b", "_part").applyInPandas(sums, "i long, j long, n double, sa double, sb double, saa double, "
                                                              "sbb double, sab double")
             .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]))
    num = F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")
    den = F.sqrt((F.col("n") * F.col("saa") - F.col("sa") ** 2) * (F.col("n") * F.col("sbb") - F.col("sb") ** 2))
    named = (total.join(names.select(F.col("_i").alias("i"), F.col(by).alias("_a")), "i")
             .join(names.select(F.col("_i").alias("j"), F.col(by).alias("_b")), "j"))
    return named.select(F.least("_a", "_b").alias("name_a"), F.greatest("_a", "_b").alias("name_b"),
                        F.when((F.col("n") >= 2) & (den > 0), num / den).alias("corr"), F.col("n").cast("long").alias("n_dates"))


def histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last
    bin. Two scalars (min, max) are read first."""
    lohi = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = lohi["lo"], lohi["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.width_bucket(F.col(value), F.lit(lo), F.lit(hi if hi > lo else lo + 1.0), F.lit(bins)),
                F.lit(bins)).cast("int")
    return (df.where(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"), "n"))


def coverage(df: DataFrame, by: str, t: str, value: str) -> DataFrame:
    """A14 + P4: first/last date, rows and years (rows / 252) per series;
    ``loaded`` is 0 for series without any value."""
    return df.groupBy(by).agg(
        F.min(F.when(F.col(value).isNotNull(), F.col(t))).alias("first_date"),
        F.max(F.when(F.col(value).isNotNull(), F.col(t))).alias("last_date"),
        F.count(value).alias("n_rows"),
        F.round(F.count(value) / TRADING_DAYS, 2).alias("years"),
        (F.count(value) > 0).cast("int").alias("loaded"))


def complete_dates(df: DataFrame, by: str, t: str, value: str, n_names: int | None = None) -> DataFrame:
    """P3 in long form: keep dates on which every series has a value."""
    if n_names is None:
        n_names = df.select(by).distinct().count()
    full = df.where(F.col(value).isNotNull()).groupBy(t).agg(F.countDistinct(by).alias("_k")) \
        .where(F.col("_k") == n_names).select(t)
    return df.join(full, t, "left_semi")


def overlay(existing: DataFrame, fresh: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Union of keys, fresh values override existing ones."""
    e = existing.select(*keys, F.col(value).alias("_old"))
    f = fresh.select(*keys, F.col(value).alias("_new"))
    return e.join(f, keys, "full").select(*keys, F.coalesce("_new", "_old").alias(value))
