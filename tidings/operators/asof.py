"""As-of joins and per-entity sequence features.

Spark has no public as-of join, and the textbook replacement (a window
``partitionBy(entity).orderBy(time)``) sends the whole history of one
entity to one task, so a hot entity becomes one huge task. Here every step
is keyed by (entity, time bucket) or by (entity, row number), keys whose
rows are bounded by the bucket width, so no single task grows with one
entity's share of the data:

1. ``sequence``: row number per entity = rows in earlier buckets (a prefix
   sum over the small per-bucket count table) + position inside the bucket.
2. ``with_neighbours``: values of the rows k steps before/after, by one
   aggregation keyed by (entity, row number) over copies of each row
   shifted by k (lag/lead without a per-entity window).
3. ``asof_join``: every reference row is valid on an interval of time up to
   its neighbour; the interval is replicated into the buckets it spans and
   probes find it by an equi-join on (entity, bucket) plus a range filter.
   Exactly one interval matches a probe, so the join is 1:1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.columns import label_from_return, pct

DEFAULT_BUCKET_DAYS = 32
DEFAULT_BUCKET_SECONDS = 32 * 86400


def _ord_expr(c: Column, dtype: T.DataType) -> Column:
    """Integer time ordinal: days for DATE, seconds for TIMESTAMP, the
    value itself for integral columns."""
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp"))
    return c.cast("long")


def _default_width(dtype: T.DataType) -> int:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return DEFAULT_BUCKET_SECONDS
    return DEFAULT_BUCKET_DAYS


def _ordinal(df: DataFrame, t: str) -> tuple[Column, int]:
    """Ordinal of column ``t`` of ``df`` and the default bucket width."""
    dtype = df.schema[t].dataType
    return _ord_expr(F.col(t), dtype), _default_width(dtype)


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def sequence(df: DataFrame, by, t: str, rn: str = "rn", bucket_width: int | None = None,
             ties: Sequence[str] = ()) -> DataFrame:
    """Add ``rn``: the 1-based position of each row within its ``by`` group
    ordered by ``t``, then ``ties`` (together unique within a group, e.g. one
    close per day).

    Only the (group, bucket) count table is windowed per group; it holds
    one row per non-empty bucket, so its size is span / width per group.
    """
    by = _keys(by)
    ordv, width = _ordinal(df, t)
    width = bucket_width or width
    b = df.withColumn("_bkt", F.floor(ordv / F.lit(width)).cast("long"))
    local = b.withColumn("_local", F.row_number().over(Window.partitionBy(*by, "_bkt").orderBy(t, *ties)))
    # counts come from the windowed rows, so both sides share one shuffle
    counts = local.groupBy(*by, "_bkt").agg(F.max("_local").alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_bkt")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("_n")
    return (local.join(offsets, by + ["_bkt"], "inner")
            .withColumn(rn, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_bkt", "_local", "_off"))


def with_neighbours(seq: DataFrame, by, rn: str, values: Sequence[str], shifts: dict[str, int]) -> DataFrame:
    """For each row add ``{prefix}_{value}`` = value of the row ``k`` steps
    earlier (k > 0, a lag) or later (k < 0, a lead) in the same group, for
    every ``prefix: k`` in ``shifts``. Missing neighbours give NULL.

    Each row is emitted once per shift with its row number moved by k and
    all copies are folded by one aggregation on (group, row number).
    """
    by = _keys(by)
    values = list(values)
    roles = [("_self", 0)] + list(shifts.items())
    copies = F.array(*[
        F.struct(F.lit(name).alias("role"), (F.col(rn) + F.lit(k)).alias("key"))
        for name, k in roles
    ])
    exploded = seq.select(*by, *values, F.explode(copies).alias("_c")) \
        .select(*by, F.col("_c.role").alias("_role"), F.col("_c.key").alias(rn), *values)
    aggs = []
    for name, _ in roles:
        for v in values:
            out = v if name == "_self" else f"{name}_{v}"
            aggs.append(F.max_by(F.col(v), F.when(F.col("_role") == name, F.lit(1))).alias(out))
    aggs.append(F.max(F.when(F.col("_role") == "_self", F.lit(1))).alias("_has_self"))
    return (exploded.groupBy(*by, rn).agg(*aggs)
            .where(F.col("_has_self") == 1).drop("_has_self"))


def _intervals(ref: DataFrame, by: list[str], t: str, values: list[str], direction: str,
               width: int) -> DataFrame:
    """Validity interval of every reference row: backward rows are valid
    from their own time to the next row's time, forward rows from the
    previous row's time to their own."""
    seq = sequence(ref.select(*by, t, *values), by, t, "_rn", width)
    shift = {"_nb": -1} if direction == "backward" else {"_nb": 1}
    nb = with_neighbours(seq, by, "_rn", [t], shift)
    seq = seq.join(nb.select(*by, "_rn", F.col(f"_nb_{t}").alias("_nb_t")), by + ["_rn"], "inner")
    return seq


def asof_join(left: DataFrame, right: DataFrame, by, left_on: str, right_on: str,
              values: Sequence[str], direction: str = "backward", allow_exact: bool = True,
              bucket_width: int | None = None, right_neighbour: str | None = None,
              time_source: DataFrame | None = None) -> DataFrame:
    """Attach to every ``left`` row the ``values`` of one ``right`` row of the
    same ``by`` group: for ``backward`` the last row at (``allow_exact``) or
    strictly before the left time, for ``forward`` the first row at or
    strictly after it. NULL when there is none. ``right_on`` must be unique
    within a group; ``left_on`` and ``right_on`` must have the same type.

    The as-of lookup runs on the distinct (group, time) keys of ``left``
    (map-side combined, so hot keys collapse early); the result is joined
    back on equality. That result grows with the data, so no broadcast is
    forced: AQE turns the join into a broadcast when the runtime size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed
    partitions otherwise.

    ``right_neighbour`` names a column of ``right`` that already holds the
    next (backward) or previous (forward) time of the group, which saves
    sequencing ``right`` again. ``time_source`` (a frame with a
    ``right_on`` column covering the same times, e.g. the raw rows ``right``
    was derived from) is used for the global time range instead of
    ``right``, so that range does not recompute ``right``.
    """
    by = _keys(by)
    values = [v for v in values if v not in by and v != right_on]
    direction = direction.lower()
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    nb_cols = [F.col(right_neighbour).alias("_nb_t")] if right_neighbour else []
    ref = right.select(*by, F.col(right_on).alias("_t"), *nb_cols, *values).where(F.col("_t").isNotNull())
    ordv, default_width = _ordinal(ref, "_t")
    width = bucket_width or default_width

    seq = ref if right_neighbour else _intervals(ref, by, "_t", values, direction, width)
    tdtype = ref.schema["_t"].dataType
    own_o = _ord_expr(F.col("_t"), tdtype)
    nb_o = _ord_expr(F.col("_nb_t"), tdtype)
    own_b = F.floor(own_o / F.lit(width)).cast("long")
    nb_b = F.floor(nb_o / F.lit(width)).cast("long")

    # Open-ended intervals (after the last / before the first row) reach to
    # a cap one bucket past the reference data; probes further out are
    # clamped to the cap, where only open intervals live. The caps are
    # scalar subqueries over the reference side (no driver round trip).
    span = ref if time_source is None else time_source.select(F.col(right_on).alias("_t"))
    caps = span.select(F.struct((F.floor(F.min(ordv) / F.lit(width)) - 1).cast("long").alias("lo"),
                               (F.floor(F.max(ordv) / F.lit(width)) + 1).cast("long").alias("hi"))).scalar()
    lo_cap, hi_cap = caps["lo"], caps["hi"]
    if direction == "backward":
        start_b, end_b = own_b, F.coalesce(nb_b, hi_cap)
    else:
        start_b, end_b = F.coalesce(nb_b, lo_cap), own_b
    iv = (seq.withColumn("_bkt", F.explode(F.sequence(start_b, end_b)))
          .select(*by, "_bkt", F.col("_t").alias("_own_t"), F.col("_nb_t"), *values))

    keys = left.select(*by, F.col(left_on).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    p_o = _ordinal(keys, "_p")[0]
    keys = keys.withColumn("_bkt", F.least(F.greatest(F.floor(p_o / F.lit(width)).cast("long"), lo_cap), hi_cap))
    cond = _interval_cond(F.col("_p"), F.col("_own_t"), F.col("_nb_t"), direction, allow_exact)
    matched = (keys.join(iv, by + ["_bkt"], "inner").where(cond)
               .select(*by, F.col("_p").alias(left_on), *values))
    return left.join(matched, by + [left_on], "left")


def _interval_cond(p: Column, own: Column, nb: Column, direction: str, allow_exact: bool) -> Column:
    """The probe time ``p`` lies in the interval of a row at ``own`` whose
    neighbour is at ``nb`` (NULL = open-ended)."""
    if direction == "backward":
        cond = (own <= p) if allow_exact else (own < p)
        return cond & (nb.isNull() | ((p < nb) if allow_exact else (p <= nb)))
    cond = (p <= own) if allow_exact else (p < own)
    return cond & (nb.isNull() | ((nb < p) if allow_exact else (nb <= p)))


def price_context(prices: DataFrame, by: str = "name", t: str = "date", close: str = "close",
                  bucket_width: int | None = None) -> DataFrame:
    """Per price row: its position ``rn`` in the entity's history, the
    previous close, the close three rows back and the next close (W7),
    over non-null closes only."""
    clean = prices.select(by, t, close).where(F.col(close).isNotNull())
    seq = sequence(clean, by, t, "rn", bucket_width)
    return with_neighbours(seq, by, "rn", [t, close], {"prev1": 1, "prev3": 3, "next1": -1}) \
        .select(by, t, close, "rn", F.col(f"prev1_{close}").alias("prev1_close"),
                F.col(f"prev3_{close}").alias("prev3_close"), F.col(f"next1_{close}").alias("next_close"),
                F.col(f"next1_{t}").alias("next_t"))


def session_returns(probes: DataFrame, prices: DataFrame, by: str = "name", t: str = "date",
                    close: str = "close", flat: float = 0.3, bucket_width: int | None = None) -> DataFrame:
    """J8 + J9 + F14 for every probe (``by``, ``t``) row:

    - ``close``: last close at or before ``t`` (baseline),
    - ``next_close``: first close strictly after ``t``,
    - ``next_session_return`` = (next / baseline - 1) * 100, NULL if a side
      is missing or the baseline is 0, and its UP/DOWN/FLAT ``label``,
    - ``prior_1d_return`` / ``prior_3d_return``: returns ending at the
      baseline row over 1 / 3 earlier rows, NULL with fewer than 4 rows at
      or before ``t``.
    """
    ctx = price_context(prices, by, t, close, bucket_width)
    ctx = ctx.withColumnRenamed(t, "_price_t")
    raw = prices.where(F.col(close).isNotNull()).select(F.col(t).alias("_price_t"))
    joined = asof_join(probes, ctx, by, t, "_price_t",
                       [close, "next_close", "prev1_close", "prev3_close", "rn"],
                       "backward", True, bucket_width, right_neighbour="next_t", time_source=raw)
    ret = pct(F.col("next_close"), F.col(close))
    return (joined
            .withColumn("next_session_return", ret)
            .withColumn("label", label_from_return(F.col("next_session_return"), flat))
            .withColumn("prior_1d_return", F.when(F.col("rn") >= 4, pct(F.col(close), F.col("prev1_close"))))
            .withColumn("prior_3d_return", F.when(F.col("rn") >= 4, pct(F.col(close), F.col("prev3_close"))))
            .drop("prev1_close", "prev3_close", "rn"))


def market_features(dates: DataFrame, prices: DataFrame, series: dict[str, str], date_col: str = "date",
                    by: str = "name", close: str = "close", default: float = 0.0) -> DataFrame:
    """J10 + P16: for every distinct date, the prior-1-step return of each
    configured series (``{series name: output column}``), 0 when the
    series is absent or too short. One row per date, to be joined on date.
    """
    names = list(series)
    wanted = prices.where(F.col(by).isin(names))
    d = dates.select(date_col).distinct()
    # One probe per (series, date): the series list is a fixed, bounded
    # configuration, so the fan-out is len(series) rows per date.
    probes = d.withColumn(by, F.explode(F.array(*[F.lit(n) for n in names])))
    r = session_returns(probes, wanted, by, date_col, close)
    piv = r.groupBy(date_col).agg(*[
        F.max_by(F.col("prior_1d_return"), F.when(F.col(by) == n, F.lit(1))).alias(out)
        for n, out in series.items()
    ])
    return d.join(piv, date_col, "left").fillna({out: default for out in series.values()}) \
        .select(date_col, *[F.coalesce(F.col(o), F.lit(default)).alias(o) for o in series.values()])
