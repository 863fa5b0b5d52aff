"""Line de-duplication by site-relative frequency. Only DataFrame functions.

A line's ratio on a host is the share of the host's pages that contain it.
Lines whose ratio exceeds ``ratio`` on a host with at least ``min_pages``
pages, and that ``min_count`` pages contain, are boilerplate there and are
dropped from that host's pages; the same line stays on other hosts.

At most (mean lines per page / ratio) lines per host can exceed the ratio,
so the flagged lines of a host are a short array in one row. That table is
written, so its size is known to the planner: small, it is broadcast; large,
the pages are joined by a shuffle with skewed hosts split at run time.
Counting combines on the map side and is keyed by (host, line), so a hot
host is spread over all tasks; only the key of a very common line meets in
one task, as one row per map task.

Blank lines are never counted or dropped. Lines are compared without outer
blanks. Null hosts form one host; null text stays null and counts as a
page without lines; repeated rows count as separate pages. Very long texts
are split within their row. An empty table gives an empty result. Other columns
stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.names import unused
from tidings.session import written

RATIO = 0.1
MIN_PAGES = 20
MIN_COUNT = 5


def _digest(line: Column) -> Column:
    """128 bits of a line: two differently seeded hashes."""
    return F.struct(F.xxhash64(F.lit(1), F.trim(line)).alias("a"), F.xxhash64(F.lit(2), F.trim(line)).alias("b"))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES, min_count: int = MIN_COUNT) -> DataFrame:
    """(host, flagged): digests of each host's boilerplate lines."""
    lines = F.filter(F.split(F.col(text_col), "\n", -1), lambda x: F.trim(x) != "")
    p = pages.select(F.col(host_col).alias("host"), F.array_distinct(F.transform(lines, _digest)).alias("digests"))
    seen = (p.select("host", F.explode("digests").alias("d")).groupBy("host", "d.a", "d.b")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(min_count, int(ratio * min_pages))))
    total = (pages.groupBy(F.col(host_col).alias("host2")).agg(F.count(F.lit(1)).alias("pages"))
             .where(F.col("pages") >= min_pages))
    return (seen.join(total, F.col("host").eqNullSafe(F.col("host2"))).where(F.col("n") / F.col("pages") > ratio)
            .groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("flagged")))


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, min_count: int = MIN_COUNT) -> DataFrame:
    """The input's columns with the text cleaned, then n_lines and n_dropped.
    Input columns of those two names are replaced."""
    flagged = written(boilerplate(pages, host_col, text_col, ratio, min_pages, min_count), "line-frequency")
    pages = pages.drop("n_lines", "n_dropped")
    host, marked, kept = unused(pages.columns + ["n_lines", "n_dropped"], "host", "flagged", "kept")
    flagged = flagged.select(F.col("host").alias(host), F.col("flagged").alias(marked))
    out = pages.join(flagged, F.col(host_col).eqNullSafe(F.col(host)), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(marked), _digest(x)))
    return (out.withColumn(kept, F.when(F.col(marked).isNotNull(), left).otherwise(lines))
            .select(*[F.array_join(kept, "\n").alias(c) if c == text_col else F.col(c) for c in pages.columns],
                    F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
                    F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).alias("n_dropped")))
