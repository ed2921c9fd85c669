"""Counts in tumbling or sliding time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_window(
    rows: DataFrame,
    ts: str,
    key: str,
    size: str,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Rows per window and key as ``start``, ``end``, key, ``n``.

    Windows start at multiples of ``slide`` and exclude their end.  Counting is
    partial in each task before the shuffle.  ``watermark`` bounds a stream's
    state by dropping rows that come later than that; without it all windows are
    kept for ever.  A watermark needs a ``timestamp`` column.
    """
    if watermark is not None:
        rows = rows.withWatermark(ts, watermark)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = rows.groupBy(window.alias("window"), key).agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n"
    )


def sorted_windows(counted: DataFrame, key: str) -> DataFrame:
    """O1: order by window, then key.  On a stream this needs complete mode."""
    return counted.sort("start", "end", key)
