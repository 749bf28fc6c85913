"""Structured Streaming forms of gap sessions and stratified histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import binned


def gap_sessions(stream: DataFrame, by: str, ts: str, gap: str, late: str) -> DataFrame:
    """(by, start, end, n): sessions that end after ``gap`` without a row; rows later than ``late`` are left out."""
    s = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), by).agg(F.count("*").alias("n"))
    return s.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def histogram(stream: DataFrame, by: str, x: str, width: float, bins: int) -> DataFrame:
    """(by, bin, n): mergeable counts, kept up to date."""
    return stream.groupBy(by, binned(x, width, bins).alias("bin")).agg(F.count("*").alias("n"))
