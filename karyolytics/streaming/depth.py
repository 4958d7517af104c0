"""Depth windows and sessions over event time: streaming forms of the depth statistics and of gaps and islands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def depth_windows(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width), "contig").agg(F.count("*").alias("n"), F.avg("depth").alias("mean"), F.max("depth").alias("high"))


def sessions(events: DataFrame, time: str = "ts", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), "contig").agg(F.count("*").alias("n"))
