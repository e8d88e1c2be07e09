"""Static lookups shipped with the package."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from hourlake.schemas import EVENT_TYPES


def event_types(spark: SparkSession) -> DataFrame:
    """The packaged event-type lookup.

    The file sits next to the code, which executors need not have on a shared path, so its six
    lines become a local relation.
    """
    text = (Path(__file__).parent.parent / "seeds" / "event_types.csv").read_text("utf-8")
    lines = [ln for ln in text.splitlines() if ln and not ln.startswith("#")]
    rows = list(csv.reader(lines[1:]))
    return spark.createDataFrame([tuple(r) for r in rows], EVENT_TYPES)
