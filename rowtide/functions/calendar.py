"""Calendar expressions on the panel's time column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_time(c: Column) -> Column:
    """Text dates and timestamps as a zone-free timestamp; unparsable text is NULL."""
    return F.try_to_timestamp(c).cast("timestamp_ntz")

