"""Wire records -> keyed message envelope (key = category, value = JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import WIRE_SCHEMA


def publish_envelope(records: DataFrame, *keep: str) -> DataFrame:
    """DF[wire record] -> DF[key, value], and the columns `keep`.

    The value keeps every wire field, nulls included (`"company":null`), with
    `createdAt` in its int-array form. Map-only.
    """
    fields = [F.col(f.name) for f in WIRE_SCHEMA.fields]
    return records.select(
        F.col("category").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )
