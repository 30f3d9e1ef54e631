"""Message value -> lake rows. The same function serves batch and stream.

Map-only: decode, parse with the fixed wire schema, flatten, derive the
lake columns and drop rows without a job id. Malformed JSON parses to an
all-null struct (permissive mode) and is removed by the key filter.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import functions as J
from ..schema import LAKE_COLUMNS, LAKE_KEY, WIRE_SCHEMA


def decode_value(col: Column | str = "value") -> Column:
    """Binary (or string) message value -> string."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def parse_json(col: Column | str = "value") -> Column:
    """JSON text -> wire struct; bad JSON -> all-null struct; extra fields ignored."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, WIRE_SCHEMA, {"mode": "PERMISSIVE"})


def to_lake_rows(records: DataFrame, strict_seconds: bool = False) -> DataFrame:
    """Flat wire records -> the lake columns, in schema order, as one projection."""
    derived = {
        "job_id": F.col("jobId"),
        "skill": J.skill_split("skill"),
        "scraped_at": J.timestamp_from_parts("createdAt", strict=strict_seconds),
        "expired_at": J.parse_wire_date("expiredAt"),
        "posted_at": J.parse_wire_date("postedAt"),
    }
    return records.select(*(derived.get(c, F.col(c)).alias(c) for c in LAKE_COLUMNS))


def parse_records(messages: DataFrame, value_col: str = "value",
                  strict_seconds: bool = False) -> DataFrame:
    """Messages with a `value` column -> lake rows with a non-null job id.

    The struct is flattened with `inline` of a one-element array: a Generate
    keeps the key filter above the parse, so the JSON is parsed once per
    message (a filter pushed below a plain projection re-evaluates the whole
    parse inside the predicate).
    """
    return all_records(messages, value_col, strict_seconds).filter(F.col("job_id").isNotNull())


def all_records(messages: DataFrame, value_col: str = "value", strict_seconds: bool = False) -> DataFrame:
    """One lake row per message; those that do not parse have a null job id."""
    parsed = messages.select(F.inline(F.array(parse_json(decode_value(value_col)))))
    return to_lake_rows(parsed, strict_seconds)


def complete_key() -> Column:
    """Whether the lake key (source, scraped_at, job_id) is there; an empty source is none,
    as a partition folder could not tell it from null."""
    present = [F.col(k).isNotNull() for k in LAKE_KEY] + [F.col("source") != ""]
    return F.coalesce(reduce(and_, present), F.lit(False))


def split_quarantine(lake_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose lake key is complete, and the rest."""
    return lake_rows.filter(complete_key()), lake_rows.filter(~complete_key())


def count_columns() -> list[Column]:
    """Counts over `all_records`: what came, was rejected, is quarantined and is written."""
    known = F.col("job_id").isNotNull()
    return [F.count(F.lit(1)).alias("received"), F.count_if(~known).alias("rejected"),
            F.count_if(known & ~complete_key()).alias("quarantined"),
            F.count_if(known & complete_key()).alias("written")]


def ingest_counts(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """One row of counts over messages."""
    return all_records(messages, value_col).agg(*count_columns())


def with_row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count observation (filled by the next action, no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
