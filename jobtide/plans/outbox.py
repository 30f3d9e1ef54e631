"""Replay-safe publishing: messages and their seen keys are committed under one publish id.

    <outbox>/publish=K/day=D/   the messages of publish K with their dedup keys
    <outbox>/_committed         a row per committed publish
    <topic>/publish=K/          the delivered messages (a file topic)

A publish is one table, written in overwrite mode, and then one row that commits
it: keys are seen, and messages are due, from that row on and not before. A run
that dies before the row leaves nothing behind that counts; its folder is
overwritten by the next run. A run that dies after it is completed by the next
run, which first delivers what is due. A file topic gets the messages by renaming
a finished folder, so a reader meets all of them once or none. Ids are counted
up; one writer at a time. A message broker has no such rename: a run that dies
between sending and noting it sends again, so there delivery is at least once,
and the lake's upsert takes up the repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as O
from ..operators.lake import file_system

ROWS = "key string, value string, dedup_key string, publish int, day date"
COMMITTED = "publish int"


def last_publish(spark: SparkSession, outbox: str, table: str = "_committed") -> int:
    """The newest publish id that is committed (or, by `_sent`, sent); -1 without any."""
    newest = O.read_or_empty(spark, f"{outbox}/{table}", COMMITTED).agg(F.max("publish")).first()[0]
    return -1 if newest is None else newest


def _note(spark: SparkSession, outbox: str, table: str, publish: int) -> None:
    spark.createDataFrame([(publish,)], COMMITTED).coalesce(1).write.mode("append").parquet(f"{outbox}/{table}")


def committed(spark: SparkSession, outbox: str) -> DataFrame:
    """Messages and keys of all committed publishes."""
    last = last_publish(spark, outbox)
    return O.read_or_empty(spark, f"{outbox}/publish=*", ROWS, base=outbox).filter(F.col("publish") <= last)


def commit(spark: SparkSession, outbox: str, messages: DataFrame) -> int:
    """Commit `messages` (key, value, dedup_key, day) as the next publish; returns how many there are.

    Without messages no id is used.
    """
    publish = last_publish(spark, outbox) + 1
    counted, seen = O.with_row_count(messages.select("key", "value", "dedup_key", "day"), "published")
    counted.write.mode("overwrite").partitionBy("day").parquet(f"{outbox}/publish={publish}")
    rows = int(seen.get["rows"])
    if rows:
        _note(spark, outbox, "_committed", publish)
    return rows


def deliver(spark: SparkSession, outbox: str, topic: str) -> int:
    """Bring every committed publish that the file topic lacks into it; returns how many."""
    files, path = file_system(spark, outbox)
    due = [k for k in range(last_publish(spark, outbox) + 1) if not files.exists(path(f"{topic}/publish={k}"))]
    for publish in due:
        waiting = f"{topic}/_waiting-{publish}"
        (committed(spark, outbox).filter(F.col("publish") == publish).select("value")
         .write.mode("overwrite").text(waiting))
        if not files.rename(path(waiting), path(f"{topic}/publish={publish}")):
            raise OSError(f"could not rename {waiting}")
    return len(due)


def send(spark: SparkSession, outbox: str, publish_to: Callable[[DataFrame], object]) -> int:
    """Hand every committed publish that is not noted as sent to a broker; returns how many."""
    first, last = last_publish(spark, outbox, "_sent") + 1, last_publish(spark, outbox)
    for publish in range(first, last + 1):
        publish_to(committed(spark, outbox).filter(F.col("publish") == publish).select("key", "value"))
        _note(spark, outbox, "_sent", publish)
    return last + 1 - first
