"""Publishing of what has changed since the last time.

The pairs last sent are kept in versions. A publish joins them with the new ones and sends the pairs
that are new or differ, and the keys that are gone. The new version is written after all is sent, so a
publish that was cut off is done again; setting or deleting a key twice does no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wattloom.sinks import versions

PAIRS = "key string, value string"


class Store(Protocol):
    def set_many(self, pairs: Sequence[tuple[str, str]]) -> None: ...

    def delete_many(self, keys: Sequence[str]) -> None: ...

    def close(self) -> None: ...


def unique(pairs: DataFrame) -> DataFrame:
    """The pairs, whose evaluation fails if a key is there twice or NULL."""
    counted = pairs.groupBy("key").agg(F.count("*").alias("n"), F.min("value").alias("value"))
    shown = F.coalesce("key", F.lit("NULL"))
    refused = F.raise_error(F.concat(F.lit("a key must be there once: "), shown))
    return counted.select(
        "key", F.when((F.col("n") == 1) & F.col("key").isNotNull(), F.col("value")).otherwise(refused).alias("value")
    )


def changes(pairs: DataFrame, published: DataFrame) -> DataFrame:
    """Rows (key, value, change): ``set`` with the new value, or ``delete`` with none."""
    new, old = unique(pairs).alias("new"), published.alias("old")
    both = new.join(old, F.col("new.key") == F.col("old.key"), "full")
    gone = F.col("new.key").isNull()
    return both.where(gone | F.col("old.key").isNull() | ~F.col("new.value").eqNullSafe(F.col("old.value"))).select(
        F.coalesce("new.key", "old.key").alias("key"),
        F.col("new.value").alias("value"),
        F.when(gone, "delete").otherwise("set").alias("change"),
    )


def send(delta: DataFrame, open_store: Callable[[], Store], batch_size: int = 1000) -> None:
    """Send changes, one connection per partition with rows, one call per batch and kind."""

    def send_rows(rows: Iterator[Row]) -> None:
        store = None
        try:
            while batch := list(islice(rows, batch_size)):
                if store is None:
                    store = open_store()
                kept = [(r.key, r.value) for r in batch if r.change == "set"]
                gone = [r.key for r in batch if r.change == "delete"]
                if kept:
                    store.set_many(kept)
                if gone:
                    store.delete_many(gone)
        finally:
            if store is not None:
                store.close()

    delta.foreachPartition(send_rows)


def publish_changes(pairs: DataFrame, root: str, send_delta: Callable[[DataFrame], None]) -> None:
    """Hand the changes since the version under ``root`` to ``send_delta``, then write the new version."""
    published = versions.read_latest(pairs.sparkSession, root, PAIRS)
    send_delta(changes(pairs, published))
    versions.write_next(unique(pairs), root)
