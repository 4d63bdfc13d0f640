"""Results as (key, JSON) pairs, built and sent by the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import islice
from typing import Protocol

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wattloom.functions.naming import named


def to_key_value(
    df: DataFrame,
    prefix: str,
    keys: Sequence[Column],
    drop: Iterable[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``key`` joins the prefix and the key columns with colons; ``value`` is the row as JSON.

    ``drop`` leaves columns out of the JSON and ``extra`` adds some at its end. NULL is written
    as ``null`` in the JSON and as ``None`` in a key.
    """
    left_out = set(drop)
    fields = [named(c).alias(c) for c in df.columns if c not in left_out]
    fields += [column.alias(name) for name, column in (extra or {}).items()]
    parts = [F.coalesce(key.cast("string"), F.lit("None")) for key in keys]
    return df.select(
        F.concat_ws(":", F.lit(prefix), *parts).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


class Store(Protocol):
    def set_many(self, pairs: Sequence[tuple[str, str]]) -> None: ...

    def close(self) -> None: ...


def publish(pairs: DataFrame, open_store: Callable[[], Store], batch_size: int = 1000) -> None:
    """Send pairs to a key/value store, one connection per partition with rows, one call per batch.

    Setting a key twice leaves the same value, so a task that is run again does no harm.
    """

    def send(rows: Iterator[Row]) -> None:
        store = None
        try:
            while batch := list(islice(rows, batch_size)):
                if store is None:
                    store = open_store()
                store.set_many([(row.key, row.value) for row in batch])
        finally:
            if store is not None:
                store.close()

    pairs.foreachPartition(send)
