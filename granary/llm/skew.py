"""Joining rows to a table of their values when single values may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A value is hot from this share of all rows on; so there are fewer than this number of hot values.
HOT_SHARE = 1024


def attach(rows: DataFrame, key: str, found: DataFrame, count: str, total: int) -> DataFrame:
    """Inner join of `rows` with `found` (one row for each `key`, with the number of its rows in `count`).

    Hot values, fewer than HOT_SHARE of them by their definition, are joined by broadcast, the others by a shuffle in
    which no value has more than total / HOT_SHARE rows. `found` should be a written table, since it is read twice.
    """
    names = [c for c in found.columns if c not in (key, count)]
    held = F.struct(*names).alias("__held")
    hot_from = max(1, total // HOT_SHARE)
    hot = found.filter(F.col(count) > hot_from).select(key, held)
    cold = found.filter(F.col(count) <= hot_from).select(key, held)
    marked = rows.join(F.broadcast(hot), key, "left")
    out = [*rows.columns, *(F.col(f"__held.{c}").alias(c) for c in names)]
    in_hot = marked.filter("__held is not null").select(*out)
    in_cold = marked.filter("__held is null").drop("__held").join(cold, key)
    return in_hot.unionByName(in_cold.select(*out))
