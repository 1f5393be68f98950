"""Windows over tokens, and documents packed one after another."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.ids import with_row_ids
from granary.session import materialize


def blank_tokens(text: Column) -> Column:
    """The default tokenizer: non-blank runs of characters."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: t != "")


def window_bounds(count: Column, size: int = 2048, overlap: int = 256, least: int = 512) -> Column:
    """array<struct<start, length>>, start from 0: windows of `size` every size - overlap, up to the one that ends the text.

    A last window shorter than `least` reaches back to that length, or to the text's start.
    """
    stride = size - overlap
    n = F.when(count <= size, F.lit(1)).otherwise(F.ceil((count - size) / stride).cast("int") + 1)
    starts = F.when(count > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * stride)).otherwise(F.array().cast("array<int>"))

    def bound(start):
        end = F.least(start + size, count)
        short = (end == count) & (end - start < least)
        first = F.when(short, F.greatest(F.lit(0), end - least)).otherwise(start)
        return F.struct(first.cast("int").alias("start"), (end - first).cast("int").alias("length"))

    return F.transform(starts, bound)


def token_windows(df: DataFrame, tokens: str, **sizes) -> DataFrame:
    """`df` with a row (window_no, window) for each window of its token array."""
    bounds = df.withColumn("__bounds", window_bounds(F.size(tokens), **sizes))
    each = bounds.select(*df.columns, F.posexplode("__bounds").alias("window_no", "__bound"))
    return each.withColumn("window", F.slice(tokens, F.col("__bound.start") + 1, F.col("__bound.length"))).drop("__bound")


#: Documents of a shard that one task packs; longer shards are cut and put together by their stretches' effects.
STRETCH = 65_536


def _effects(room: int):
    """What a stretch of documents does to a block that is begun: for each fill from 0 to `room`, the fill behind it and the blocks begun."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fills, back = np.arange(room + 1), np.arange(room + 1)
        begun = np.zeros(room + 1, dtype=np.int64)
        total = begun.copy()
        for n, size in enumerate(np.minimum(rows.sort_values("ord")["length"].to_numpy() + 1, room)):
            over = (fills > 0) & (fills + size > room)
            begun = begun + over
            fills = np.where(over, size, fills + size)
            if n % 32 == 31:  # fills soon meet, and then go on as one
                total, pairs = total + begun[back], fills
                fills, where = np.unique(pairs, return_inverse=True)
                back, begun = where[back], np.zeros(len(fills), dtype=np.int64)
        total = total + begun[back]
        return pd.DataFrame({"shard": [key[0]], "stretch": [key[1]], "fills": [fills[back].tolist()], "begun": [total.tolist()]})

    return run


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    rows, used, block, out = rows.sort_values("stretch"), 0, 0, []
    for shard, stretch, fills, begun in zip(rows["shard"], rows["stretch"], rows["fills"], rows["begun"]):
        out.append((shard, stretch, used, block))
        used, block = int(fills[used]), block + int(begun[used])
    return pd.DataFrame(out, columns=["shard", "stretch", "used", "block"])


def pack_in_order(df: DataFrame, shard: str, order: str, length: str, capacity: int, stretch: int = STRETCH) -> DataFrame:
    """(shard, ord, length, block): documents put into blocks of capacity - 1 tokens in their order within a shard.

    A document of n tokens takes n + 1, its end mark included, cut to the block; empty ones take no place. Only (order, length)
    of a document travel. A shard is cut into stretches of documents: what each does to a begun block of any fill is found in
    parallel, these effects are put together shard by shard, and each stretch is then packed from the fill it starts with.
    """
    room = capacity - 1
    rows = df.select(F.col(shard).cast("string").alias("shard"), F.col(order).cast("long").alias("ord"), F.col(length).cast("long").alias("length"))
    placed = with_row_ids(rows.filter("length > 0 and shard is not null"), ["shard", "ord"], "at", start=0)
    cut = materialize(placed.withColumn("stretch", F.floor(F.col("at") / stretch)), "stretches")
    effects = cut.groupBy("shard", "stretch").applyInPandas(_effects(room), "shard string, stretch long, fills array<long>, begun array<long>")
    entries = effects.groupBy("shard").applyInPandas(_entries, "shard string, stretch long, used long, block long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, used = None, 0, 0
        for batch in batches:
            blocks, lengths = [], []
            for name, part, _, size, fill, first in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (name, part) != at:
                    at, block, used = (name, part), first, fill
                size = min(size + 1, room)
                if used and used + size > room:
                    block, used = block + 1, 0
                used += size
                blocks.append(block)
                lengths.append(size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lengths, pa.int64()), pa.array(blocks, pa.int64())], names=["shard", "ord", "length", "block"])

    begun = cut.join(entries, ["shard", "stretch"]).select("shard", "stretch", "ord", "length", "used", "block")
    ordered = begun.repartition("shard", "stretch").sortWithinPartitions("shard", "stretch", "ord")
    return ordered.mapInArrow(run, "shard string, ord long, length long, block long")


def training_steps(blocks: int, batch: int, accumulate: int, epochs: float, warmup: float, log_every: int, least: int = 16) -> dict[str, int]:
    """The schedule of a training run: a small corpus halves the batch, then the accumulation, until there are `least` steps."""
    steps = lambda: max(1, math.ceil(blocks / max(1, batch * accumulate))) * math.ceil(epochs)
    while steps() < least and batch * accumulate > 1:
        batch, accumulate = (batch // 2, accumulate) if batch > 1 else (batch, accumulate // 2)
    total = steps()
    return {
        "batch_size": batch, "accumulation": accumulate, "steps": total,
        "warmup_steps": min(max(5, int(warmup * total)), max(1, total // 10)), "logging_steps": min(log_every, max(1, total // 5)),
    }
