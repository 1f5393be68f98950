"""Problem 7: items of varying length in containers of fixed capacity.

The configuration linear program over the length histogram is solved by multiplicative weights with knapsack pricing; its
rounded configurations are filled with exact lengths, and every document finds its container by its rank within its
length. The driver only sees the histogram, which the capacity bounds.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.tokens import document_tokens, one_spelling
from granary.session import materialize

#: Length classes of the linear program, rounds of multiplicative weights and their rate.
CLASSES = 64
ROUNDS = 300
RATE = 0.25
#: Steps of the knapsack; lengths are rounded up to them there only.
GRID = 1024
#: Blocks by which ranks within one length are counted, so that a frequent length isn't one task.
BLOCKS = 256


def best_configuration(sizes: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each class a container of greatest price holds: a bounded knapsack by dynamic programming."""
    value = np.zeros(capacity + 1)
    took: list[tuple[int, int, np.ndarray]] = []
    for k in range(len(sizes)):
        left, part = int(min(most[k], capacity // max(1, sizes[k]))), 1
        while left > 0:
            part = min(part, left)
            weight, gain = int(sizes[k]) * part, prices[k] * part
            if weight > capacity:
                break
            moved = value[: capacity + 1 - weight] + gain
            better = np.zeros(capacity + 1, bool)
            better[weight:] = moved > value[weight:] + 1e-12
            value[weight:] = np.maximum(value[weight:], moved)
            took.append((k, part, better))
            left -= part
            part *= 2
    counts, room = np.zeros(len(sizes), int), capacity
    for k, part, better in reversed(took):
        if better[room]:
            counts[k] += part
            room -= int(sizes[k]) * part
    return counts


def configuration_program(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Fractional multiplicities of configurations that cover each class about `counts` times.

    Classes that are covered less get greater weights; each round adds the configuration of greatest weight.
    """
    if not len(sizes):
        return []
    scale = max(1.0, capacity / GRID)
    grid = np.ceil(sizes / scale).astype(int)
    room = int(capacity / scale)
    containers = float((sizes * counts).sum()) / capacity
    step = containers / ROUNDS
    covered = np.zeros(len(sizes))
    found: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        ratio = covered / counts
        weights = np.exp(-(ratio - ratio.min()) / RATE) * (ratio < 1)
        if not weights.any():
            break
        prices = weights * sizes / capacity
        chosen = best_configuration(grid, prices, np.ceil(counts).astype(int), room)
        if not chosen.any():
            break
        key = tuple(int(x) for x in chosen)
        found[key] = found.get(key, 0.0) + step
        covered += chosen * step
    return [(np.array(k), x) for k, x in found.items()]


def fill_containers(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in a container, number of such containers)] for all items of the histogram {length: items}.

    Each entry uses up a length or a configuration, so there are no more entries than lengths and configurations.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    if left.get(capacity):
        out.append(((capacity,), left.pop(capacity)))
    order = sorted(left)
    if not order:
        return out
    total = sum(left.values())
    bounds, seen = [], 0
    for size in order:  # class borders at equal shares of the items
        seen += left[size]
        if seen * CLASSES >= total * (len(bounds) + 1) or size == order[-1]:
            bounds.append(size)
    members = {b: [s for s in order if (bounds[i - 1] if i else 0) < s <= b] for i, b in enumerate(bounds)}
    counts = np.array([sum(left[s] for s in members[b]) for b in bounds], float)
    program = configuration_program(np.array(bounds), counts, capacity)

    def drop(size: int) -> None:
        order.pop(bisect_right(order, size) - 1)

    def top_up(chosen: list[int], room: int, used: dict[int, int]) -> None:
        while room > 0:
            at = bisect_right(order, room) - 1
            while at >= 0 and left[order[at]] - used.get(order[at], 0) <= 0:
                at -= 1
            if at < 0:
                return
            size = order[at]
            chosen.append(size)
            used[size] = used.get(size, 0) + 1
            room -= size

    def take(chosen: list[int], used: dict[int, int], most: int) -> int:
        times = min(most, *(left[s] // n for s, n in used.items()))
        out.append((tuple(sorted(chosen, reverse=True)), times))
        for size, n in used.items():
            left[size] -= n * times
            if not left[size]:
                drop(size)
        return times

    for configuration, amount in sorted(program, key=lambda p: -float((p[0] * np.array(bounds)).sum())):
        times = int(amount)
        while times > 0:
            chosen, used, room = [], {}, capacity
            for k in np.nonzero(configuration)[0][::-1]:
                for _ in range(int(configuration[k])):
                    fits = [s for s in reversed(members[bounds[k]]) if left[s] - used.get(s, 0) > 0 and s <= room]
                    if fits:
                        chosen.append(fits[0])
                        used[fits[0]] = used.get(fits[0], 0) + 1
                        room -= fits[0]
            if not chosen:
                break
            top_up(chosen, room, used)
            times -= take(chosen, used, times)
    while order:
        first = order[-1]
        chosen, used = [first], {first: 1}
        top_up(chosen, capacity - first, used)
        take(chosen, used, left[first])
    return out


def plan_items(tokens: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, capacity, doc_id, piece, size): the documents of each plan; those over the capacity in pieces."""
    wanted = plans.select("plan_id", F.col("capacity_tokens").cast("bigint").alias("capacity"), one_spelling(F.col("only_source")).alias("only"))
    wanted = wanted.filter("plan_id is not null and capacity > 0")
    both = tokens.filter("tokens > 0").join(F.broadcast(wanted), F.col("only").isNull() | (F.col("only") == F.col("source")))  # a few plans
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / F.col("capacity")).cast("bigint")))
    return both.select("plan_id", "capacity", "doc_id", "tokens", pieces.alias("piece")).select(
        "plan_id", "capacity", "doc_id", "piece", F.least("capacity", F.col("tokens") - F.col("piece") * F.col("capacity")).alias("size")
    )


def pack_items(items: DataFrame) -> DataFrame:
    """(plan_id, container_no, position, doc_id, piece, size, unused): the place of each item.

    Containers are numbered from 1 within a plan, positions from 1 within a container; `unused` is the container's.
    """
    spark = items.sparkSession
    counts = items.groupBy("plan_id", "capacity", "size").agg(F.count(F.lit(1)).alias("n")).collect()  # capacity rows a plan at most
    histograms: dict[tuple[int, int], dict[int, int]] = {}
    for row in counts:
        histograms.setdefault((row["plan_id"], row["capacity"]), {})[row["size"]] = row["n"]
    # (first rank, container, position, unused) of the ranges of each length, by rising rank; bounded by lengths and configurations.
    slots: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for (plan, capacity), histogram in sorted(histograms.items()):
        container, placed = 1, dict.fromkeys(histogram, 1)
        for lengths, times in fill_containers(histogram, capacity):
            unused = capacity - sum(lengths)
            for position, size in enumerate(lengths, 1):
                slots.setdefault((plan, size), []).append((placed[size], container, position, unused))
                placed[size] += times
            container += times
    shared = spark.sparkContext.broadcast({k: np.array(v, dtype=np.int64).T for k, v in slots.items()})
    blocked = items.select(F.col("plan_id").cast("bigint").alias("plan_id"), "size", "doc_id", "piece", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BLOCKS)).alias("block"))
    blocks = blocked.groupBy("plan_id", "size", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("plan_id", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("plan_id", "size", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("plan_id", "size", "block").orderBy("doc_id", "piece")
    ranked = blocked.withColumn("in_block", F.row_number().over(within)).join(offsets, ["plan_id", "size", "block"])
    ranked = ranked.withColumn("rank", F.col("in_block") + F.col("offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            plan, size, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            out = np.zeros((3, len(rank)), dtype=np.int64)
            lengths, group = np.unique(np.stack([plan, size]), axis=1, return_inverse=True)
            order = np.argsort(group, kind="stable")
            for k, rows in enumerate(np.split(order, np.cumsum(np.bincount(group, minlength=lengths.shape[1]))[:-1])):
                first, container, position, unused = held[int(lengths[0, k]), int(lengths[1, k])]
                at = np.searchsorted(first, rank[rows], side="right") - 1
                out[:, rows] = container[at] + rank[rows] - first[at], position[at], unused[at]
            columns = [batch.column(0), pa.array(out[0]), pa.array(out[1].astype(np.int32)), batch.column(3), batch.column(4), batch.column(1), pa.array(out[2])]
            yield pa.RecordBatch.from_arrays(columns, names=["plan_id", "container_no", "position", "doc_id", "piece", "size", "unused"])

    placed_rows = ranked.select("plan_id", F.col("size").cast("bigint"), F.col("rank").cast("bigint"), "doc_id", "piece")
    return placed_rows.mapInArrow(place, "plan_id bigint, container_no bigint, position int, doc_id bigint, piece bigint, size bigint, unused bigint")


def pack_documents(documents: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id BIGINT, container_no BIGINT, position INT, doc_id BIGINT, piece BIGINT, size BIGINT, unused BIGINT).

    Every document of a plan's source (all if it is null) is whole in one container, or in pieces numbered from 0 if it
    has more tokens than the capacity. Documents without id or tokens are not packed; plans without a positive capacity
    give nothing; rows of one doc_id count as documents of their own; sources match whatever their spelling.
    """
    tokens = materialize(document_tokens(documents), "tokens")
    return pack_items(materialize(plan_items(tokens, plans), "items"))


def packing_report(packed: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, capacity, containers, items, tokens, unused, least_containers, unused_share) of each plan with items."""
    by_plan = packed.groupBy("plan_id").agg(F.max("container_no").alias("containers"), F.count(F.lit(1)).alias("items"), F.sum("size").alias("tokens"))
    capacity = plans.select(F.col("plan_id").cast("bigint").alias("plan_id"), F.col("capacity_tokens").cast("bigint").alias("capacity"))
    unused = F.col("containers") * F.col("capacity") - F.col("tokens")
    return by_plan.join(F.broadcast(capacity), "plan_id").select(
        "plan_id", "capacity", "containers", "items", "tokens", unused.alias("unused"),
        F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"), (unused / (F.col("containers") * F.col("capacity"))).alias("unused_share"),
    )
