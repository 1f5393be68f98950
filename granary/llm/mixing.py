"""Problem 8: sources mixed to target shares by Poisson replication.

Each document is taken as often as a Poisson distribution with the source's mean rate says at a point that its hash
gives, never more often than allowed; the rate is raised so that the mean with that cap is the one needed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.tokens import document_tokens, one_spelling
from granary.session import materialize

#: The largest share of a source's capped tokens that a mix may ask for; 1 would need an infinite rate.
FULL = 0.9
#: Seeds tried for each mix; the one whose shares come closest is kept.
SEEDS = 32


def poisson_steps(rate: float, most: int) -> list[float]:
    """P(X <= 0), ..., P(X <= most - 1) of a Poisson variable."""
    term = total = math.exp(-rate)
    steps = [total]
    for k in range(1, most):
        term *= rate / k
        total += term
        steps.append(total)
    return steps


def capped_mean(rate: float, most: int) -> float:
    return sum(1.0 - p for p in poisson_steps(rate, most))


def rate_for(mean: float, most: int) -> float:
    """The rate at which a Poisson variable capped at `most` has this mean (below `most`)."""
    low, high = 0.0, 1.0
    while capped_mean(high, most) < mean and high < 700:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        if capped_mean(middle, most) < mean:
            low = middle
        else:
            high = middle
    return high


def replication_plan(targets: list[tuple[int, str, float, int]], available: dict[str, int], total: int | None = None) -> list[tuple[int, str, float, float, list[float]]]:
    """[(mix_id, source, target share, needed mean, Poisson steps)] of the sources that have tokens.

    Shares are renewed over those. The total is the largest at which no source needs more than FULL of what it may
    give, or less if `total` says so.
    """
    out = []
    for mix in sorted({t[0] for t in targets}):
        rows = [(s, share, most) for m, s, share, most in targets if m == mix and available.get(s, 0) > 0 and share > 0 and most > 0]
        whole = sum(share for _, share, _ in rows)
        if not whole:
            continue
        size = min(FULL * most * available[s] / (share / whole) for s, share, most in rows)
        size = min(size, total) if total else size
        for s, share, most in rows:
            mean = size * share / whole / available[s]
            out.append((mix, s, share, mean, poisson_steps(rate_for(mean, most), most)))
    return out


def _point(seed, *columns):
    """A number from 0 to 1 by the hash of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)) * F.lit(2.0**-53)


def mix_sources(documents: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(mix_id BIGINT, doc_id BIGINT, repeat_no INT, source STRING, tokens BIGINT, shuffle_key BIGINT), in random order.

    Documents without id, source or tokens, and sources that no mix lists, are not chosen; sources match whatever their
    spelling; listed sources without documents leave their share to the others; targets with null or no positive share
    or repeats are left out; a target that comes twice counts once with the larger share.
    """
    spark = documents.sparkSession
    tokens = materialize(document_tokens(documents).filter("tokens > 0 and source is not null"), "tokens")
    available = {r["source"]: r["tokens"] for r in tokens.groupBy("source").agg(F.sum("tokens").alias("tokens")).join(
        F.broadcast(targets.select(one_spelling(F.col("source")).alias("source")).distinct()), "source", "left_semi").collect()}
    wanted = targets.select("mix_id", one_spelling(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), "max_repeats").dropna()
    rows = [tuple(r) for r in wanted.groupBy("mix_id", "source").agg(F.max("share"), F.min("max_repeats")).collect()]
    plan = replication_plan(rows, available, total)
    schema = "mix_id bigint, source string, share double, mean double, steps array<double>"
    rates = F.broadcast(spark.createDataFrame(plan, schema))
    chosen = tokens.join(rates, "source")
    times = lambda seed: F.size(F.filter("steps", lambda p: _point(seed, "mix_id", "doc_id") >= p))
    sums = chosen.groupBy("mix_id", "source").agg(*[F.sum(F.col("tokens") * times(s)).alias(f"s{s}") for s in range(SEEDS)]).collect()
    seeds = []
    for mix in sorted({p[0] for p in plan}):
        whole = sum(p[2] for p in plan if p[0] == mix)
        share = {p[1]: p[2] / whole for p in plan if p[0] == mix}
        got = {r["source"]: r for r in sums if r["mix_id"] == mix}
        off = lambda s: sum(abs(r[f"s{s}"] / max(1, sum(x[f"s{s}"] for x in got.values())) - share[k]) for k, r in got.items())  # noqa: B023, E731
        seeds.append((mix, min(range(SEEDS), key=off)))
    picked = chosen.join(F.broadcast(spark.createDataFrame(seeds, "mix_id bigint, seed int")), "mix_id")
    point = F.shiftrightunsigned(F.xxhash64("seed", "mix_id", "doc_id"), 11) * F.lit(2.0**-53)
    # The seed must be hashed as in the trial above.
    counted = picked.withColumn("n", F.size(F.filter("steps", lambda p: point >= p))).filter("n > 0")
    repeated = counted.select("mix_id", "doc_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("repeat_no"), "source", "tokens", "seed")
    keyed = repeated.withColumn("shuffle_key", F.xxhash64(F.lit("order"), "seed", "mix_id", "doc_id", "repeat_no")).drop("seed")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(parts, "mix_id", "shuffle_key").sortWithinPartitions("mix_id", "shuffle_key")


def mix_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, actual_share, tokens, documents, most_repeats) of each listed source."""
    got = mixed.groupBy("mix_id", "source").agg(
        F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.max("repeat_no").alias("most_repeats")
    )
    whole = got.groupBy("mix_id").agg(F.sum("tokens").alias("all"))
    listed = targets.select(F.col("mix_id").cast("bigint").alias("mix_id"), one_spelling(F.col("source")).alias("source"), "target_share")
    both = listed.join(got, ["mix_id", "source"], "left").join(F.broadcast(whole), "mix_id", "left")
    share = F.coalesce(F.col("tokens"), F.lit(0)) / F.greatest(F.col("all"), F.lit(1))
    return both.select(
        "mix_id", "source", "target_share", share.alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
