"""First occurrences of rows, by window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order; null keys are equal.

    Only the smallest order of a key matters, so a filter on the row number becomes a per-partition limit before the
    shuffle (Spark's window group limit), and a hot key does not collect in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def first_pairs(df: DataFrame, file: str, question: str, answer: str, order: str) -> DataFrame:
    """The first row of each question and answer in a file, then without null questions or answers."""
    kept = keep_first(df, [F.col(file), F.col(question), F.col(answer)], [order])
    return kept.dropna(subset=[question, answer])


def dedup_summary(df: DataFrame, file: str, question: str, answer: str) -> DataFrame:
    """(file, initial, final, removed, removed_permille) of each file, and of all with a null file.

    Counted by different pairs, so no row is compared with another one.
    """
    pairs = df.groupBy(file, question, answer).agg(F.count(F.lit(1)).alias("n"))
    whole = F.col(question).isNotNull() & F.col(answer).isNotNull()
    by_file = pairs.groupBy(file).agg(F.sum("n").alias("n"), F.sum(whole.cast("long")).alias("k"))
    totals = by_file.groupBy(F.col(file).alias("file")).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    overall = by_file.agg(F.lit(None).cast("string").alias("file"), F.sum("n").alias("n"), F.sum("k").alias("k"))
    both = totals.unionByName(overall)
    return both.select(
        "file", F.col("n").alias("initial"), F.col("k").alias("final"), (F.col("n") - F.col("k")).alias("removed"),
        F.floor((F.col("n") - F.col("k")) * 1000 / F.col("n")).cast("long").alias("removed_permille"),
    )
