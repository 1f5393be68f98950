"""Grades of an evaluation rolled up, and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.ids import with_row_ids

#: What each measure weighs in the index.
WEIGHTS = {"accuracy": 0.30, "retention": 0.20, "dialogue_accuracy": 0.20, "dialogue_depth": 0.15, "book_accuracy": 0.15}


def chapter_means(grades: DataFrame, chapter: str, measures: list[str]) -> DataFrame:
    """The mean of each measure of a chapter, two decimals; missing grades count as 0."""
    mean = lambda c: F.round(F.sum(F.coalesce(F.col(c), F.lit(0.0))) / F.count(F.lit(1)), 2).alias(c)
    return grades.groupBy(chapter).agg(*[mean(c) for c in measures])


def efficacy_index(chapters: DataFrame) -> DataFrame:
    """One row: the means over chapters, two decimals, and their weighted sum; no chapters give 0."""
    means = [F.coalesce(F.round(F.avg(c), 2), F.lit(0.0)).alias(c) for c in WEIGHTS]
    whole = chapters.agg(F.count(F.lit(1)).alias("chapters"), *means)
    index = sum((F.col(c) * w for c, w in WEIGHTS.items()), F.lit(0.0))
    return whole.withColumn("efficacy_index", F.round(index, 2))


def transcripts(turns: DataFrame, key: str, turn: str, role: str, text: str, per_part: int = 1000) -> DataFrame:
    """(key, part, turns, history): the messages of a conversation in order, one a line, in parts of at most `per_part` turns.

    The places of turns come from a global order, so a conversation of any length is spread over many tasks; parts count from 0.
    """
    numbered = with_row_ids(turns.select(key, turn, role, text), [key, turn], "__at")
    starts = numbered.groupBy(key).agg(F.min("__at").alias("__first"))
    placed = numbered.join(starts, key).withColumn("part", F.floor((F.col("__at") - F.col("__first")) / per_part))
    grouped = placed.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct("__at", role, text))).alias("__t"))
    line = lambda t: F.concat(t[role], F.lit(": "), F.coalesce(t[text], F.lit("")))
    return grouped.select(key, "part", F.size("__t").alias("turns"), F.array_join(F.transform("__t", line), "\n").alias("history"))


def report_lines(chapters: DataFrame, chapter: str, measures: list[str], title: str) -> DataFrame:
    """(line_no, line): a Markdown report of chapter means in the chapters' order, headed by title and columns."""
    cells = lambda xs: F.concat(F.lit("| "), F.concat_ws(" | ", *xs), F.lit(" |"))
    head = [f"# {title}", "", "| " + " | ".join([chapter, *measures]) + " |", "|" + "---|" * (len(measures) + 1)]
    rows = with_row_ids(chapters, [chapter], "line_no", start=len(head) + 1).select("line_no", cells([F.col(chapter), *[F.format_string("%.2f", F.col(m).cast("double")) for m in measures]]).alias("line"))
    top = chapters.sparkSession.createDataFrame(list(enumerate(head, 1)), "line_no long, line string")
    return top.unionByName(rows.withColumn("line_no", F.col("line_no").cast("long")))
