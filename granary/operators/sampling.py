"""Questions for rule discovery: the first of each, and an evenly spaced sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import squeeze, strip
from granary.operators.dedup import keep_first
from granary.operators.ids import with_row_ids

#: Names under which a question column is looked for, in order.
QUESTION_COLUMNS = ("Question", "question", "Query", "query", "text", "Text", "Prompt", "prompt")


def question_column(df: DataFrame) -> str:
    """The first known name that the table has, else its first column."""
    return next((c for c in QUESTION_COLUMNS if c in df.columns), df.columns[0])


def extract_questions(df: DataFrame, column: str | None = None, *keep: str) -> DataFrame:
    """(question, *keep): questions of more than three characters, blanks squeezed."""
    text = F.col(column or question_column(df)).cast("string")
    return df.filter(text.isNotNull() & (F.length(strip(text)) > 3)).select(squeeze(text).alias("question"), *keep)


def first_questions(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Each question once, whatever its letter case, as it came first."""
    return keep_first(df, [F.lower("question")], order)


def stride_sample(df: DataFrame, order: list[str | Column], size: int) -> DataFrame:
    """`size` rows evenly spaced in the given order, from the first on; all rows if there are no more."""
    numbered = with_row_ids(df, order, "__at", start=0)
    total = numbered.count()
    step = max(1, total // max(1, min(size, total)))
    return numbered.filter((F.col("__at") % step == 0) & (F.col("__at") < step * size)).drop("__at")
