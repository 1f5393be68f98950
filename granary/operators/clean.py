"""Call records cleaned, kept if their answer is English, and each question once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.dates import call_date
from granary.functions.text import clean_text, is_english, nfc
from granary.operators.dedup import keep_first
from granary.operators.ids import with_row_ids

REQUIRED = ("blockname", "category", "createdon", "crop", "districtname", "kccans", "querytext", "querytype", "sector", "statename", "call_day", "call_month", "call_year")


TEXTS = ("querytext", "kccans", "crop", "category", "sector", "querytype", "blockname", "districtname", "statename")


def require(df: DataFrame, columns=REQUIRED) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def clean_calls(calls: DataFrame, file: str = "file_name", row: str = "row_no") -> DataFrame:
    """Every text column composed and cleaned; (file, row) and the columns of a cleaned record."""
    text = lambda c: clean_text(c, composed=True)
    composed = require(calls).withColumns({c: nfc(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in TEXTS})
    return composed.select(
        file, row, text(F.col("querytext")).alias("question"), text(F.col("kccans")).alias("answer"), text(F.col("crop")).alias("crop"),
        text(F.col("category")).alias("category"), text(F.col("sector")).alias("sector"), text(F.col("querytype")).alias("query_type"),
        call_date(F.col("createdon"), F.col("call_year"), F.col("call_month"), F.col("call_day")).alias("asked_at"),
        text(F.col("blockname")).alias("block"), text(F.col("districtname")).alias("district"), text(F.col("statename")).alias("state"),
    )


def clean_and_dedup(calls: DataFrame, file: str = "file_name", row: str = "row_no") -> DataFrame:
    """Cleaned records with an English answer, the first of each question in file and row order, numbered in that order.

    Of cleaning, only composition and lower case can change an answer's letters; so the language is judged behind these, and
    the rest is done for what stays.
    """
    english = clean_calls(require(calls).filter(is_english(F.lower(nfc(F.col("kccans").cast("string"))))), file, row)
    first = keep_first(english, [F.col("question")], [file, row])
    return with_row_ids(first, [file, row])
