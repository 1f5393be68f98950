"""The normaliser: a chain of text steps with change flags, validation and counters, as one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import clean_punctuation, nfkc, replace_terms, squeeze, strip_prefix
from granary.operators.rules import RuleConfig

#: Column of the input for each column of the output; absent ones become null.
INPUT = {"id": "id", "original_question": "question", "crop": "crop", "category": "category", "sector": "sector", "location": "location", "date": "asked_at"}


def chain(config: RuleConfig) -> list[tuple[str, Callable[[Column], Column]]]:
    """The steps in order; blanks are squeezed after each step that may leave some."""
    return [
        ("unicode", nfkc),
        ("lowercase", F.lower),
        ("whitespace", squeeze),
        ("punctuation", clean_punctuation),
        ("whitespace", squeeze),
        ("prefix", lambda c: strip_prefix(c, list(config.prefixes))),
        ("canonical", lambda c: replace_terms(c, config.canonical_replacements)),
        ("whitespace", squeeze),
    ]


def pick_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The mapped columns as strings under their new names, null where the input has none; names are compared stripped."""
    have = {c.strip(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[s]}`").cast("string") if s in have else F.lit(None).cast("string")).alias(t) for t, s in mapping.items()])


def apply_chain(df: DataFrame, source: str, target: str, steps: list[tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """`target` from `source`, null as '', and changed_<step> flags; a step's name that comes again overwrites its flag."""
    out = df.withColumn(target, F.coalesce(F.col(source), F.lit("")))
    for i, (name, step) in enumerate(steps):
        before, after = f"__step{i}", f"__step{i + 1}"
        out = out.withColumn(before, F.col(target)) if i == 0 else out
        out = out.withColumn(after, step(F.col(before)))
        out = out.withColumn(f"changed_{name}", F.col(after) != F.col(before))
    last = f"__step{len(steps)}"
    return out.withColumn(target, F.col(last)).drop(*[f"__step{i}" for i in range(len(steps) + 1)])


def validation_errors(question: Column, least: int, most: int) -> Column:
    """The names of the checks that a question fails, in fixed order."""
    checks = [
        ("empty_question", question == ""),
        ("only_punctuation", question.rlike(r"^[^\p{L}\p{M}\p{Nd}]+$")),
        ("only_numbers", question.rlike(r"^[0-9\s]+$")),
        ("too_short", F.length(question) < least),
        ("too_long", F.length(question) > most),
    ]
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in checks]))


def normalize(df: DataFrame, config: RuleConfig, stamp: str, mapping: dict[str, str] = INPUT) -> DataFrame:
    """The normalized rows with metadata, flags and validation; rows that fail are flagged and kept."""
    rows = apply_chain(pick_columns(df, mapping), "original_question", "normalized_question", chain(config))
    errors = validation_errors(F.col("normalized_question"), config.minimum_length, config.maximum_length)
    return rows.withColumns(
        {"language": F.lit("en"), "cleaning_version": F.lit(config.cleaning_version), "processing_timestamp": F.lit(stamp), "validation_errors": errors}
    ).withColumn("is_valid", F.size("validation_errors") == 0)


def counters(rows: DataFrame) -> DataFrame:
    """One row of running totals: processed, valid, invalid, empty, prefixes removed, terms replaced."""
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    return rows.agg(
        F.count(F.lit(1)).alias("rows_processed"), n(F.col("is_valid"), "rows_valid"), n(~F.col("is_valid"), "rows_invalid"),
        n(F.col("normalized_question") == "", "rows_empty"), n(F.col("changed_prefix"), "rows_prefix_removed"), n(F.col("changed_canonical"), "rows_canonical_replaced"),
    )
