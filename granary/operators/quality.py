"""Quality gates and classifiers of generated and asked texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import NUMBER, strip

#: Representations that are dense in facts, old names of representations, phrases of useless output.
FACT_DENSE = ("quant_fact_ledger", "numeric_comparison_matrix", "causal_chemical_chain", "exam_bank_grounded", "technical_factsheet")
ALIASES = {
    "article": "encyclopedic_macro_synthesis",
    "technical_doc": "technical_factsheet",
    "causal_chain": "causal_chemical_chain",
    "factsheet": "quant_fact_ledger",
    "kvk_narrative": "kvk_advisory_sop",
}
USELESS = ("no usable", "no comparable", "no quantitative", "does not contain any", "no relevant data", "not applicable", "cannot generate", "insufficient data")
REFERENCE = r"reference|bibliograph|glossary|acknowledg"
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"


def density(text: Column, kind: Column) -> Column:
    """struct<passed, reason, alpha_ratio, digit_ratio, avg_word_len>: the first failed check, '' if none.

    A null text counts as empty. Fact-dense kinds may have more digits, fewer letters and shorter words.
    """
    dense = F.coalesce(kind.isin(*FACT_DENSE), F.lit(False))
    limit = lambda a, b: F.when(dense, F.lit(a)).otherwise(F.lit(b))
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, r"\s+"), lambda w: w != "")
    size = F.greatest(F.length(whole), F.lit(1))
    alpha, digit = F.regexp_count(whole, F.lit(r"\p{L}")) / size, F.regexp_count(whole, F.lit(DIGIT)) / size
    letters = F.aggregate(words, F.lit(0).cast("bigint"), lambda s, w: s + F.length(w))
    mean = F.when(F.size(words) > 0, letters / F.size(words)).otherwise(F.lit(0.0))
    reason = (
        F.when(F.size(words) == 0, "empty_text").when(alpha < limit(0.45, 0.70), "alpha_ratio").when(digit > limit(0.45, 0.20), "digit_ratio")
        .when((mean < limit(2.5, 3.0)) | (mean > 8.0), "avg_word_len").otherwise("")
    )
    return F.struct((reason == "").alias("passed"), reason.alias("reason"), alpha.alias("alpha_ratio"), digit.alias("digit_ratio"), mean.alias("avg_word_len"))


def is_unusable(output: Column) -> Column:
    """No data stated, under 300 characters, or under 800 with a phrase of uselessness."""
    bare = strip(F.coalesce(output, F.lit("")))
    token = F.regexp_replace(F.upper(bare), r"^[.! ]+|[.! ]+$", "") == "NO_USABLE_DATA"
    phrase = F.lower(bare).rlike("|".join(USELESS))
    return token | (F.length(bare) < 300) | ((F.length(bare) < 800) & phrase)


def is_reference(key: Column, title: Column) -> Column:
    """Chapters of references, glossaries and thanks, which only go through as they are."""
    return F.lower(F.concat_ws(" ", key, title)).rlike(REFERENCE)


def resolve_alias(kind: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(names, kind), kind)


def resolve_kinds(kinds: Column) -> Column:
    """An array of kinds under their present names, each once, in order."""
    return F.array_distinct(F.transform(kinds, resolve_alias))


def finished(spark: SparkSession, path: str) -> bool:
    """Whether an earlier run has written this table to its end."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def split_decisions(df: DataFrame, decision: Column, path: str) -> bool:
    """One pass: rows written below decision=KEEP and decision=DISCARD, neither if it has no rows; false, and nothing done, if they are there."""
    if finished(df.sparkSession, path):
        return False
    df.withColumn("decision", decision).write.mode("overwrite").partitionBy("decision").parquet(path)
    return True


def evaluated(chapters: DataFrame, title: str) -> DataFrame:
    """The chapters that an evaluation asks about: none with reference in its title."""
    return chapters.filter(~F.lower(F.coalesce(title, F.lit(""))).contains("reference"))


def has_numbers(text: Column) -> Column:
    return text.rlike(NUMBER)
