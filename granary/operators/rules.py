"""Normalisation rules from model replies: checked, merged, and collected as a configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import strip

#: Marks of spoilt rules.
BAD_PREFIX = r"//|/\*|\{|\}|placeholder|single-word|1/10|let me refine"
BAD_REPLACEMENT = r"//|/\*|\{|\}|placeholder|single-word|mistake|refine"


@dataclass(frozen=True)
class RuleConfig:
    """What the normaliser is told; small by nature, since rules are read by people."""

    prefixes: tuple[str, ...] = ()
    canonical_replacements: dict[str, str] = field(default_factory=dict)
    minimum_length: int = 3
    maximum_length: int = 1000
    cleaning_version: str = "1.0"


def valid_prefix(prefix: Column) -> Column:
    bare = F.lower(strip(prefix))
    return F.length(bare).between(2, 80) & ~bare.rlike(BAD_PREFIX)


def valid_replacement(key: Column, value: Column) -> Column:
    k, v = F.lower(strip(key)), F.lower(strip(value))
    sound = (k != "") & (v != "") & (k != v) & (F.length(k) <= 100) & (F.length(v) <= 100)
    return sound & ~k.rlike(BAD_REPLACEMENT) & ~v.rlike(BAD_REPLACEMENT)


def merged_prefixes(extractions: DataFrame) -> DataFrame:
    """(prefix): the different sound prefixes in lower case."""
    each = extractions.select(F.explode("prefixes").alias("prefix")).filter(valid_prefix(F.col("prefix")))
    return each.select(F.lower(strip(F.col("prefix"))).alias("prefix")).distinct()


def merged_replacements(extractions: DataFrame, order: str = "response_id") -> DataFrame:
    """(key, value): the sound replacements in lower case; of one key the value of the last reply, then the greatest value."""
    each = extractions.select(order, F.explode("canonical_replacements").alias("key", "value")).filter(valid_replacement(F.col("key"), F.col("value")))
    bare = each.select(order, F.lower(strip(F.col("key"))).alias("key"), F.lower(strip(F.col("value"))).alias("value"))
    return bare.groupBy("key").agg(F.max(F.struct(order, "value"))["value"].alias("value"))


def rule_config(extractions: DataFrame) -> RuleConfig:
    """A configuration of all merged rules, which the driver holds: it grows with the different rules, not with the replies."""
    prefixes = [r["prefix"] for r in merged_prefixes(extractions).collect()]
    replacements = {r["key"]: r["value"] for r in merged_replacements(extractions).collect()}
    ordered = sorted(replacements.items(), key=lambda kv: (-len(kv[0]), kv[0]))
    return RuleConfig(tuple(sorted(prefixes, key=lambda p: (-len(p), p))), dict(ordered))
