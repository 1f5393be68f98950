"""Problem 2: freely typed values mapped to the closest entry of a reference list.

A prefix-filter set-similarity join on character pairs finds the candidates, exact Jaccard verifies them and the most similar
is kept; an edit distance that knows common slips tells whether it is meant at all, and decides ties.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.canon import WORDS, fold
from granary.llm.skew import attach
from granary.llm.slips import slip_distance
from granary.session import materialize

#: Least Jaccard similarity of the character pairs of a candidate.
JACCARD = 0.2
#: A value is unmatched if its distance to the closest form is more than this share of the form's length.
REACH = 0.28
ANY_KIND = "*"
#: Words that decorate a term without changing which term is meant.
DECORATIONS = frozenset(
    "the a of hybrid desi local improved organic fresh irrigated rainfed crop crops problem problems plant plants field var variety type".split()
)
PARTS = regex.compile(r"[()\[\]{}/|,;:]|\s[-–—]\s|(?<=\p{Nd})[-–—](?=\p{L})")
CODE = regex.compile(r"(?:\p{L}{0,3}\p{Nd}+\p{L}{0,2})|x")


def squeeze(words: list[str]) -> str:
    return "".join(words)


def singular(word: str) -> str:
    if len(word) > 4 and word.endswith("oes"):
        return word[:-2]
    return word[:-1] if len(word) > 3 and word.endswith("s") else word


def forms_of(value: str) -> list[str]:
    """The strings that a typed value may stand for: all of it, its parts, and both without decoration."""
    folded = fold(value).replace("_", " ")
    out: list[str] = []

    def take(words: list[str]) -> None:
        bare = [w for w in words if not CODE.fullmatch(w)]
        plain = [w for w in bare if w not in DECORATIONS]
        for option in (words, bare, plain, plain and [*plain[:-1], singular(plain[-1])]):
            if option and (form := squeeze(option)) not in out:
                out.append(form)

    words = WORDS.findall(folded)
    take(words)
    parts = [found for part in PARTS.split(folded) if (found := WORDS.findall(part))]
    if len(parts) > 1:
        take([w for found in reversed(parts) for w in found])
    if len(words) > 1:
        take(words[::-1])
    if len(parts) > 1:
        for found in parts:
            take(found)
    return out


def pairs_of(form: str) -> list[str]:
    """The different pairs of neighbouring characters, the ends marked."""
    marked = f"^{form}$"
    return list(dict.fromkeys(marked[i : i + 2] for i in range(len(marked) - 1)))


def prefix_size(n: int, least: float = JACCARD) -> int:
    return n - math.ceil(least * n) + 1


_SIDE = "form string, tokens array<string>, n int"


def _ranked(forms: DataFrame, rank: dict[str, int]) -> DataFrame:
    """(form, tokens by global rarity, n) of each different form; tokens that the list doesn't have come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(0).to_pylist()
            tokens = [sorted(pairs_of(f), key=lambda t: (rank.get(t, -1), t)) for f in forms]
            yield pa.RecordBatch.from_arrays(
                [pa.array(forms, pa.string()), pa.array(tokens, pa.list_(pa.string())), pa.array([len(t) for t in tokens], pa.int32())],
                names=["form", "tokens", "n"],
            )

    return forms.select("form").mapInArrow(run, _SIDE)


def _prefixes(side: DataFrame, name: str) -> DataFrame:
    size = (F.col("n") - F.ceil(F.lit(JACCARD) * F.col("n")) + 1).cast("int")
    return side.select(
        F.col("form").alias(name), F.col("tokens").alias(f"{name}_tokens"), F.col("n").alias(f"{name}_n"),
        F.posexplode(F.slice("tokens", 1, size)).alias(f"{name}_at", "token"),
    )


def similar_forms(typed: DataFrame, listed: DataFrame, rank: dict[str, int], small: bool) -> DataFrame:
    """(typed, listed, jaccard): all pairs of forms with Jaccard similarity of at least JACCARD, each once.

    Only the rare prefixes are joined; pairs that can't reach the similarity by their sizes or by the places of the
    shared token are dropped before the exact check.
    """
    left, right = _prefixes(_ranked(typed, rank), "typed"), _prefixes(_ranked(listed, rank), "listed")
    need = F.ceil(F.lit(JACCARD / (1 + JACCARD)) * (F.col("typed_n") + F.col("listed_n")))
    room = 1 + F.least(F.col("typed_n") - F.col("typed_at"), F.col("listed_n") - F.col("listed_at")) - 1
    shared = F.size(F.array_intersect("typed_tokens", "listed_tokens"))
    return (
        left.join(F.broadcast(right) if small else right, "token")
        .filter((F.col("typed_n") >= JACCARD * F.col("listed_n")) & (F.col("listed_n") >= JACCARD * F.col("typed_n")))
        .filter(room + F.least("typed_at", "listed_at") >= need)
        .withColumn("jaccard", shared / (F.col("typed_n") + F.col("listed_n") - shared))
        .filter(F.col("jaccard") >= JACCARD)
        .groupBy("typed", "listed")
        .agg(F.max("jaccard").alias("jaccard"))
    )


def _variants(values: DataFrame) -> DataFrame:
    """(value, scope, form, step): step tells how far the form is from the value as typed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for value, scope in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for step, form in enumerate(forms_of(value)):
                    for column, x in zip(out, (value, scope, form, step)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int32())],
                names=["value", "scope", "form", "step"],
            )

    return values.select("value", "scope").mapInArrow(run, "value string, scope string, form string, step int")


def _distances(typed: pd.Series, listed: pd.Series) -> pd.Series:
    return pd.Series([slip_distance(a, b, REACH * len(b)) / max(1, len(b)) for a, b in zip(typed, listed)], dtype="float64")


def reference_forms(terms: DataFrame) -> DataFrame:
    """(term_id, kind, form, alias): each spelling of each entry; null aliases and empty spellings are left out."""
    spelled = terms.select(
        F.col("term_id").cast("bigint").alias("term_id"), "kind",
        F.explode(F.concat(F.array(F.struct(F.col("term").alias("s"), F.lit(0).alias("alias"))),
                           F.coalesce(F.transform("aliases", lambda x: F.struct(x.alias("s"), F.lit(1).alias("alias"))), F.array()))).alias("x"),
    ).filter("x.s is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [squeeze(WORDS.findall(fold(s).replace("_", " "))) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(forms, pa.string()), batch.column(3)], names=["term_id", "kind", "form", "alias"]
            )

    flat = spelled.select("term_id", "kind", "x.s", "x.alias")
    return flat.mapInArrow(run, "term_id bigint, kind string, form string, alias int").filter("form <> ''")


def map_values(values: DataFrame, terms: DataFrame, list_bound: int = 100_000) -> DataFrame:
    """(value, scope, term_id): the closest entry of the list for each different (value, scope), 0 if none is meant.

    `scope` is the only kind to look in, or ANY_KIND. The list is broadcast while it has no more than
    `list_bound` spellings and shuffled beyond. The greatest similarity is kept; ties go to the smaller
    distance, the less changed form, a term before an alias, then the smaller id.
    """
    listed = materialize(reference_forms(terms), "terms")
    small = listed.count() <= list_bound
    variants = materialize(_variants(values), "typed")
    # Global rarity of the tokens that the list has (their number is bounded by the list): over typed forms and list.
    tokens = lambda df: df.select(F.explode(F.expr("transform(sequence(0, length(form)), i -> substring(concat('^', form, '$'), i + 1, 2))")).alias("token"))
    have = tokens(listed.select("form").distinct()).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    typed_forms = variants.select("form").distinct()
    counted = tokens(typed_forms).join(F.broadcast(have.select("token")) if small else have.select("token"), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rows = have.unionByName(counted).groupBy("token").agg(F.sum("n").alias("n")).collect()
    rank = {row["token"]: i for i, row in enumerate(sorted(rows, key=lambda r: (r["n"], r["token"])))}
    near = similar_forms(typed_forms, listed.select("form").distinct(), rank, small).withColumn("distance", F.pandas_udf(_distances, "double")("typed", "listed"))
    near = near.filter(F.col("distance") <= REACH)
    entry = listed.withColumnRenamed("form", "listed")
    found = (
        variants.withColumnRenamed("form", "typed")
        .join(near, "typed")
        .join(F.broadcast(entry) if small else entry, "listed")
        .filter((F.col("scope") == ANY_KIND) | (F.col("scope") == F.col("kind")))
        .groupBy("value", "scope")
        .agg(F.min(F.struct((-F.col("jaccard")).alias("far"), "distance", "step", "alias", "term_id")).alias("best"))
        .select("value", "scope", F.col("best.term_id").alias("term_id"))
    )
    everything = values.select("value", "scope").distinct()
    return everything.join(found, ["value", "scope"], "left").select("value", "scope", F.coalesce("term_id", F.lit(0)).alias("term_id"))


def find_mapped(calls: DataFrame, rules: DataFrame, terms: DataFrame) -> DataFrame:
    """(origin STRING, record_id BIGINT, raw_value STRING, term_id BIGINT) for typed crops and replacement values.

    Crops that are null, blank or letter for letter a listed crop give no row, nor do map values that are null or
    letter for letter a listed term; a null or empty map gives none. A value of no more than blanks counts as
    unmatched in a map. Repeated rows of calls give repeated rows; of a response each different value gives one.
    """
    crop_terms = terms.filter("kind = 'crop'").select(F.col("term").alias("raw_value"))
    any_terms = terms.select(F.col("term").alias("raw_value"))
    crops = calls.select(F.lit("crop").alias("origin"), F.col("call_id").cast("bigint").alias("record_id"), F.col("crop").alias("raw_value")).filter(
        r"raw_value is not null and raw_value rlike '(?U)\\S'"
    )
    crops = crops.join(F.broadcast(crop_terms.distinct()), "raw_value", "left_anti")
    replaced = rules.select(
        F.lit("rule").alias("origin"), F.col("response_id").cast("bigint").alias("record_id"), F.explode(F.map_values("canonical_replacements")).alias("raw_value")
    ).filter("raw_value is not null")
    replaced = replaced.join(F.broadcast(any_terms.distinct()), "raw_value", "left_anti").distinct()
    scoped = lambda df, scope: df.groupBy("raw_value").agg(F.count(F.lit(1)).alias("n")).select(F.col("raw_value").alias("value"), F.lit(scope).alias("scope"), "n")
    values = materialize(scoped(crops, "crop").unionByName(scoped(replaced, ANY_KIND)), "values")
    mapped = map_values(values, terms)
    found = materialize(values.join(mapped, ["value", "scope"]).withColumnRenamed("value", "raw_value"), "mapped")
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = ["origin", "record_id", "raw_value", "term_id"]
    of_crop = attach(crops, "raw_value", found.filter("scope = 'crop'").drop("scope"), "n", total)
    of_rule = attach(replaced, "raw_value", found.filter(F.col("scope") == ANY_KIND).drop("scope"), "n", total)
    return of_crop.select(*out).unionByName(of_rule.select(*out))
