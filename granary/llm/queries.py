"""The queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.llm import copies, history, language, mapping, mixing, packing, pairs, scans, stuffing
from granary.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.find_copies(table(spark, d, "kcc_calls"))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    return copies.collapse_copies(table(spark, d, "kcc_calls"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return mapping.find_mapped(table(spark, d, "kcc_calls"), table(spark, d, "rule_extractions"), table(spark, d, "canonical_terms"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return history.find_repeats(table(spark, d, "kcc_calls"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.find_defects(table(spark, d, "qna_groups"), table(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.find_noise(table(spark, d, "page_blocks"))


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair_pages(table(spark, d, "page_blocks"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return language.find_languages(table(spark, d, "kcc_calls"), table(spark, d, "normalized_rows"), table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_plans"))


def p7_unused(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(p7_containers(spark, d), table(spark, d, "pack_plans"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(p8_mixture(spark, d), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.find_stuffed(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_records, p2_found, p3_found, p4_found, p5_found, p5_paragraphs, p6_found, p7_containers, p7_unused, p8_mixture, p8_shares, p9_found)
}
#: DuckDB SQL of those queries that SQL can express.
#: The labels of the forms in the test tables, longer ones first.
_LABELS = "previous crop|area acre|problem|product|village|remark|stage|crop|soil"
_RECORDS = rf"""
with a as (select call_id, lower(nfc_normalize(querytext)) as t from kcc_calls where querytext is not null),
b as (select call_id, regexp_replace(regexp_replace(t, '(\p{{Nd}})([./-])(\p{{Nd}})', '\1' || chr(57344) || '\2' || chr(57344) || '\3', 'g'), '(\p{{Nd}})([./-])(\p{{Nd}})', '\1' || chr(57344) || '\2' || chr(57344) || '\3', 'g') as t from a),
w as (select call_id, array_to_string(regexp_extract_all(t, '(?:[\p{{L}}\p{{M}}\p{{Nd}}]|' || chr(57344) || '[./-]' || chr(57344) || ')+'), ' ') as w from b),
f as (select call_id, w, string_split(regexp_replace(' ' || w || ' ', ' ({_LABELS})\b', chr(1) || '\1' || chr(2), 'g'), chr(1)) as fields from w where regexp_matches(w, '[\p{{L}}\p{{Nd}}]')),
g as (select *, list_transform(list_filter(fields, lambda x: trim(x) <> ''), lambda x: trim(x)) as kept, list_transform(fields[2:], lambda x: split_part(x, chr(2), 1)) as labels from f),
r as (select call_id, case when fields[1] = '' and len(labels) >= 2 and len(list_distinct(labels)) = len(labels) then array_to_string(list_sort(kept), chr(1)) else w end as record from g)
"""
ORACLES: dict[str, str] = {
    "p1_found": _RECORDS
    + "select first as keep_id, call_id from (select call_id, min(call_id) over (partition by record) as first from r) where first < call_id",
}
