"""Queries on call records: cleaning, deduplication, normalisation, rules and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import dates, hashing, text
from granary.models.clients import NOISE, filter_noise
from granary.operators import clean, dedup, generate, normalize, quality, rules, sampling
from granary.operators.ids import with_row_ids
from granary.plans.registry import query, sql_clean, sql_english, sql_sentence_case, sql_squeeze, sql_strip
from granary.session import table
from granary.sources.files import batch_name

#: DuckDB SQL of a call's date.
_STYLES = [
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "%Y-%m-%dT%H:%M:%S"), (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "%Y-%m-%d %H:%M:%S"),
    (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d"), (r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y"), (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$", "%d/%m/%Y %H:%M"),
    (r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}$", "%d-%m-%Y %H:%M"), (r"^\d{2}-\d{2}-\d{4}$", "%d-%m-%Y"),
]
_STATED = ", ".join(f"case when regexp_matches(trim(createdon), '{p}') then try_strptime(trim(createdon), '{s}') end" for p, s in _STYLES)
_PART = lambda c: f"case when regexp_matches(trim({c}), '^[0-9]{{1,4}}$') then cast(trim({c}) as int) end"
_PARTS = f"try_strptime(printf('%04d-%02d-%02d', {_PART('call_year')}, {_PART('call_month')}, {_PART('call_day')}), '%Y-%m-%d')"
SQL_DATE = f"coalesce(strftime(coalesce({_STATED}, {_PARTS}), '%Y-%m-%d %H:%M:%S'), '')"
_CLEANED = f"select file_name, row_no, {sql_clean('querytext')} as question, {sql_clean('kccans')} as answer, {sql_clean('crop')} as crop, {SQL_DATE} as asked_at from kcc_calls"


def calls(spark, d):
    return table(spark, d, "kcc_calls")


@query(f"""
with cleaned as ({_CLEANED}), english as (select * from cleaned where {sql_english('answer')}),
first as (select * from english qualify row_number() over (partition by question order by file_name, row_no) = 1)
select cast(row_number() over (order by file_name, row_no) as bigint) as id, question, answer, crop, asked_at, file_name, row_no from first
""")
def clean_dedup(spark, d):
    return clean.clean_and_dedup(calls(spark, d)).select(F.col("id").cast("bigint"), "question", "answer", "crop", "asked_at", "file_name", "row_no")


@query(f"select call_id, {sql_clean('querytext')} as question, {sql_clean('crop')} as crop from kcc_calls")
def clean_text(spark, d):
    return calls(spark, d).select("call_id", text.clean_text(F.col("querytext")).alias("question"), text.clean_text(F.col("crop")).alias("crop"))


@query(f"select doc_id, {sql_sentence_case('lower(coalesce(text, $$$$))')} as cased from documents")
def sentence_case(spark, d):
    return table(spark, d, "documents").select("doc_id", text.sentence_case(F.lower(F.coalesce("text", F.lit("")))).alias("cased"))


@query(f"select call_id, coalesce({sql_english('kccans')}, false) as english from kcc_calls")
def english_filter(spark, d):
    return calls(spark, d).select("call_id", text.is_english(F.col("kccans")).alias("english"))


@query(f"select call_id, {SQL_DATE} as asked_at from kcc_calls")
def parse_dates(spark, d):
    return calls(spark, d).select("call_id", dates.call_date(F.col("createdon"), F.col("call_year"), F.col("call_month"), F.col("call_day")).alias("asked_at"))


@query("select call_id, cast(md5_number_upper(coalesce(querytext, '')) as varchar) as hash from kcc_calls")
def question_hash(spark, d):
    return calls(spark, d).select("call_id", hashing.md5_number(F.coalesce("querytext", F.lit(""))).alias("hash"))


@query("select call_id, sha256(coalesce(querytext, '')) as hash from kcc_calls")
def sha256(spark, d):
    return calls(spark, d).select("call_id", hashing.sha256(F.coalesce("querytext", F.lit(""))).alias("hash"))


#: DuckDB composes canonically only; these are the compatibility characters of the test tables.
SQL_NFKC = r"""nfc_normalize(replace(regexp_replace({x}, '[\x{{a0}}\x{{2002}}\x{{2003}}\x{{2009}}\x{{202f}}\x{{3000}}]', ' ', 'g'), '…', '...'))"""


@query(f"select call_id, {SQL_NFKC.format(x='querytext')} as composed from kcc_calls")
def nfkc_text(spark, d):
    return calls(spark, d).select("call_id", text.nfkc(F.col("querytext")).alias("composed"))


@query(r"select call_id, regexp_replace(lower(querytext), '[^\p{L}\p{M}\p{Nd}\p{Pc}\s/%-]', ' ', 'g') as bare from kcc_calls")
def punct_clean(spark, d):
    return calls(spark, d).select("call_id", text.clean_punctuation(F.lower("querytext")).alias("bare"))


@query(f"select call_id, {sql_squeeze('querytext')} as squeezed from kcc_calls")
def whitespace_squeeze(spark, d):
    return calls(spark, d).select("call_id", text.squeeze(F.col("querytext")).alias("squeezed"))


_SOUND_PREFIX = rf"length(p) between 2 and 80 and not regexp_matches(p, '{rules.BAD_PREFIX}')"
SQL_PREFIXES = f"select distinct p from (select lower({sql_strip('x')}) as p from (select unnest(prefixes) as x from rule_extractions)) where {_SOUND_PREFIX}"
_BAD = rules.BAD_REPLACEMENT
SQL_RULES = f"""
select key, max_by(value, (response_id, value)) as value from (
  select response_id, lower({sql_strip('e.key')}) as key, lower({sql_strip('e.value')}) as value from (
    select response_id, unnest(map_entries(canonical_replacements)) as e from rule_extractions))
where key <> '' and value <> '' and key <> value and length(key) <= 100 and length(value) <= 100
  and not regexp_matches(key, '{_BAD}') and not regexp_matches(value, '{_BAD}') group by key
"""


@query(f"select p as prefix from ({SQL_PREFIXES})")
def rule_filter(spark, d):
    return rules.merged_prefixes(table(spark, d, "rule_extractions"))


@query(SQL_RULES)
def rule_merge(spark, d):
    return rules.merged_replacements(table(spark, d, "rule_extractions"))


#: Openings of questions, as prefixes beside those that the replies suggest.
OPENINGS = ("sir", "madam", "kisan query", "namaste sir", "please tell", "query regarding", "sir please tell", "farmer asked about")
_OPEN = ", ".join(f"('{o}')" for o in OPENINGS)


@query(f"""
with listed as ({SQL_PREFIXES} union select * from (values {_OPEN}) t(p)),
pattern as (select '^(?:' || string_agg(regexp_escape(p), '|' order by length(p) desc, p) || ')\\s*' as re from listed)
select call_id, regexp_replace(lower(querytext), re, '') as question from kcc_calls, pattern
""")
def prefix_strip(spark, d):
    listed = list(rules.rule_config(table(spark, d, "rule_extractions")).prefixes) + list(OPENINGS)
    return calls(spark, d).select("call_id", text.strip_prefix(F.lower("querytext"), listed).alias("question"))


@query(f"""
with rules as (select list('\\b' || regexp_escape(key) || '\\b' || chr(1) || value order by length(key) desc, key) as all_rules from ({SQL_RULES}))
select id, list_reduce(list_concat([lower(original_question)], all_rules),
  lambda so_far, r: regexp_replace(so_far, split_part(r, chr(1), 1), split_part(r, chr(1), 2), 'g')) as question
from normalized_rows, rules where original_question is not null
""")
def canonical_replace(spark, d):
    config = rules.rule_config(table(spark, d, "rule_extractions"))
    rows = table(spark, d, "normalized_rows").filter("original_question is not null")
    return rows.select("id", text.replace_terms(F.lower("original_question"), config.canonical_replacements).alias("question"))


_STEPS = [
    ("lowercase", F.lower), ("whitespace", text.squeeze), ("punctuation", text.clean_punctuation), ("whitespace", text.squeeze),
    ("prefix", lambda c: text.strip_prefix(c, list(OPENINGS))), ("whitespace", text.squeeze),
]
_BARE = r"regexp_replace(s2, '[^\p{L}\p{M}\p{Nd}\p{Pc}\s/%-]', ' ', 'g')"
_PATTERN = "^(?:" + "|".join(sorted(OPENINGS, key=lambda p: (-len(p), p))) + r")\s*"
_CHAIN = f"""
a as (select call_id, coalesce(querytext, '') as s0 from kcc_calls), b as (select *, lower(s0) as s1 from a), c as (select *, {sql_squeeze('s1')} as s2 from b),
e as (select *, {_BARE} as s3 from c), f as (select *, {sql_squeeze('s3')} as s4 from e), g as (select *, regexp_replace(s4, '{_PATTERN}', '') as s5 from f),
h as (select *, {sql_squeeze('s5')} as s6 from g)
"""


def chained(spark, d):
    rows = calls(spark, d).select("call_id", "querytext")
    return normalize.apply_chain(rows, "querytext", "normalized_question", _STEPS)


@query(f"""with {_CHAIN} select call_id, s6 as normalized_question, s1 <> s0 as changed_lowercase, s3 <> s2 as changed_punctuation, s5 <> s4 as changed_prefix,
s6 <> s5 as changed_whitespace from h""")
def change_flags(spark, d):
    return chained(spark, d).select("call_id", "normalized_question", "changed_lowercase", "changed_punctuation", "changed_prefix", "changed_whitespace")


_ERRORS = r"""list_filter([case when q = '' then 'empty_question' end, case when regexp_matches(q, '^[^\p{L}\p{M}\p{Nd}]+$') then 'only_punctuation' end,
case when regexp_matches(q, '^[0-9\s]+$') then 'only_numbers' end, case when length(q) < 3 then 'too_short' end, case when length(q) > 80 then 'too_long' end], lambda x: x is not null)"""


@query(f"""with {_CHAIN}, v as (select call_id, s6 as q from h)
select call_id, array_to_string({_ERRORS}, ',') as errors, len({_ERRORS}) = 0 as is_valid from v""")
def validate_rows(spark, d):
    errors = normalize.validation_errors(F.col("normalized_question"), 3, 80)
    return chained(spark, d).select("call_id", F.array_join(errors, ",").alias("errors"), (F.size(errors) == 0).alias("is_valid"))


@query(f"""with {_CHAIN}, v as (select *, len({_ERRORS.replace('q ', 's6 ').replace('(q', '(s6')}) = 0 as ok from h)
select count(*) as rows_processed, cast(sum(ok::int) as bigint) as rows_valid, cast(sum((not ok)::int) as bigint) as rows_invalid, cast(sum((s6 = '')::int) as bigint) as rows_empty,
cast(sum((s5 <> s4)::int) as bigint) as rows_prefix_removed from v""")
def norm_stats(spark, d):
    errors = normalize.validation_errors(F.col("normalized_question"), 3, 80)
    rows = chained(spark, d).withColumn("is_valid", F.size(errors) == 0).withColumn("changed_canonical", F.lit(False))
    return normalize.counters(rows).drop("rows_canonical_replaced")


_RULES_LIST = f"select list('\\b' || regexp_escape(key) || '\\b' || chr(1) || value order by length(key) desc, key) as all_rules from ({SQL_RULES})"
_FOLD = "list_reduce(list_concat([s5], all_rules), lambda so_far, r: regexp_replace(so_far, split_part(r, chr(1), 1), split_part(r, chr(1), 2), 'g'))"


@query(rf"""with listed as (select '^(?:' || string_agg(regexp_escape(p), '|' order by length(p) desc, p) || ')\s*' as re from ({SQL_PREFIXES})), rules as ({_RULES_LIST}),
a as (select call_id, createdon, lower({SQL_NFKC.format(x="coalesce(querytext, '')")}) as s1 from kcc_calls), b as (select *, {sql_squeeze('s1')} as s2 from a),
e as (select *, {sql_squeeze(_BARE)} as s4 from b), f as (select *, regexp_replace(s4, re, '') as s5 from e, listed),
v as (select call_id, {sql_squeeze(_FOLD)} as q from f, rules)
select cast(call_id as varchar) as id, q as normalized_question, cast(null as varchar) as location, 'en' as language, array_to_string({_ERRORS.replace('> 80', '> 1000')}, ',') as errors,
len({_ERRORS.replace('> 80', '> 1000')}) = 0 as is_valid from v""")
def normalize_calls(spark, d):
    config = rules.rule_config(table(spark, d, "rule_extractions"))
    mapping = {"id": "call_id", "original_question": "querytext", "crop": "crop", "category": "category", "sector": "sector", "location": "Location", "date": "createdon"}
    return normalize.normalize(calls(spark, d), config, "2025-01-01 00:00:00", mapping).select("id", "normalized_question", "location", "language", F.array_join("validation_errors", ",").alias("errors"), "is_valid")


@query(f"""select file_name, row_no, querytext from kcc_calls where querytext is not null qualify row_number() over (partition by lower({sql_squeeze('querytext')}) order by file_name, row_no) = 1""")
def dedup_first(spark, d):
    rows = calls(spark, d).filter("querytext is not null").select("file_name", "row_no", "querytext")
    return dedup.keep_first(rows, [F.lower(text.squeeze(F.col("querytext")))], ["file_name", "row_no"])


@query("""select file_name, row_no, querytext, kccans from (select * from kcc_calls qualify row_number() over (partition by file_name, querytext, kccans order by row_no) = 1)
where querytext is not null and kccans is not null""")
def dedup_pair(spark, d):
    return dedup.first_pairs(calls(spark, d).select("file_name", "row_no", "querytext", "kccans"), "file_name", "querytext", "kccans", "row_no")


@query("""with pairs as (select file_name, querytext, kccans, count(*) as n from kcc_calls group by all),
each as (select file_name as file, sum(n) as n, sum((querytext is not null and kccans is not null)::int) as k from pairs group by 1
union all select null, sum(n), sum((querytext is not null and kccans is not null)::int) from pairs)
select file, cast(n as bigint) as initial, cast(k as bigint) as final, cast(n - k as bigint) as removed, cast((n - k) * 1000 // n as bigint) as removed_permille from each""")
def dedup_stats(spark, d):
    return dedup.dedup_summary(calls(spark, d), "file_name", "querytext", "kccans")


@query(f"""with q as (select {sql_squeeze('querytext')} as question, call_id from kcc_calls where length({sql_strip('querytext')}) > 3)
select question, call_id from q qualify row_number() over (partition by lower(question) order by call_id) = 1""")
def question_extract(spark, d):
    found = sampling.extract_questions(calls(spark, d), "querytext", "call_id")
    return sampling.first_questions(found, ["call_id"])


@query(f"""with q as (select {sql_squeeze('querytext')} as question, call_id from kcc_calls where length({sql_strip('querytext')}) > 3),
u as (select * from q qualify row_number() over (partition by lower(question) order by call_id) = 1),
n as (select *, row_number() over (order by call_id) - 1 as i, count(*) over () as total from u), s as (select *, greatest(1, total // 150) as step from n)
select question, call_id from s where i % step = 0 and i < step * 150""")
def stride_sample(spark, d):
    return sampling.stride_sample(question_extract(spark, d), ["call_id"], 150)


@query("select call_id, cast(row_number() over (order by ingested_at, call_id) as bigint) as id from kcc_calls")
def row_ids(spark, d):
    return with_row_ids(calls(spark, d).select("call_id", "ingested_at"), ["ingested_at", "call_id"]).select("call_id", F.col("id").cast("bigint"))


@query("""with n as (select call_id, row_number() over (order by call_id) as i from kcc_calls), b as (select (i - 1) // 1000 + 1 as batch_no, min(i) as first_row, max(i) as last_row, count(*) as n_rows from n group by 1)
select cast(batch_no as bigint) as batch_no, cast(first_row as bigint) as first_row, cast(last_row as bigint) as last_row, n_rows, 'Batch ' || batch_no || ' Range (' || first_row || ' - ' || last_row || ').csv' as name from b""")
def batch_ranges(spark, d):
    numbered = with_row_ids(calls(spark, d).select("call_id"), ["call_id"], "i")
    ranges = numbered.groupBy((F.floor((F.col("i") - 1) / 1000) + 1).alias("batch_no")).agg(
        F.min("i").cast("bigint").alias("first_row"), F.max("i").cast("bigint").alias("last_row"), F.count(F.lit(1)).alias("n_rows")
    )
    return ranges.withColumn("name", batch_name(F.col("batch_no"), F.col("first_row"), F.col("last_row")))


@query("""with t as (select count(*) as total from kcc_calls) select cast(x as bigint) as page_offset, cast(500 as bigint) as page_limit, cast(least(500, total - x) as bigint) as expected, x + 500 >= total as last_page
from t, unnest(range(0, total, 500)) as r(x)""")
def page_plan(spark, d):
    total, at = F.lit(calls(spark, d).count()), F.col("id")
    each = spark.range(0, calls(spark, d).count(), 500)
    return each.select(at.alias("page_offset"), F.lit(500).cast("bigint").alias("page_limit"), F.least(F.lit(500), total - at).cast("bigint").alias("expected"), (at + 500 >= total).alias("last_page"))


@query(f"select case when regexp_matches(lower(regexp_replace(querytext, '\\s+', ' ', 'g')), '{'|'.join(NOISE)}') then 'DISCARD' else 'KEEP' end as decision, count(*) as n from kcc_calls group by 1")
def noise_filter(spark, d):
    return filter_noise(calls(spark, d), "call_id", F.col("querytext")).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@query("select call_id, case when length(kccans) > 60 then substr(kccans, 1, 60) || '...' else kccans end as short from kcc_calls")
def shorten_text(spark, d):
    return calls(spark, d).select("call_id", text.shorten(F.col("kccans"), 60).alias("short"))


@query("""with r as (select querytext, kccans, row_number() over (order by call_id) - 1 as i from kcc_calls where querytext is not null and kccans is not null)
select cast(i // 10 as bigint) as batch_no, cast(min(i) as bigint) as first_row, cast(max(i) as bigint) as last_row, count(*) as n, sum(length(querytext))::bigint as chars from r group by 1""")
def row_batches(spark, d):
    pairs = calls(spark, d).dropna(subset=["querytext", "kccans"])
    made = generate.row_batches(pairs, ["call_id"], 10, ["querytext", "kccans"])
    rows = F.from_json("records", "array<struct<querytext:string,kccans:string>>")
    return made.select("batch_no", F.col("first_row").cast("bigint"), F.col("last_row").cast("bigint"), F.size(rows).cast("bigint").alias("n"),
                       F.aggregate(rows, F.lit(0).cast("bigint"), lambda s, r: s + F.length(r["querytext"])).alias("chars"))


@query("""with r as (select file_name, row_no - 1 as i, querytext, kccans from kcc_calls where querytext is not null), b as (select file_name as file, i // 50 as chunk_index, count(*) as n, sum((kccans is null)::int) as open from r group by 1, 2),
s as (select file, cast(chunk_index as bigint) as chunk_index, n, 'Summary of ' || n || ' questions' as block from b where open < 3) select file, chunk_index, n, block from s""")
def align_blocks(spark, d):
    rows = calls(spark, d).filter("querytext is not null")
    batches = rows.groupBy(F.col("file_name").alias("file"), F.floor((F.col("row_no") - 1) / 50).alias("chunk_index")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kccans").isNull().cast("int")).alias("open"))
    made = F.when(F.col("open") < 3, F.concat(F.lit("Summary of "), F.col("n").cast("string"), F.lit(" questions")))
    chunk = batches.select("file", "chunk_index", generate.format_chunk(made, F.col("chunk_index") * 50, 50).alias("chunk"))
    content = chunk.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk"))), lambda x: x["chunk"]), "").alias("content"))
    blocks = generate.blocks_of(content, "file", "content").withColumn("chunk_index", F.col("chunk_index").cast("bigint"))
    return generate.align_blocks(batches, blocks).select("file", "chunk_index", "n", "block")


@query("""select call_id from kcc_calls where cast(call_id as varchar) not in (select id from normalized_rows where id is not null)""")
def pending_work(spark, d):
    work = calls(spark, d).select("call_id", F.col("call_id").cast("string").alias("id"))
    return generate.pending(work, table(spark, d, "normalized_rows"), "id").select("call_id")


@query("""select 'cleaned_' || file_name as cleaned, replace(file_name, '.csv', '_cpt.txt') as generated, regexp_replace(file_name, '[\\\\/*?:"<>|]', '', 'g') as safe, strftime(min(ingested_at), '%b') as month_name from kcc_calls group by file_name""")
def safe_filename(spark, d):
    return calls(spark, d).groupBy("file_name").agg(F.min("ingested_at").alias("t")).select(
        F.concat(F.lit("cleaned_"), "file_name").alias("cleaned"), F.replace("file_name", F.lit(".csv"), F.lit("_cpt.txt")).alias("generated"),
        text.safe_filename(F.col("file_name")).alias("safe"), text.month_name(F.col("t")).alias("month_name"),
    )


@query("""with m as (select districtname as district, strftime(ingested_at, '%Y-%m') as month, cast(ingested_at as date) as day, querytext as link, call_id from kcc_calls where querytext is not null)
select district, month, link, call_id from m qualify row_number() over (partition by month, link order by day, call_id) = 1""")
def link_month_dedup(spark, d):
    rows = calls(spark, d).filter("querytext is not null").select(
        F.col("districtname").alias("district"), F.date_format("ingested_at", "yyyy-MM").alias("month"), F.to_date("ingested_at").alias("day"), F.col("querytext").alias("link"), "call_id"
    )
    return dedup.keep_first(rows, [F.col("month"), F.col("link")], ["day", "call_id"]).select("district", "month", "link", "call_id")


@query("select is_valid, count(*) as n, cast(sum(len(coalesce(validation_errors, []))) as bigint) as errors from normalized_rows group by 1")
def status_counts(spark, d):
    return table(spark, d, "normalized_rows").groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.coalesce("validation_errors", F.array()))).cast("bigint").alias("errors"))


@query(r"""with t as (select id, coalesce(original_question, '') as w from normalized_rows), k as (select * from t, (values ('quant_fact_ledger'), ('textbook')) v(kind)),
c as (select id, kind, length(w) as n, length(regexp_replace(w, '[^\p{L}]', '', 'g')) as a, length(regexp_replace(w, '[^\p{Nd}]', '', 'g')) as g,
 len(list_filter(regexp_split_to_array(w, '\s+'), lambda x: x <> '')) as words, length(regexp_replace(w, '\s', '', 'g')) as l from k),
r as (select *, a / greatest(n, 1) as alpha, g / greatest(n, 1) as digit, case when words > 0 then l / words else 0 end as mean, kind = 'quant_fact_ledger' as dense from c)
select id, kind, case when words = 0 then 'empty_text' when alpha < case when dense then 0.45 else 0.70 end then 'alpha_ratio' when digit > case when dense then 0.45 else 0.20 end then 'digit_ratio'
 when mean < case when dense then 2.5 else 3.0 end or mean > 8.0 then 'avg_word_len' else '' end as reason from r""")
def density_gate(spark, d):
    kinds = F.explode(F.array(F.lit("quant_fact_ledger"), F.lit("textbook")))
    rows = table(spark, d, "normalized_rows").select("id", "original_question", kinds.alias("kind"))
    return rows.select("id", "kind", quality.density(F.col("original_question"), F.col("kind"))["reason"].alias("reason"))
