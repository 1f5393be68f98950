"""Queries on books, generated groups, chats, web pages and evaluations."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import html, nested, tables, text
from granary.models.clients import StubClient, complete
from granary.operators import chapters, evaluate, generate, quality, windows
from granary.operators.ids import with_row_ids
from granary.plans.registry import query, sql_strip
from granary.session import table

#: Words of titles that stand at the head of pages.
HEADERS = ["common field practice", "harvest and threshing", "soil stewardship"]


def groups(spark, d):
    return table(spark, d, "qna_groups")


def pages(spark, d):
    return table(spark, d, "page_blocks")


@query(r"select doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '\p{Nd}+(?:[.,]\p{Nd}+)?')) as bigint) as numbers from documents")
def numeric_anchors(spark, d):
    return table(spark, d, "documents").select("doc_id", text.numeric_anchors(F.coalesce("text", F.lit(""))).cast("bigint").alias("numbers"))


_N = lambda c: rf"len(regexp_extract_all({c}, '\p{{Nd}}+(?:[.,]\p{{Nd}}+)?'))"


@query(f"""with n as (select group_id, {_N('exact_source_quote')} as a, {_N('authoritative_answer')} as b from qna_groups where exact_source_quote is not null and authoritative_answer is not null)
select group_id, cast(floor(round(case when a > 0 then least(b / a, 1.5) else 1 end, 3) * 1000 + 0.5) as bigint) as kept_permille, cast(greatest(a * 4 // 5, 1) as bigint) as target from n""")
def anchor_retention(spark, d):
    rows = groups(spark, d).dropna(subset=["exact_source_quote", "authoritative_answer"])
    kept = text.anchor_retention(F.col("exact_source_quote"), F.col("authoritative_answer"))
    return rows.select("group_id", F.floor(kept * 1000 + 0.5).cast("bigint").alias("kept_permille"), text.anchor_target(F.col("exact_source_quote")).cast("bigint").alias("target"))


_KEPT = " and ".join([r"x <> ''", r"not regexp_matches(x, '^\p{Nd}+$')", *[f"not contains(lower(x), '{h}')" for h in HEADERS]])


@query(f"""select block_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_strip('x')}), lambda x: {_KEPT}), chr(10)) as text
from page_blocks where text is not null""")
def page_text_clean(spark, d):
    return pages(spark, d).filter("text is not null").select("block_id", text.clean_page(F.col("text"), HEADERS).alias("text"))


@query("""with p as (select book_key as book, (page_no - 1) // 10 as c, page_no, min(text) as t from page_blocks where text is not null and book_key is not null group by all)
select book, 'chapter_' || c as key, count(*) as pages, md5(string_agg(t, chr(10) || chr(10) order by page_no)) as text_hash from p group by 1, 2""")
def chapter_pages(spark, d):
    once = pages(spark, d).filter("text is not null and book_key is not null").groupBy("book_key", "page_no").agg(F.min("text").alias("text"))
    number = F.floor((F.col("page_no") - 1) / 10)
    starts = once.select("book_key", number.alias("c")).distinct().withColumn("key", F.concat(F.lit("chapter_"), F.col("c").cast("string")))
    bounds = starts.select("book_key", "key", (F.col("c") * 10 + 1).cast("int").alias("first_page"), (F.col("c") * 10 + 10).cast("int").alias("last_page"))
    found = chapters.chapter_texts(bounds, once, "book_key", "page_no", "text")
    return found.select("book", "key", F.col("pages").cast("bigint"), F.md5("text").alias("text_hash"))


#: A page on which a chapter begins, and one with a heading of its own or a table.
_CHAPTER = r"(?:^|\n)\s*Chapter\s+\S{1,4}\s*:"
_TOPIC = r"(?:^|\n)\s*Chapter\s+\S{1,4}\s*:|\|"


@query(rf"""with m as (select book_key as book, max(page_no) as n from page_blocks where book_key is not null group by 1),
t as (select distinct p.book_key as book, p.page_no as s, m.n from page_blocks p join m on m.book = p.book_key where regexp_matches(p.text, '{_CHAPTER}'))
select book, cast(s as bigint) as start_page, cast(s + 8 as bigint) as first_page, cast(greatest(s, coalesce(lead(s) over (partition by book order by s) - 1, n)) + 8 as bigint) as last_page from t""")
def toc_bounds(spark, d):
    """Chapters by their headings, over all pages."""
    known = pages(spark, d).filter("book_key is not null").select(F.col("book_key").alias("book"), "page_no", F.coalesce(F.col("text").rlike(_CHAPTER), F.lit(False)).alias("starts"))
    ends = known.groupBy("book").agg(F.max("page_no").alias("n"))
    toc = known.filter("starts").select("book", F.col("page_no").alias("start_page")).distinct().join(ends, "book")
    bounds = chapters.chapter_bounds(toc, "book", "start_page", F.col("n"), F.lit(8))
    return bounds.select("book", *[F.col(c).cast("bigint") for c in ("start_page", "first_page", "last_page")])


@query(rf"""with p as (select distinct book_key as book, page_no from page_blocks where book_key is not null and regexp_matches(text, '{_TOPIC}')), c as (select *, (page_no - 1) // 24 as c from p)
select book, cast(c as bigint) as chapter, 'topic ' || page_no as title, cast(page_no + 8 as bigint) as first_page,
 cast(coalesce(lead(page_no) over (partition by book, c order by page_no), page_no) + 8 as bigint) as last_page from c""")
def topic_bounds(spark, d):
    """Topics by headings and tables, over all pages."""
    topics = pages(spark, d).filter(F.col("book_key").isNotNull() & F.col("text").rlike(_TOPIC)).select(F.col("book_key").alias("book"), "page_no").distinct()
    listed = F.array_sort(F.collect_list(F.struct(F.col("page_no").alias("start_page"), F.concat(F.lit("topic "), F.col("page_no").cast("string")).alias("title"))))
    grouped = topics.groupBy("book", F.floor((F.col("page_no") - 1) / 24).alias("chapter")).agg(listed.alias("topics"))
    each = grouped.select("book", "chapter", F.explode(chapters.topic_bounds(F.col("topics"), F.lit(8))).alias("t"))
    return each.select("book", "chapter", "t.title", F.col("t.first_page").cast("bigint").alias("first_page"), F.col("t.last_page").cast("bigint").alias("last_page"))


@query("""with m as (select book_key as book, cast(min(page_no) as bigint) as first_page, cast(max(page_no) as bigint) as last_page from page_blocks where book_key is not null group by 1)
select book as key, 'Book ' || book as title, first_page, last_page from m""")
def toc_rows(spark, d):
    each = pages(spark, d).filter("book_key is not null").groupBy("book_key").agg(F.min("page_no").alias("a"), F.max("page_no").alias("b"))
    entry = F.struct(F.array("a", "b").alias("range"), F.concat(F.lit("Book "), "book_key").alias("title"))
    toc = each.select(F.to_json(F.map_from_arrays(F.array("book_key"), F.array(entry))).alias("toc"))
    return chapters.toc_rows(toc, "toc").select("key", "title", F.col("first_page").cast("bigint"), F.col("last_page").cast("bigint"))


_PNG = "data:image/png;base64,QUJDRA=="


@query(rf"""select group_id, {sql_strip(f"regexp_replace('[Image] ' || coalesce(authoritative_answer, '') || chr(10) || chr(10) || 'end', chr(10) || '{{3,}}', chr(10) || chr(10), 'g')")} as text from qna_groups""")
def chapter_clean(spark, d):
    marked = F.concat(F.lit(f"![fig]({_PNG}) "), F.coalesce("authoritative_answer", F.lit("")), F.lit("\n\n\n\nend"))
    return groups(spark, d).select("group_id", text.clean_chapter(marked).alias("text"))


@query(f"""select group_id, upper(substr(q, 1, 1)) || substr(q, 2) as question from (select group_id, {sql_strip('alternative_questions[1]')} as q from qna_groups where len(alternative_questions) > 0)""")
def question_clean(spark, d):
    first = F.col("alternative_questions")[0]
    asked = F.concat(F.lit("according to the text, "), first, F.lit(" based on the given chapter"))
    return groups(spark, d).filter(F.size("alternative_questions") > 0).select("group_id", text.clean_question(asked).alias("question"))


@query(r"""select group_id, coalesce(exact_source_quote, '') || chr(10) || '[FIGURE 0: ' || case when trim(coalesce(model_version, '')) = '' then 'visual asset present in the original book page' else trim(model_version) end
 || ']' || chr(10) || 'middle' || chr(10) || '[FIGURE 1: visual asset present in the original book page]' || chr(10) as text from qna_groups where coalesce(exact_source_quote, 'x') <> ''""")
def figure_interleave(spark, d):
    source = F.concat(F.coalesce("exact_source_quote", F.lit("")), F.lit(f"![a]({_PNG})middle![b]({_PNG})"))
    rows = groups(spark, d).filter("coalesce(exact_source_quote, 'x') <> ''")
    return rows.select("group_id", nested.interleave_figures(source, F.array(F.col("model_version"))).alias("text"))


@query("""select group_id, form, case when form = 'broken' then null else coalesce(authoritative_answer, '') end as answer from qna_groups, (values ('bare'), ('fenced'), ('prose'), ('broken')) v(form)""")
def json_salvage(spark, d):
    reply = F.to_json(F.struct(F.coalesce("authoritative_answer", F.lit("")).alias("a"), F.col("group_id").alias("n")))
    form = lambda name, value: F.struct(F.lit(name).alias("form"), value.alias("reply"))
    forms = F.array(
        form("bare", reply), form("fenced", F.concat(F.lit("Here it is:\n```json\n"), reply, F.lit("\n```\nDone"))),
        form("prose", F.concat(F.lit("The reply is "), reply, F.lit(" as asked"))), form("broken", F.concat(F.lit("{\"a\": "), F.col("group_id").cast("string"))),
    )
    each = groups(spark, d).select("group_id", F.explode(forms).alias("f"))
    return each.select("group_id", "f.form", F.get_json_object(nested.salvage_json(F.col("f.reply")), "$.a").alias("answer"))


@query(f"""select group_id, way, {sql_strip('authoritative_answer')} as bare from qna_groups, (values ('exact'), ('lines'), ('marks'), ('none')) v(way) where authoritative_answer is not null""")
def fence_strip(spark, d):
    """The three ways to take a fence off, each on the fences that it is for, and a text without one."""
    bare = text.strip(F.col("authoritative_answer"))
    form = lambda name, value: F.struct(F.lit(name).alias("way"), value.alias("bare"))
    ways = F.array(
        form("exact", text.strip(text.strip_fence(F.concat(F.lit("```json\n"), bare, F.lit("\n```"))))), form("lines", text.strip_fence_lines(F.concat(F.lit(" ```text any\n"), bare, F.lit("\n ``` ")))),
        form("marks", text.strip(text.strip_fence_marks(F.concat(F.lit("```Json\n"), bare, F.lit("```"))))), form("none", text.strip_fence_marks(bare)),
    )
    return groups(spark, d).filter("authoritative_answer is not null").select("group_id", F.explode(ways).alias("w")).select("group_id", "w.way", "w.bare")


@query("select group_id, len(alternative_questions) = 3 as complete, case when len(alternative_questions) = 3 then alternative_questions[2] end as second from qna_groups where alternative_questions is not null")
def caption_arrays(spark, d):
    found = nested.captions(F.to_json("alternative_questions"), F.lit(3))
    rows = groups(spark, d).filter("alternative_questions is not null")
    return rows.select("group_id", found.isNotNull().alias("complete"), found[1].alias("second"))


@query(f"select group_id, {sql_strip('authoritative_answer')} as bare from qna_groups where authoritative_answer is not null")
def marker_strip(spark, d):
    marked = F.concat(F.lit("<bos>"), F.col("authoritative_answer"), F.lit("<eos>"))
    return groups(spark, d).filter("authoritative_answer is not null").select("group_id", text.strip_markers(marked).alias("bare"))


_TURNS = "'<start_of_turn>user' || chr(10) || {q} || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) || {a} || '<end_of_turn>' || chr(10)"
_CHAT = _TURNS.format(q="coalesce(alternative_questions[1], '')", a="coalesce(authoritative_answer, '')")


def chats(spark, d):
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    rows = groups(spark, d).filter(F.size("alternative_questions") > 0)
    return rows.select("group_id", F.array(message("user", F.col("alternative_questions")[0]), message("model", F.col("authoritative_answer"))).alias("messages"))


@query(f"select group_id, {_CHAT} as chat from qna_groups where len(alternative_questions) > 0")
def chat_template(spark, d):
    return chats(spark, d).select("group_id", nested.chat_text(F.col("messages")).alias("chat"))


@query(f"""select group_id, cast(length({_TURNS.split(" || {a}")[0].format(q="coalesce(alternative_questions[1], '')")}) + 1 as bigint) as start, cast(length(coalesce(authoritative_answer, '')) + 14 as bigint) as length
from qna_groups where len(alternative_questions) > 0""")
def response_mask(spark, d):
    spans = nested.trainable_spans(nested.chat_text(F.col("messages")))
    each = chats(spark, d).select("group_id", F.explode(spans).alias("s"))
    return each.select("group_id", F.col("s.start").cast("bigint").alias("start"), F.col("s.length").cast("bigint").alias("length"))


@query(f"""select group_id, {sql_strip("coalesce(alternative_questions[1], '')")} as question, {sql_strip("coalesce(authoritative_answer, '')")} as answer from qna_groups where len(alternative_questions) > 0""")
def chat_to_qa(spark, d):
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    rows = groups(spark, d).filter(F.size("alternative_questions") > 0)
    both = F.array(message("system", F.lit("x")), message("user", F.col("alternative_questions")[0]), message("user", F.lit("again")), message("assistant", F.col("authoritative_answer")))
    return generate.chat_pairs(rows.select("group_id", F.to_json(F.struct(both.alias("messages"))).alias("line")), "line", "group_id")


@query(f"""with q as (select group_id, unnest(case when group_id % 4 = 1 then alternative_questions[1:1] when group_id % 4 = 2 then alternative_questions[1:2] else alternative_questions end) as q,
{sql_strip('authoritative_answer')} as a from qna_groups)
select cast(group_id as varchar) as key, {sql_strip('q')} as question, a as answer from q where {sql_strip('q')} <> '' and a <> ''""")
def qna_flatten(spark, d):
    """Batch results in the three shapes of groups, in turn, and every fourth under a root of another name; broken and failed lines beside them."""
    asked, told = F.col("alternative_questions"), F.col("authoritative_answer")
    whole = F.to_json(F.struct(F.array(F.struct("authoritative_answer", "alternative_questions")).alias("qna_groups")))
    single = F.to_json(F.struct(F.array(F.struct(told.alias("answer"), F.get(asked, F.lit(0)).alias("question"))).alias("qna_groups")))
    pair = lambda i: F.struct(F.get(asked, F.lit(i)).alias("question"), told.alias("answer"))
    older = F.to_json(F.struct(F.array(F.struct(F.array(pair(0), pair(1)).alias("variations"))).alias("qna_groups")))
    astray = F.to_json(F.struct(F.lit("n").alias("note"), F.array(F.struct("authoritative_answer", "alternative_questions")).alias("facts")))
    kind = F.col("group_id") % 4
    body = F.when(kind == 0, whole).when(kind == 1, single).when(kind == 2, older).otherwise(astray)
    lines = groups(spark, d).select(nested.envelope(F.col("group_id").cast("string"), F.concat(F.lit("```json\n"), body, F.lit("\n```"))).alias("line"))
    failed = groups(spark, d).select(F.to_json(F.struct(F.col("group_id").cast("string").alias("key"), F.lit("quota").alias("error"))).alias("line"))
    broken = groups(spark, d).select(nested.envelope(F.col("group_id").cast("string"), F.lit("{\"qna_groups\": [")).alias("line"))
    return generate.flatten_replies(lines.unionByName(failed).unionByName(broken), "line")


@query(f"""select group_id, cast(i as bigint) as at, case when i % 2 = 0 then 'text' else 'image' end as kind,
case i when 0 then q when 1 then '![a]({_PNG})' when 2 then 'middle' else '![b]({_PNG})' end as body
from (select group_id, coalesce(exact_source_quote, '') as q from qna_groups), unnest(range(0, 4)) r(i) where {sql_strip('q')} <> '' or i > 0""".replace("cast(i as bigint) as at", f"cast(case when {sql_strip('q')} = '' then i - 1 else i end as bigint) as at"))
def figure_segments(spark, d):
    source = F.concat(F.coalesce("exact_source_quote", F.lit("")), F.lit(f"![a]({_PNG})middle![b]({_PNG}) "))
    each = groups(spark, d).select("group_id", F.posexplode(nested.split_segments(source)).alias("at", "s"))
    return each.select("group_id", F.col("at").cast("bigint"), "s.kind", "s.body")


@query("select group_id, coalesce(authoritative_answer, '') as text from qna_groups")
def wrap_envelope(spark, d):
    line = nested.envelope(F.col("group_id").cast("string"), F.coalesce("authoritative_answer", F.lit("")))
    path = F.get_json_object(line, "$.response.candidates[0].content.parts[0].text")
    return groups(spark, d).select("group_id", F.coalesce(path, F.lit("")).alias("text"))


@query("select chunk_key as key, count(*) as facts, cast(sum(len(coalesce(alternative_questions, []))) as bigint) as samples from qna_groups group by 1")
def chapter_stats(spark, d):
    return groups(spark, d).groupBy(F.col("chunk_key").alias("key")).agg(F.count(F.lit(1)).alias("facts"), F.sum(F.size(F.coalesce("alternative_questions", F.array()))).cast("bigint").alias("samples"))


_USELESS = "|".join(quality.USELESS)


@query(f"""with t as (select group_id, {sql_strip("coalesce(authoritative_answer, '')")} as t from qna_groups), u as (select group_id, repeat(t || ' ', 3) as t from t), v as (select group_id, {sql_strip('t')} as t from u)
select group_id, regexp_replace(upper(t), '^[.! ]+|[.! ]+$', '', 'g') = 'NO_USABLE_DATA' or length(t) < 300 or (length(t) < 800 and regexp_matches(lower(t), '{_USELESS}')) as unusable from v""")
def unusable_filter(spark, d):
    thrice = F.repeat(F.concat(text.strip(F.coalesce("authoritative_answer", F.lit(""))), F.lit(" ")), F.lit(3))
    return groups(spark, d).select("group_id", quality.is_unusable(thrice).alias("unusable"))


@query(f"select group_id, regexp_matches(lower(concat_ws(' ', chunk_key, exact_source_quote)), '{quality.REFERENCE}') as reference from qna_groups")
def reference_route(spark, d):
    return groups(spark, d).select("group_id", quality.is_reference(F.col("chunk_key"), F.col("exact_source_quote")).alias("reference"))


KINDS = ["article", "factsheet", "quant_fact_ledger", "exam_bank_grounded"]


@query("""with k as (select distinct chunk_key as key from qna_groups where chunk_key is not null), t as (select unnest(['raw', 'encyclopedic_macro_synthesis', 'quant_fact_ledger', 'exam_bank_grounded']) as kind)
select key, kind, key || '__' || kind as chunk_id from k, t""")
def rep_fanout(spark, d):
    keys = groups(spark, d).filter("chunk_key is not null").select(F.col("chunk_key").alias("key")).distinct()
    named = list(dict.fromkeys(quality.ALIASES.get(k, k) for k in KINDS))
    return generate.fan_out(keys, named, quality.is_reference(F.col("key"), F.lit(None).cast("string"))).select("key", "kind", "chunk_id")


@query("""select group_id, case model_version when 'v1' then 'encyclopedic_macro_synthesis,quant_fact_ledger' else 'quant_fact_ledger,other' end as kinds from qna_groups""")
def alias_resolve(spark, d):
    given = F.when(F.col("model_version") == "v1", F.array(*map(F.lit, ("article", "factsheet", "quant_fact_ledger")))).otherwise(F.array(*map(F.lit, ("factsheet", "other", "factsheet"))))
    return groups(spark, d).select("group_id", F.array_join(quality.resolve_kinds(given), ",").alias("kinds"))


@query("""with w as (select group_id, len(coalesce(alternative_questions, [])) as n, model_version as v from qna_groups)
select group_id, case when n = 3 and v = 'v1' then 'cached' else 'missing' end as state from w""")
def caption_lookup(spark, d):
    work = groups(spark, d).select("group_id", F.size(F.coalesce("alternative_questions", F.array())).alias("images"))
    cache = groups(spark, d).filter("model_version = 'v1'").select("group_id", F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.lit("note")).alias("captions"))
    found = generate.cached_captions(work, cache, "group_id", "images")
    return found.select("group_id", F.when(F.col("captions").isNull(), "missing").otherwise("cached").alias("state"))


@query("""select cast(group_id as varchar) as chunk, '/v1/judge' as url, coalesce(exact_source_quote, '') || ' / ' || coalesce(authoritative_answer, '') as prompt from qna_groups""")
def batch_requests(spark, d):
    pairs = groups(spark, d).withColumn("chunk_index", F.col("group_id"))
    prompt = F.concat(F.coalesce("exact_source_quote", F.lit("")), F.lit(" / "), F.coalesce("authoritative_answer", F.lit("")))
    made = generate.judge_requests(pairs, prompt, "/v1/judge")
    get = lambda path: F.get_json_object("request", path)
    return made.select(F.replace(get("$.custom_id"), F.lit("chunk_"), F.lit("")).alias("chunk"), get("$.url").alias("url"), get("$.body.contents[0].parts[0].text").alias("prompt"))


@query("""with t as (select *, (row_number() over (partition by chunk_key order by group_id, model_version) - 1) // 100 as part from qna_groups where chunk_key is not null)
select chunk_key as conversation, cast(part as bigint) as part, count(*) as turns, md5(string_agg(case when group_id % 2 = 0 then 'user' else 'assistant' end || ': ' || coalesce(authoritative_answer, ''), chr(10) order by group_id)) as history_hash
from t group by 1, 2""")
def transcripts(spark, d):
    turns = groups(spark, d).filter("chunk_key is not null").select(
        F.col("chunk_key").alias("conversation"), F.col("group_id").alias("turn"), F.when(F.col("group_id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("authoritative_answer").alias("said")
    )
    found = evaluate.transcripts(turns, "conversation", "turn", "role", "said", per_part=100)
    return found.select("conversation", F.col("part").cast("bigint"), F.col("turns").cast("bigint"), F.md5("history").alias("history_hash"))


@query("""with g as (select chunk_key, cast(length(coalesce(authoritative_answer, '')) % 101 as double) as a, cast(len(coalesce(alternative_questions, [])) * 30 as double) as r from qna_groups where chunk_key is not null),
c as (select chunk_key, round(sum(a) / count(*), 2) as a, round(sum(r) / count(*), 2) as r from g group by 1), m as (select count(*) as chapters, round(avg(a), 2) as a, round(avg(r), 2) as r from c)
select chapters, cast(a * 100 + 0.5 as bigint) as accuracy, cast(r * 100 + 0.5 as bigint) as retention, cast(floor(round(a * 0.30 + r * 0.20 + a * 0.20 + r * 0.15 + a * 0.15, 2) * 100 + 0.5) as bigint) as efficacy_index from m""")
def efficacy_index(spark, d):
    grades = groups(spark, d).filter("chunk_key is not null").select(
        "chunk_key", (F.length(F.coalesce("authoritative_answer", F.lit(""))) % 101).cast("double").alias("accuracy"),
        (F.size(F.coalesce("alternative_questions", F.array())) * 30).cast("double").alias("retention"),
    )
    means = evaluate.chapter_means(grades, "chunk_key", ["accuracy", "retention"])
    whole = means.withColumns({"dialogue_accuracy": F.col("accuracy"), "dialogue_depth": F.col("retention"), "book_accuracy": F.col("accuracy")})
    cents = lambda c: F.floor(F.col(c) * 100 + 0.5).cast("bigint").alias(c)
    return evaluate.efficacy_index(whole).select("chapters", cents("accuracy"), cents("retention"), cents("efficacy_index"))


@query(r"""with t as (select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) as n from documents),
k as (select doc_id, n, case when n <= 200 then 1 else cast(ceil((n - 200) / 150) as int) + 1 end as w from t where n > 0), e as (select doc_id, n, unnest(range(0, w)) as i from k),
b as (select doc_id, n, i, i * 150 as s, least(i * 150 + 200, n) as f from e)
select doc_id, cast(i as bigint) as window_no, cast(case when f = n and f - s < 80 then greatest(0, f - 80) else s end as bigint) as start, cast(f - case when f = n and f - s < 80 then greatest(0, f - 80) else s end as bigint) as length from b""")
def token_windows(spark, d):
    counted = table(spark, d, "documents").select("doc_id", F.size(windows.blank_tokens(F.col("text"))).alias("n"))
    each = counted.select("doc_id", F.posexplode(windows.window_bounds(F.col("n"), 200, 50, 80)).alias("window_no", "b"))
    return each.select("doc_id", F.col("window_no").cast("bigint"), F.col("b.start").cast("bigint").alias("start"), F.col("b.length").cast("bigint").alias("length"))


@query(r"""with recursive t as (select coalesce(site_id, '') as shard, doc_id, least(len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) + 1, 511) as n from documents),
o as (select shard, n, row_number() over (partition by shard order by doc_id) as i from t where n > 1),
p as (select shard, i, n, n as used, 0 as block from o where i = 1 union all
 select o.shard, o.i, o.n, case when p.used + o.n > 511 then o.n else p.used + o.n end, case when p.used + o.n > 511 then p.block + 1 else p.block end from p join o on o.shard = p.shard and o.i = p.i + 1)
select shard, cast(block as bigint) as block, count(*) as documents, cast(sum(n) as bigint) as tokens from p group by 1, 2""")
def token_pack(spark, d):
    counted = table(spark, d, "documents").select(F.coalesce("site_id", F.lit("")).alias("shard"), "doc_id", F.size(windows.blank_tokens(F.col("text"))).alias("n"))
    packed = windows.pack_in_order(counted, "shard", "doc_id", "n", 512, stretch=500)
    return packed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("documents"), F.sum("length").alias("tokens"))


@query(r"""select coalesce(lower(source), '-') as source, count(*) as documents, cast(sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> ''))) as bigint) as tokens from documents group by 1""")
def corpus_totals(spark, d):
    n = F.size(windows.blank_tokens(F.col("text")))
    return table(spark, d, "documents").groupBy(F.coalesce(F.lower("source"), F.lit("-")).alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum(n).cast("bigint").alias("tokens"))


@query()
def table_repair(spark, d):
    return pages(spark, d).select("block_id", tables.repair_tables(F.col("text")).alias("r")).select("block_id", "r.*")


@query()
def repair_totals(spark, d):
    return table_repair(spark, d).agg(*[F.sum(c).alias(c) for c in tables.STATS])


@query("""select group_id, '__VIEWSTATE' as name, 'state ' || group_id as value from qna_groups union all select group_id, 'ctl$day', case when group_id % 31 + 1 < 10 then '0' else '' end || (group_id % 31 + 1) from qna_groups
union all select group_id, '__EVENTTARGET', 'ctl$day' from qna_groups union all select group_id, '__EVENTARGUMENT', '' from qna_groups""")
def form_posts(spark, d):
    """What is posted to a form of one page: its own state, the control, and the option of the wanted day."""
    options = "".join(f"<option value='{i:02d}'>Day {i}</option>" for i in range(1, 32))
    page = F.concat(F.lit("<form><input type=hidden name='__VIEWSTATE' value='state "), F.col("group_id").cast("string"), F.lit(f"'><input name='__EVENTTARGET' value=''><select name='ctl$DAY'>{options}</select></form>"))
    read = groups(spark, d).select("group_id", html.form_state(page).alias("f"))
    day = F.concat(F.lit("0"), (F.col("group_id") % 31 + 1).cast("string"))
    value = nested.choose_option(F.transform(html.select_named(F.col("f.options"), "day"), lambda o: F.struct(o["value"].alias("value"), F.concat(o["value"], F.lit(".")).alias("text"))), F.right(day, F.lit(2)))
    post = html.form_post(F.col("f.fields"), F.lit("ctl$day"), F.create_map(F.lit("ctl$day"), value))
    return read.select("group_id", F.explode(post).alias("name", "value"))


@query("""with c as (select chunk_key, round(sum(cast(length(coalesce(authoritative_answer, '')) % 101 as double)) / count(*), 2) as a from qna_groups where chunk_key is not null group by 1)
select cast(1 as bigint) as line_no, '# Grades' as line union all select 2, '' union all select 3, '| chunk_key | accuracy |' union all select 4, '|---|---|'
union all select 4 + row_number() over (order by chunk_key), '| ' || chunk_key || ' | ' || printf('%.2f', a) || ' |' from c""")
def report_lines(spark, d):
    grades = groups(spark, d).filter("chunk_key is not null").select("chunk_key", (F.length(F.coalesce("authoritative_answer", F.lit(""))) % 101).cast("double").alias("accuracy"))
    return evaluate.report_lines(evaluate.chapter_means(grades, "chunk_key", ["accuracy"]), "chunk_key", ["accuracy"], "Grades")


@query("select group_id from qna_groups where not contains(lower(coalesce(exact_source_quote, '')), 'reference')")
def evaluated_chapters(spark, d):
    return quality.evaluated(groups(spark, d), "exact_source_quote").select("group_id")

def web_pages(spark, d):
    body = F.concat(
        F.lit("<html><body><p>Outside the form, and long enough to count</p><form name='aspnetForm'><script>var x = '<p>no</p>';</script><p>Release "), F.col("group_id").cast("string"),
        F.lit(" of the office, dated today</p><ul><li>short</li><li>Item&nbsp;number   "), F.col("group_id").cast("string"), F.lit(" of the published list</li></ul><a href='/PressReleasePage.aspx?PRID="),
        F.col("group_id").cast("string"), F.lit("'>Release</a><a href='/PressReleasePage.aspx?PRID="), F.col("group_id").cast("string"), F.lit("'>Again</a><a href='/about'>About</a></form></body></html>"),
    )
    return groups(spark, d).select("group_id", body.alias("html"))


@query("select group_id, 'Release ' || group_id || ' of the office, dated today' || chr(10) || 'Item number ' || group_id || ' of the published list' as article from qna_groups")
def html_article(spark, d):
    return web_pages(spark, d).select("group_id", html.article_text(F.col("html")).alias("article"))


@query("select group_id, 'Release' as heading, 'https://press.example/PressReleasePage.aspx?PRID=' || group_id as link from qna_groups")
def link_extract(spark, d):
    each = web_pages(spark, d).select("group_id", F.explode(html.release_links(F.col("html"), "https://press.example/")).alias("l"))
    return each.select("group_id", "l.heading", "l.link")


@query("select term_id, case when contains('all crops', lower(trim(kind))) then '0' when kind = 'pest' then '2' when kind = 'disease' then '3' else '0' end as value from canonical_terms")
def option_match(spark, d):
    option = lambda v, t: F.struct(F.lit(v).alias("value"), F.lit(t).alias("text"))
    options = F.array(option("0", "All crops"), option("2", "Pest control"), option("3", "Plant disease"))
    return table(spark, d, "canonical_terms").select("term_id", nested.choose_option(options, F.col("kind")).alias("value"))


@query("select cast(group_id as varchar) as key, 'Reply: ' || trim(alternative_questions[1]) as reply, 'ok' as status from qna_groups where length(trim(alternative_questions[1])) > 0")
def model_replies(spark, d):
    rows = groups(spark, d).filter(F.length(F.trim(F.col("alternative_questions")[0])) > 0)
    return complete(rows, "group_id", F.trim(F.col("alternative_questions")[0]), StubClient)


@query("select date_trunc('hour', ts) as hour, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
