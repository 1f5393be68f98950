"""Queries on the work of models, with offline clients whose replies SQL can tell."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.models import tasks
from granary.plans.registry import query
from granary.session import table


class Grader:
    """Grades by the length of the prompt's last line, in a fence; without JSON where that is a multiple of seven."""

    def complete(self, prompt: str) -> str:
        n = len(prompt.rpartition("\n")[2])
        if n % 7 == 0:
            return "no grade"
        names = next(line for line in prompt.split("\n") if line.startswith(("Grade", "Compare"))).partition(" JSON with ")[2].rstrip(".").split(", ") if " JSON with " in prompt else ["accuracy"]
        return "Here:\n```json\n{" + ", ".join(f'"{k}": {n % 100}' for k in names) + "}\n```"


class Examiner(Grader):
    """Asks two questions, and grades."""

    def complete(self, prompt: str) -> str:
        if prompt.startswith("Write"):
            return '[{"question_id": 1, "question": "what is first?"}, {"question_id": 2, "question": "what is next?"}]'
        return super().complete(prompt) if prompt.startswith("Grade") else "and then?"


class Candidate:
    """Answers a question by its length, in so many letters."""

    def complete(self, prompt: str) -> str:
        return "a" * (len(prompt) % 40)


class Captions:
    """Captions for the images of a prompt; fails where an image is named broken."""

    def complete(self, prompt: str) -> str:
        images = prompt.split("\n")[1:]
        if any("broken" in i for i in images):
            raise TimeoutError
        return "[" + ", ".join(f'" of {i} "' for i in images) + "]"


class Contents:
    """The table of contents of a book, by the number of pages that are shown."""

    def complete(self, prompt: str) -> str:
        if prompt.startswith("List the chapters"):
            lines = len(prompt.split("\n"))
            return '{"entries": [{"unique_key": "one", "title": "One", "start_page": 1, "topics": []}, {"unique_key": "two", "title": "Two", "start_page": %d, "topics": []}]}' % lines
        n = prompt.count("--- page ")
        return 'Found: {"title": "Book", "toc_pages": [1], "highest_printed_page": %d}' % n


class Rules:
    """One rule for each sample: its number of questions."""

    def complete(self, prompt: str) -> str:
        n = prompt.count("\n- ")
        return '{"prefixes": ["sir"], "canonical_replacements": {"n": "%d"}}' % n


def groups(spark, d):
    return table(spark, d, "qna_groups")


@query("""select group_id, cast(i as bigint) as at, case when group_id % 10 = 0 and i // 6 = 1 then '' else 'of img ' || group_id || ' ' || i end as caption
from qna_groups, unnest(range(0, 14)) r(i)""")
def image_captions(spark, d):
    """Fourteen images a row, six a call; of every tenth row the second call fails."""
    broken = (F.col("group_id") % 10 == 0)
    image = lambda i: F.concat(F.lit("img "), F.col("group_id").cast("string"), F.lit(" "), i.cast("string"), F.when(broken & (F.floor(i / 6) == 1), F.lit(" broken")).otherwise(F.lit("")))
    rows = groups(spark, d).dropDuplicates(["group_id"]).select("group_id", F.transform(F.sequence(F.lit(0), F.lit(13)), image).alias("images"))
    found = tasks.caption_images(rows, "group_id", "images", Captions)
    return found.select(F.col("key").cast("bigint").alias("group_id"), F.posexplode("captions").alias("at", "caption")).select("group_id", F.col("at").cast("bigint"), "caption")


_LAST = "length(split_part(coalesce(authoritative_answer, ''), chr(10), -1))"


@query(f"""select cast(group_id as varchar) as key, case when {_LAST} % 7 = 0 then 'unreadable' else 'ok' end as status, cast(case when {_LAST} % 7 <> 0 then {_LAST} % 100 else -1 end as bigint) as accuracy from qna_groups""")
def judge_verdicts(spark, d):
    found = tasks.verdicts(groups(spark, d), "group_id", F.col("exact_source_quote"), F.col("authoritative_answer"), Grader)
    return found.select("key", "status", F.coalesce(F.get_json_object("verdict", "$.accuracy").cast("bigint"), F.lit(-1)).alias("accuracy"))


@query("""select chunk_key as batch_file, 1 as prefixes, cast(count(*) as varchar) as n from (select distinct chunk_key, group_id from qna_groups where chunk_key is not null and group_id is not null) group by 1""")
def rule_discovery(spark, d):
    samples = groups(spark, d).filter("chunk_key is not null").groupBy("chunk_key").agg(F.collect_set(F.concat(F.lit("q"), F.col("group_id").cast("string"))).alias("questions"))
    found = tasks.discover_rules(samples, "chunk_key", "questions", Rules)
    return found.select("batch_file", F.size("prefixes").alias("prefixes"), F.element_at("canonical_replacements", "n").alias("n"))


@query(r"""with p as (select book_key as book, page_no, text from page_blocks where book_key is not null and text is not null), h as (select book, count(*) as n from p where page_no <= 15 and trim(text) <> '' group by 1),
r as (select book, string_agg(text, chr(10) order by page_no, text) as toc from p where page_no = 1 group by 1)
select h.book, 'ok' as status, 'Book' as title, cast(h.n as bigint) as highest_printed_page, cast(1 as bigint) as first_start, cast(3 + length(r.toc) - length(replace(r.toc, chr(10), '')) as bigint) as second_start from h join r on r.book = h.book""")
def toc_by_model(spark, d):
    pages = table(spark, d, "page_blocks").filter("book_key is not null and text is not null")
    found = tasks.detect_toc(pages, "book_key", "page_no", "text", Contents)
    entries = tasks.extract_toc(pages, found, "book_key", "page_no", "text", Contents).groupBy("book").agg(F.min("start_page").cast("bigint").alias("first_start"), F.max("start_page").cast("bigint").alias("second_start"))
    return found.join(entries, "book").select("book", "status", "title", F.col("highest_printed_page").cast("bigint"), "first_start", "second_start")


@query("""with c as (select chunk_key as chapter from qna_groups where chunk_key is not null group by 1), q as (select chapter, i, q, length(q) as n from c, (values (1, 'What is first?'), (2, 'What is next?')) v(i, q)),
g as (select *, 8 + n % 40 as l from q)
select chapter, i as question_id, q as question, cast(case when l % 7 = 0 then 70 else l % 100 end as bigint) as accuracy, cast(case when l % 7 = 0 then 80 else l % 100 end as bigint) as fluency,
cast(case when l % 7 = 0 then 70 else l % 100 end as bigint) as retention, case when l % 7 = 0 then 'fallback' else 'ok' end as status from g""")
def exam_grades(spark, d):
    chapters = groups(spark, d).filter("chunk_key is not null").groupBy(F.col("chunk_key").alias("chapter")).agg(F.max(F.lit("source")).alias("text"))
    found = tasks.exam(chapters, "chapter", "text", lambda q: q[:1].upper() + q[1:], Examiner, Candidate)
    whole = [F.col(c).cast("bigint") for c in ("accuracy", "fluency", "retention")]
    return found.select("chapter", "question_id", "question", *whole, "status")


@query("""select chunk_key as chapter, kind, cast(case when kind = 'book' then 80 else 75 end as bigint) as accuracy, cast(case when kind = 'book' then 85 else 80 end as bigint) as fluency,
cast(case when kind = 'book' then 80 else 75 end as bigint) as depth, 'failed: ValueError' as status, cast(6 as bigint) as turns from (select distinct chunk_key from qna_groups where chunk_key is not null), (values ('chapter'), ('book')) v(kind)""")
def dialogue_grades(spark, d):
    """Dialogues whose examiner fails to grade: the stated grades stand in."""
    chapters = groups(spark, d).filter("chunk_key is not null").groupBy(F.col("chunk_key").alias("chapter")).agg(F.max(F.lit("source")).alias("text"))
    held = lambda whole, kind: tasks.dialogue(chapters, "chapter", "text", Silent, Candidate, whole_book=whole).withColumn("kind", F.lit(kind))
    found = held(False, "chapter").unionByName(held(True, "book"))
    return found.select("chapter", "kind", *[F.col(c).cast("bigint") for c in ("accuracy", "fluency", "depth")], "status", F.size("transcript").cast("bigint").alias("turns"))


class Silent(Examiner):
    """Talks, and fails where it should grade."""

    def complete(self, prompt: str) -> str:
        if prompt.startswith("Grade"):
            raise ValueError
        return super().complete(prompt)
