"""Work that models do: captions, verdicts, rules, tables of contents, examinations and dialogues.

Every reply is parsed where the rows are; what fails or can't be read becomes a status and the stated default, not an exception.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.nested import caption_list, salvage_json
from granary.models import prompts
from granary.models.clients import ModelClient, call, complete

#: Images in one call.
IMAGES = 6
RULES = "struct<prefixes:array<string>,canonical_replacements:map<string,string>>"
FOUND = "struct<title:string,toc_pages:array<int>,highest_printed_page:int>"
ENTRIES = "struct<entries:array<struct<unique_key:string,title:string,start_page:int,topics:array<struct<title:string,start_page:int>>>>>"
#: The grades of a reply that can't be read.
EXAM = {"accuracy_score": 70, "fluency_score": 80, "factual_retention_score": 70}
DIALOGUE = {"chapter_accuracy": 75, "chapter_fluency": 80, "domain_depth": 75}
BOOK = {"overall_accuracy": 80, "overall_fluency": 85, "synthesis_and_reasoning": 80}

Make = Callable[[], ModelClient]


def caption_images(df: DataFrame, key: str, images: str, make: Make, size: int = IMAGES, threads: int = 4) -> DataFrame:
    """(key, captions): a caption for each image of a row, in order, `size` images a call; a call that fails leaves its captions blank.

    Null images are not sent and blank too; a null array counts as empty.
    """
    each = df.select(F.col(key).cast("string").alias("key"), F.posexplode_outer(images).alias("at", "image"))
    sent = each.filter("image is not null").groupBy("key", F.floor(F.col("at") / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("at", "image"))).alias("all"))
    named = sent.withColumn("call", F.concat_ws("#", "key", F.col("batch").cast("string")))
    replies = complete(named, "call", prompts.caption_prompt(F.col("all.image")), make, threads).select(F.col("key").alias("call"), "reply")
    told = named.join(replies, "call").select("key", F.arrays_zip(F.col("all.at").alias("at"), caption_list(F.coalesce("reply", F.lit("")), F.size("all")).alias("caption")).alias("pairs"))
    got = told.select("key", F.explode("pairs").alias("p")).select("key", "p.at", "p.caption")
    whole = each.join(got, ["key", "at"], "left").groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", F.coalesce("caption", F.lit("")).alias("caption"))))).alias("all"))
    return whole.select("key", F.col("all.caption").alias("captions"))


def verdicts(df: DataFrame, key: str, source: Column, output: Column, make: Make, threads: int = 4) -> DataFrame:
    """(key, status, verdict): a judge's JSON on each generated text; status is unreadable where a reply has none."""
    replies = complete(df, key, prompts.judge_prompt(source, output), make, threads)
    found = salvage_json(F.coalesce("reply", F.lit("")))
    status = F.when((F.col("status") == "ok") & found.isNull(), F.lit("unreadable")).otherwise(F.col("status"))
    return replies.select("key", status.alias("status"), found.alias("verdict"))


def discover_rules(samples: DataFrame, key: str, questions: str, make: Make, tries: int = 3) -> DataFrame:
    """(response_id, batch_file, prefixes, canonical_replacements) from one call for each sample of questions; failed ones give null rules."""
    replies = complete(samples, key, prompts.rules_prompt(F.col(questions)), make, tries=tries)
    parsed = F.from_json(salvage_json(F.coalesce("reply", F.lit(""))), RULES)
    return replies.select(F.xxhash64("key").alias("response_id"), F.col("key").alias("batch_file"), parsed["prefixes"].alias("prefixes"), parsed["canonical_replacements"].alias("canonical_replacements"))


def detect_toc(pages: DataFrame, book: str, page: str, text: str, make: Make, most: int = 15) -> DataFrame:
    """(book, status, title, toc_pages, highest_printed_page) by the first `most` pages of each book; blank pages are left out."""
    head = pages.filter((F.col(page) <= most) & (F.trim(F.coalesce(text, F.lit(""))) != ""))
    shown = F.concat(F.lit("--- page "), F.col(page).cast("string"), F.lit(" ---\n"), F.trim(text))
    scans = head.groupBy(F.col(book).alias("book")).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("at"), shown.alias("shown")))).alias("all"))
    replies = complete(scans, "book", prompts.toc_detect_prompt(F.array_join(F.col("all.shown"), "\n\n")), make)
    found = F.from_json(salvage_json(F.coalesce("reply", F.lit(""))), FOUND)
    return replies.select(F.col("key").alias("book"), "status", found["title"].alias("title"), found["toc_pages"].alias("toc_pages"), found["highest_printed_page"].alias("highest_printed_page"))


def extract_toc(pages: DataFrame, detected: DataFrame, book: str, page: str, text: str, make: Make) -> DataFrame:
    """(book, key, title, start_page, topics): the entries of the tables of contents that `detect_toc` found."""
    at = detected.select("book", F.explode("toc_pages").alias("at"))
    lines = pages.select(F.col(book).alias("book"), F.col(page).alias("at"), F.col(text).alias("text")).join(at, ["book", "at"])
    raw = lines.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n").alias("toc"))
    replies = complete(raw, "book", prompts.toc_extract_prompt(F.col("toc")), make)
    entries = F.from_json(salvage_json(F.coalesce("reply", F.lit(""))), ENTRIES)["entries"]
    return replies.select(F.col("key").alias("book"), F.explode(entries).alias("e")).select("book", F.col("e.unique_key").alias("key"), "e.title", "e.start_page", "e.topics")


def _read(reply: str | None):
    """The JSON of a reply: all of it, what its fence holds, or from the first bracket to the last; else None."""
    bare = (reply or "").strip()
    options = [bare]
    if "```" in bare:
        options.append(bare.split("```")[1].removeprefix("json").strip())
    starts = [i for i in (bare.find("{"), bare.find("[")) if i >= 0]
    if starts:
        options.append(bare[min(starts) : max(bare.rfind("}"), bare.rfind("]")) + 1])
    for option in options:
        try:
            return json.loads(option)
        except ValueError:
            continue
    return None


def _grades(client: ModelClient, prompt: str, defaults: dict[str, int]) -> tuple[dict[str, float], str]:
    """The named grades of a reply and ok; the defaults and what went wrong if it has none; a grade that lacks is 0."""
    reply, status = call(client, prompt)
    found = _read(reply)
    if not isinstance(found, dict):
        return {k: float(v) for k, v in defaults.items()}, "fallback" if status == "ok" else status
    number = lambda v: float(v) if isinstance(v, (int, float)) else 0.0
    return {k: number(found.get(k)) for k in defaults}, "ok"


def _rows(df: DataFrame, columns: list[Column], work: Callable[..., Iterator[dict]], schema: pa.Schema, ddl: str, makes: tuple[Make, Make]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examiner, candidate = (make() for make in makes)
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                yield pa.RecordBatch.from_pylist(list(work(examiner, candidate, *values)), schema=schema)

    return df.select(*columns).mapInArrow(run, ddl)


def exam(chapters: DataFrame, chapter: str, text: str, clean: Callable[[str], str], examiner: Make, candidate: Make, questions: int = 5) -> DataFrame:
    """(chapter, question_id, question, answer, accuracy, fluency, retention, status): the examiner asks, the candidate answers, the examiner grades.

    If no questions can be read, one on the chapter as a whole is asked; grades that can't be read are EXAM.
    """
    schema = pa.schema([("chapter", pa.string()), ("question_id", pa.int32()), ("question", pa.string()), ("answer", pa.string()), ("accuracy", pa.float64()), ("fluency", pa.float64()), ("retention", pa.float64()), ("status", pa.string())])

    def work(asks: ModelClient, answers: ModelClient, name: str, source: str) -> Iterator[dict]:
        listed = _read(call(asks, f"Write {questions} questions on facts and figures of this chapter, as a JSON list of objects with question. Do not mention the text.\n{name}\n{source}")[0])
        listed = [q for q in listed if isinstance(q, dict)] if isinstance(listed, list) else []
        for i, item in enumerate(listed or [{"question": f"What are the main findings and figures on {name}?"}], 1):
            question = clean(str(item.get("question", "")))
            answer, _ = call(answers, question)
            grades, status = _grades(asks, f"Grade the answer from 0 to 100 as JSON with {', '.join(EXAM)}.\n{source}\nQuestion: {question}\nAnswer: {answer or ''}", EXAM)
            accuracy, fluency, retention = grades.values()
            yield {"chapter": name, "question_id": i, "question": question, "answer": answer, "accuracy": accuracy, "fluency": fluency, "retention": retention, "status": status}

    ddl = "chapter string, question_id int, question string, answer string, accuracy double, fluency double, retention double, status string"
    return _rows(chapters, [F.col(chapter).cast("string"), F.coalesce(F.col(text), F.lit(""))], work, schema, ddl, (examiner, candidate))


def dialogue(chapters: DataFrame, chapter: str, text: str, examiner: Make, candidate: Make, turns: int = 3, whole_book: bool = False) -> DataFrame:
    """(chapter, accuracy, fluency, depth, status, transcript): a dialogue of `turns` answers and its grades, by DIALOGUE or, for a whole book, BOOK where they can't be read."""
    defaults = BOOK if whole_book else DIALOGUE
    turn = pa.struct([("role", pa.string()), ("content", pa.string())])
    schema = pa.schema([("chapter", pa.string()), ("accuracy", pa.float64()), ("fluency", pa.float64()), ("depth", pa.float64()), ("status", pa.string()), ("transcript", pa.list_(turn))])

    def work(asks: ModelClient, answers: ModelClient, name: str, source: str) -> Iterator[dict]:
        told: list[dict] = []
        shown = lambda: "\n".join(f"{t['role']}: {t['content']}" for t in told)
        for i in range(turns):
            request = f"Open a technical talk on {name} with one question." if i == 0 else f"Go on with one closer question.\n{source}\n{shown()}"
            told.append({"role": "examiner", "content": call(asks, request)[0] or ""})
            told.append({"role": "candidate", "content": call(answers, shown())[0] or ""})
        grades, status = _grades(asks, f"Grade the candidate from 0 to 100 as JSON with {', '.join(defaults)}.\n{source}\n{shown()}", defaults)
        accuracy, fluency, depth = grades.values()
        yield {"chapter": name, "accuracy": accuracy, "fluency": fluency, "depth": depth, "status": status, "transcript": told}

    ddl = "chapter string, accuracy double, fluency double, depth double, status string, transcript array<struct<role:string,content:string>>"
    return _rows(chapters, [F.col(chapter).cast("string"), F.coalesce(F.col(text), F.lit(""))], work, schema, ddl, (examiner, candidate))
