"""Work for generating models: what is pending, in which batches, and how replies fit their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.nested import ENVELOPE, GROUPS, MESSAGES, first_content, groups_json
from granary.functions.text import strip, strip_fence
from granary.operators.ids import with_row_ids

SKIPPED = "<SKIPPED_CHUNK>"


def fan_out(chapters: DataFrame, kinds: list[str], reference: Column, raw: str = "raw") -> DataFrame:
    """Each chapter with each kind of representation, reference chapters with the raw one only; chunk_id = key__kind."""
    listed = F.when(reference, F.array(F.lit(raw))).otherwise(F.array(*map(F.lit, dict.fromkeys([raw, *kinds]))))
    out = chapters.withColumn("kind", F.explode(listed))
    return out.withColumn("chunk_id", F.concat_ws("__", "key", "kind"))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The work whose key is not done yet."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def cached_captions(work: DataFrame, cache: DataFrame, key: str, images: str) -> DataFrame:
    """`work` with the cached captions of its key where there is one for each image, else null."""
    joined = work.join(cache.select(key, F.col("captions").alias("__captions")), key, "left")
    return joined.withColumn("captions", F.when(F.size("__captions") == F.col(images), F.col("__captions"))).drop("__captions")


def row_batches(df: DataFrame, order: list[str], size: int, fields: list[str]) -> DataFrame:
    """(batch_no, first_row, last_row, records): `size` rows at a time as a JSON array, numbered from 0 in the given order."""
    numbered = with_row_ids(df.select(*order, *fields), order, "__at", start=0)
    batch = F.floor(F.col("__at") / size)
    record = F.struct("__at", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("j"))
    grouped = numbered.groupBy(batch.alias("batch_no")).agg(F.min("__at").alias("first_row"), F.max("__at").alias("last_row"), F.array_sort(F.collect_list(record)).alias("__r"))
    joined = F.array_join(F.transform("__r", lambda r: r["j"]), ",")
    return grouped.select("batch_no", "first_row", "last_row", F.concat(F.lit("["), joined, F.lit("]")).alias("records"))


def format_chunk(text: Column, start: Column, size: int) -> Column:
    """A generated text as a block with header and end mark; a null, empty or skipped one as a skip."""
    head = F.concat(F.lit("=== BATCH_ROWS_"), start.cast("string"), F.lit("_TO_"), (start + size - 1).cast("string"), F.lit(" ==="))
    body = F.when(F.coalesce(text, F.lit("")).isin("") | F.upper(text).contains("SKIP"), F.lit(SKIPPED)).otherwise(text)
    return F.concat(head, F.lit("\n"), body, F.lit("\n<eos>\n\n"))


def blocks_of(content: DataFrame, file: str, text: str) -> DataFrame:
    """(file, chunk_index, block): the non-blank blocks of a generated file, numbered from 0, without their headers."""
    parts = F.filter(F.transform(F.split(text, "<eos>"), strip), lambda b: b != "")
    each = content.select(F.col(file).alias("file"), F.posexplode(parts).alias("chunk_index", "block"))
    return each.withColumn("block", strip(F.regexp_replace("block", r"^=== BATCH_ROWS_\d+_TO_\d+ ===\n?", "")))


def align_blocks(batches: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, chunk_index, records, block): source batches with the block of the same place; skipped ones left out."""
    return batches.join(blocks, ["file", "chunk_index"]).filter(F.col("block") != SKIPPED)


def flatten_replies(lines: DataFrame, column: str) -> DataFrame:
    """(key, question, answer) of batch results in any of the three shapes of groups; what can't be read gives no row."""
    parsed = lines.select(F.from_json(column, ENVELOPE).alias("e")).filter("e.error is null")
    text = F.col("e.response.candidates")[0]["content"]["parts"][0]["text"]
    groups = parsed.filter("size(e.response.candidates) > 0").select(F.col("e.key").alias("key"), F.from_json(groups_json(strip_fence(text)), GROUPS).alias("g"))
    each = groups.select("key", F.explode("g").alias("g"))
    single = F.when(F.coalesce("g.question", F.lit("")) != "", F.array("g.question")).otherwise(F.array().cast("array<string>"))
    answer = strip(F.coalesce("g.authoritative_answer", "g.answer"))
    one = F.transform(F.coalesce("g.alternative_questions", single), lambda q: F.struct(q.alias("question"), answer.alias("answer")))
    has_answer = F.col("g.authoritative_answer").isNotNull() | F.col("g.answer").isNotNull()
    pairs = each.select("key", F.explode(F.when(has_answer, one).otherwise(F.col("g.variations"))).alias("p"))
    bare = pairs.select("key", strip(F.col("p.question")).alias("question"), strip(F.col("p.answer")).alias("answer"))
    return bare.filter("question <> '' and answer <> ''")


def chat_pairs(lines: DataFrame, column: str, *keep: str) -> DataFrame:
    """(question, answer) of chat lines: the first user's and the first assistant's message; incomplete lines give no row."""
    messages = F.from_json(column, MESSAGES)["messages"]
    pairs = lines.select(*keep, first_content(messages, ("user",)).alias("question"), first_content(messages, ("assistant",)).alias("answer"))
    return pairs.filter("question is not null and answer is not null")


def judge_requests(pairs: DataFrame, prompt: Column, url: str) -> DataFrame:
    """(request): one JSON line for each aligned chunk, for a batch service."""
    body = F.struct(
        F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(prompt.alias("text"))).alias("parts"))).alias("contents"),
        F.struct(F.lit("application/json").alias("responseMimeType"), F.lit(0.1).alias("temperature")).alias("generationConfig"),
    )
    line = F.struct(F.concat(F.lit("chunk_"), F.col("chunk_index").cast("string")).alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body"))
    return pairs.select(F.to_json(line).alias("request"))
