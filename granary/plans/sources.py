"""Queries that read and write through sources, sinks and streams."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.functions.text import clean_chapter
from granary.operators.ids import with_row_ids
from granary.plans.calls import _CLEANED
from granary.plans.registry import query, sql_english
from granary.session import materialize, shared_dir, shared_path, table
from granary.sources import files
from granary.sources.paged import PageCheckpoint, PagedCsv, harvest, harvested
from granary.streaming.dedup import clean_stream, number_batches, read_stream, run_available

LIMIT = 1000
#: Pages in a file of a book at most.
PAGES = 1000
#: Folders over those of the books: more than the 32 up to which Spark lists folders in the driver.
SHELVES = 256
PAGE = "call_id string, querytext string, crop string"
_PAGED = "select cast(call_id as varchar) as call_id, coalesce(querytext, '') as querytext, coalesce(crop, '') as crop from kcc_calls"


def _pages(spark, d) -> str:
    """The call records as a paged service would give them: CSV pages of LIMIT rows, written by Spark."""
    numbered = with_row_ids(table(spark, d, "kcc_calls").select("call_id", "querytext", "crop"), ["call_id"], "at", start=0)
    path = shared_path(spark, "pages")
    kept = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    paged = numbered.withColumn("page", F.floor(F.col("at") / LIMIT)).repartition("page").sortWithinPartitions("page", "at").drop("at")
    paged.write.partitionBy("page").options(**kept).csv(path)
    return path


def _filled(df):
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


@query(_PAGED)
def paged_source(spark, d):
    spark.dataSource.register(PagedCsv)
    options = {"server": "granary.sources.paged.PageFolder", "path": _pages(spark, d), "total": table(spark, d, "kcc_calls").count(), "limit": LIMIT}
    return _filled(spark.read.format("paged_csv").schema(PAGE).options(**options).load())


@query(_PAGED.replace(" from", f", cast((row_number() over (order by call_id) - 1) // {5 * LIMIT} as bigint) as batch from"))
def harvest_pages(spark, d):
    """The service harvested five pages at a time, up to its short page, with a checkpoint behind each batch."""
    where = shared_path(spark, "harvest")
    options = {"server": "granary.sources.paged.PageFolder", "path": _pages(spark, d), "limit": LIMIT}
    harvest(spark, options, PAGE, f"{where}/rows", PageCheckpoint(spark, f"{where}/state.json", "calls"), pages=5)
    return harvested(spark, f"{where}/rows").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("call_id", "querytext", "crop")], F.col("batch").cast("bigint"))


@query(_PAGED)
def paged_stream(spark, d):
    """The service as a stream whose total is known: every page is read by a task of its own."""
    spark.dataSource.register(PagedCsv)
    where = shared_path(spark, "paged")
    options = {"server": "granary.sources.paged.PageFolder", "path": _pages(spark, d), "total": table(spark, d, "kcc_calls").count(), "limit": LIMIT}
    run_available(spark.readStream.format("paged_csv").schema(PAGE).options(**options).load(), f"{where}/out", f"{where}/state")
    return _filled(spark.read.schema(PAGE).parquet(f"{where}/out"))


@query("select count(*) as records from kcc_calls")
def csv_record_count(spark, d):
    path = shared_path(spark, "csv")
    files.write_csv(table(spark, d, "kcc_calls").select("call_id", "querytext", "kccans"), path)
    return files.read_csv(spark, path, ["call_id", "querytext"]).agg(F.count(F.lit(1)).alias("records"))


@query("select cast(call_id as varchar) as call_id, coalesce(querytext, '') as querytext, false as header_only from kcc_calls union all select '', '', true")
def csv_sink(spark, d):
    """Call texts written as CSV and read again; and a table without rows, which leaves its header."""
    full, empty = shared_path(spark, "csv"), shared_path(spark, "csv")
    rows = table(spark, d, "kcc_calls").select(F.col("call_id").cast("string"), "querytext")
    files.write_csv(rows, full)
    files.write_csv(rows.filter("false"), empty)
    head = spark.read.text(empty).filter(F.col("value") == '"call_id","querytext"').select(F.lit("").alias("call_id"), F.lit("").alias("querytext"), F.lit(True).alias("header_only"))
    return _filled(files.read_csv(spark, full)).withColumn("header_only", F.lit(False)).unionByName(head.limit(1))


@query(f"""with n as (select row_number() over (order by call_id) as i from kcc_calls), b as (select (i - 1) // {LIMIT} + 1 as batch_no, min(i) as a, max(i) as z, count(*) as n from n group by 1)
select cast(batch_no as bigint) as batch_no, cast(a as bigint) as first_row, cast(z as bigint) as last_row, n as n_rows, 'Batch ' || batch_no || ' Range (' || a || ' - ' || z || ').csv' as name, n as written from b""")
def batch_files(spark, d):
    path = shared_path(spark, "batches")
    named = files.write_batches(table(spark, d, "kcc_calls").select("call_id", "querytext"), ["call_id"], path, LIMIT)
    written = spark.read.csv(path, header=True, multiLine=True, escape='"').groupBy(F.col("batch").cast("bigint").alias("batch_no")).agg(F.count(F.lit(1)).alias("written"))
    return named.join(written, "batch_no").select("batch_no", F.col("first_row").cast("bigint"), F.col("last_row").cast("bigint"), "n_rows", "name", "written")


@query("""select book_key as book, cast(page_no as bigint) as page, text from page_blocks where text is not null and book_key is not null and not contains(text, chr(12))
qualify row_number() over (partition by book_key, page_no order by block_id) = 1""")
def page_loader(spark, d):
    """Books written as files of PAGES pages at most, form feeds behind their pages, and loaded page by page; a page that lacks is an empty one.

    The files are written row by row, so no book is held as a whole, and one with a tenth of all pages is many files. Folders have the
    digest of a book's name, which may be any string; a page without a number is a file of its own. The folders stand on SHELVES folders,
    each written by one task and listed by one task.
    """
    kept = table(spark, d, "page_blocks").filter("text is not null and book_key is not null and not contains(text, '\f')")
    page = F.col("page_no").cast("bigint")
    stretch = F.floor((page - 1) / PAGES)
    part = F.concat_ws("-", F.md5("book_key"), F.coalesce(stretch.cast("string"), F.lit("none")))
    rows = kept.select(F.col("book_key").alias("book"), page.alias("page"), part.alias("part"), F.coalesce(page - stretch * PAGES, F.lit(1)).cast("int").alias("at"), "block_id", "text")
    placed = rows.withColumn("shelf", F.pmod(F.hash("part"), F.lit(SHELVES))).repartition("shelf").groupBy("shelf", "part", "at", "book", "page")
    first = F.min(F.struct(F.col("block_id").isNull(), "block_id", "text"))["text"]
    lacking = F.col("at") - F.lag("at", 1, 0).over(Window.partitionBy("shelf", "part").orderBy("at")) - 1
    lines = placed.agg(first.alias("text")).withColumn("value", F.concat(F.repeat(F.lit("\f"), lacking), "text"))
    path = shared_path(spark, "books")
    lines.sortWithinPartitions("shelf", "part", "at").select("value", "shelf", "part").write.partitionBy("shelf", "part").option("lineSep", "\f").text(path)
    loaded = files.load_pages(spark, path).select(F.regexp_extract("path", "part=([^/]+)/", 1).alias("part"), F.col("page").alias("at"), "text")
    return loaded.join(placed.agg(F.lit(1)).select("part", "at", "book", "page"), ["part", "at"]).select("book", "page", "text")


@query("""select cast(group_id as varchar) as key, 'old' as version, coalesce(exact_source_quote, '') || chr(10) || chr(10) || chr(10) || chr(10) || 'end' as text from qna_groups
union all select cast(group_id as varchar), 'new', trim(coalesce(exact_source_quote, '') || chr(10) || chr(10) || 'end', ' ' || chr(10) || chr(9)) from qna_groups""")
def chapter_files(spark, d):
    """Chapters in JSON files cleaned in place, with what they were kept beside them."""
    path = shared_path(spark, "chapters")
    schema = "key string, text string"
    quoted = F.concat(F.coalesce("exact_source_quote", F.lit("")), F.lit("\n\n\n\nend"))
    table(spark, d, "qna_groups").select(F.col("group_id").cast("string").alias("key"), quoted.alias("text")).write.json(f"{path}/all")
    new = files.rewrite_chapters(spark, f"{path}/all", lambda df: df.withColumn("text", clean_chapter(F.col("text"))), schema)
    old = spark.read.schema(schema).json(f"{path}/all.before")
    return old.withColumn("version", F.lit("old")).unionByName(new.withColumn("version", F.lit("new")))


@query(f"select distinct question, 1 as n from ({_CLEANED}) where {sql_english('answer')}")
def stream_dedup(spark, d):
    """The stream's questions and how often each came; each comes once, whichever call it came with."""
    calls = table(spark, d, "kcc_calls").select("call_id", "querytext", "kccans")
    written = materialize(calls, "arrivals")
    where = f"{shared_dir(spark)}/granary-stream-{uuid.uuid4().hex}"
    source = os.path.dirname(written.inputFiles()[0])
    run_available(clean_stream(read_stream(spark, source, written.schema, files=4)), f"{where}/out", f"{where}/state")
    return spark.read.parquet(f"{where}/out").groupBy("question").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("select count(*) as n, cast(min(id) as bigint) as first_id, cast(max(id) as bigint) as last_id, count(distinct id) as ids from (select row_number() over (order by call_id) as id from kcc_calls)")
def stream_ids(spark, d):
    """Running ids over the batches of a stream."""
    written = materialize(table(spark, d, "kcc_calls").select("call_id").repartition(4), "arrivals")
    where = shared_path(spark, "ids")
    stream = read_stream(spark, os.path.dirname(written.inputFiles()[0]), written.schema, files=2)
    number_batches(stream, ["call_id"], f"{where}/out", f"{where}/state")
    found = spark.read.option("basePath", f"{where}/out").parquet(f"{where}/out")
    return found.agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("bigint").alias("first_id"), F.max("id").cast("bigint").alias("last_id"), F.count_distinct("id").alias("ids"))
