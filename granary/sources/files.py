"""Files in and out: CSV of unsure encoding, JSON lines, chapters, page files, and names of batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.ids import with_row_ids

ENCODINGS = ("utf-8", "utf-8-sig", "cp1252", "latin-1")
SNIFF = 1 << 16
#: Bytes of page files that a task reads, if the files are smaller.
TASK_BYTES = 16 << 20
_HELD = [i for i in range(0x80, 0xA0) if bytes([i]).decode("cp1252", "ignore")]
#: The characters of Latin-1 that stand for others in cp1252, and those.
WESTERN = (bytes(_HELD).decode("latin-1"), bytes(_HELD).decode("cp1252"))


def _encoding_of(head: bytes, cut: bool) -> str:
    for encoding in ENCODINGS:
        try:
            head.decode(encoding)
        except UnicodeDecodeError as e:
            if not cut or e.start < len(head) - 4:  # a character cut at the end is no error
                continue
        return "utf-8-sig" if encoding == "utf-8" and head.startswith(b"\xef\xbb\xbf") else encoding
    return "latin-1"


def detect_encoding(spark: SparkSession, path: str) -> str:
    """The first encoding in which the first bytes of a file, or of the first file of a folder, can be read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(conf)
    if system.getFileStatus(where).isDirectory():
        listed = sorted(str(f.getPath()) for f in system.listStatus(where) if f.isFile() and not f.getPath().getName().startswith(("_", ".")))
        if not listed:
            return "utf-8"
        where = jvm.org.apache.hadoop.fs.Path(listed[0])
    size = system.getFileStatus(where).getLen()
    stream = system.open(where)
    try:
        head = bytes(stream.readNBytes(SNIFF))
    finally:
        stream.close()
    return _encoding_of(head, size > SNIFF)


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None, encoding: str | None = None) -> DataFrame:
    """All columns as strings; records may have breaks in quotes; rows that don't fit the header are dropped.

    Without `encoding` it is told from the file's first bytes.
    """
    encoding = (encoding or detect_encoding(spark, path)).replace("utf-8-sig", "utf-8")
    western = encoding == "cp1252"  # Spark reads Latin-1 only, which has other characters in one range
    charset = "iso-8859-1" if western or encoding == "latin-1" else encoding
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', mode="DROPMALFORMED", encoding=charset)
    if western:
        df = df.select(*[F.translate(F.col(f"`{c}`"), *WESTERN).alias(c.translate(str.maketrans(*WESTERN))) for c in df.columns])
    missing = sorted(set(required or []) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def record_count(spark: SparkSession, path: str) -> int:
    return read_csv(spark, path).count()


def _by_number(path: str) -> tuple[int, str]:
    """Pages by the number in their file names, whatever the folder."""
    digits = "".join(ch if ch.isdigit() else " " for ch in path.rstrip("/").rsplit("/", 1)[-1]).split()
    return (int(digits[-1]) if digits else -1, path)


def combine(spark: SparkSession, paths: list[str], expected: int) -> DataFrame:
    """Pages of one table together; refused unless they have the expected number of records."""
    df = spark.read.csv(sorted(paths, key=_by_number), header=True, multiLine=True, escape='"')
    if (found := df.count()) != expected:
        raise ValueError(f"{found} records, not {expected}")
    return df


def batch_name(number: Column, first: Column, last: Column) -> Column:
    return F.concat(F.lit("Batch "), number.cast("string"), F.lit(" Range ("), first.cast("string"), F.lit(" - "), last.cast("string"), F.lit(").csv"))


def write_table(df: DataFrame, path: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; lines that are no JSON give rows of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, every field quoted and its blanks kept; a table without rows gives a file with nothing but the header."""
    kept = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**kept).csv(path)


def write_batches(df: DataFrame, order: list[str], path: str, size: int = 100_000) -> DataFrame:
    """CSV in batches of `size` rows in the given order, one file below batch=n; (batch_no, first_row, last_row, n_rows, name) of each, from 1."""
    numbered = with_row_ids(df, order, "__row")
    batched = numbered.withColumn("batch", F.floor((F.col("__row") - 1) / size) + 1)
    within = batched.repartition(F.col("batch")).sortWithinPartitions("batch", "__row").drop("__row")
    kept = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    within.write.mode("overwrite").partitionBy("batch").options(**kept).csv(path)
    sizes = batched.groupBy(F.col("batch").alias("batch_no")).agg(F.min("__row").alias("first_row"), F.max("__row").alias("last_row"), F.count(F.lit(1)).alias("n_rows"))
    return sizes.withColumn("name", batch_name(F.col("batch_no"), F.col("first_row"), F.col("last_row")))


def rewrite_chapters(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], schema: str, backup: str = ".before") -> DataFrame:
    """Chapters in a JSON folder replaced by what `change` makes of them; the first time, they are kept as they were beside it.

    The new chapters are written first and then put in the place of the old ones, so a failure leaves either.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, kept, new = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", backup, ".new"))
    system = old.getFileSystem(conf)
    spark.read.schema(schema).json(path).transform(change).write.mode("overwrite").json(str(new))
    if not system.exists(kept):
        system.rename(old, kept)
    else:
        system.delete(old, True)
    system.rename(new, old)
    return spark.read.schema(schema).json(path)


def load_dataset(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """JSON lines for training; refused without rows or without the field."""
    df = spark.read.json(path)
    if field not in df.columns:
        raise ValueError(f"no field {field}")
    if df.isEmpty():
        raise ValueError("no rows")
    return df


def form_feed_pages(data: bytes) -> list[str]:
    """The pages of a plain text that has form feeds between them."""
    return data.decode("utf-8", "replace").split("\f")


def load_pages(spark: SparkSession, path: str, extract: Callable[[bytes], list[str]] = form_feed_pages) -> DataFrame:
    """(path, page, text): the pages of each file from 1, by an extractor of the file's format."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts = extract(data)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(texts), pa.string()), pa.array(range(1, len(texts) + 1), pa.int32()), pa.array(texts, pa.string())], names=["path", "page", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    # Spark takes a small file for one of 4 MB, so thousands would be as many short tasks.
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = files.coalesce(max(4 * spark.sparkContext.defaultParallelism, size // TASK_BYTES))
    return files.mapInArrow(run, "path string, page int, text string")


def first_pages(pages: DataFrame, page: str, most: int = 15) -> DataFrame:
    return pages.filter(F.col(page) <= most)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file as a whole, in any file system that the session knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
    system = final.getFileSystem(conf)
    stream = system.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.hsync()
    stream.close()
    system.delete(final, False)
    system.rename(new, final)


def get_text(spark: SparkSession, path: str) -> str | None:
    """What `put_text` wrote, also if it ended between its last two steps; null if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for end in ("", ".new"):
        where = jvm.org.apache.hadoop.fs.Path(path + end)
        system = where.getFileSystem(conf)
        if system.exists(where):
            stream = system.open(where)
            try:
                return bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
    return None


def write_sidecar(row: DataFrame, path: str) -> dict:
    """The only row of a table of counters as a JSON file beside the data."""
    found = row.first().asDict()
    put_text(row.sparkSession, path, json.dumps(found, default=str))
    return found


class Progress:
    """The last finished batch of a run, which counts only for the same input and configuration."""

    def __init__(self, spark: SparkSession, path: str, file_hash: str, config_hash: str) -> None:
        self.spark, self.path, self.key = spark, path, {"file_hash": file_hash, "config_hash": config_hash}

    def last(self) -> int:
        """0 without a file, with one that can't be read, or after a change of input or configuration."""
        try:
            state = json.loads(get_text(self.spark, self.path) or "{}")
        except ValueError:
            return 0
        return int(state.get("last_batch", 0)) if {k: state.get(k) for k in self.key} == self.key else 0

    def save(self, batch: int) -> None:
        put_text(self.spark, self.path, json.dumps({**self.key, "last_batch": batch}))


def report(summary: dict) -> str:
    """A small summary as a Markdown table."""
    return "\n".join(["| Measure | Value |", "|---|---|", *(f"| {k} | {v} |" for k, v in summary.items())]) + "\n"
