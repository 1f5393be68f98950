"""A paged CSV service as a Spark data source, one input partition for each page.

`page(offset, limit)` of a page server gives CSV text with a header; a short page ends the data. The servers of this module
serve a CSV file, or a folder with a file for each page; another one is passed by its import path.
"""

from __future__ import annotations

import csv
import importlib
import io
import json
import time
from collections.abc import Iterator

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from granary.sources.files import get_text, put_text


class FileServer:
    """Serves the records of a CSV file in pages."""

    def __init__(self, path: str) -> None:
        self.path = path

    def page(self, offset: int, limit: int) -> str:
        with open(self.path, newline="", encoding="utf-8") as lines:
            rows = list(csv.reader(lines))
        out = io.StringIO()
        csv.writer(out).writerows([rows[0], *[r for r in rows[1:] if r][offset : offset + limit]] if rows else [])
        return out.getvalue()


class PageFolder:
    """Serves pages that lie below page=n, all of the size that is asked for; any file system that pyarrow knows."""

    def __init__(self, path: str) -> None:
        self.path = path

    def page(self, offset: int, limit: int) -> str:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path)
        where = f"{root}/page={offset // limit}"
        if system.get_file_info(where).type != fs.FileType.Directory:
            return ""
        files = sorted(f.path for f in system.get_file_info(fs.FileSelector(where)) if f.base_name.endswith(".csv"))
        out = []
        for i, name in enumerate(files):
            with system.open_input_stream(name) as data:
                text = data.readall().decode()
            out.append(text if i == 0 else text.partition("\n")[2])
        return "".join(out)


def records_of(page: str) -> list[list[str]]:
    """The records of a page: quoted breaks belong to a record, blank rows and the header do not count."""
    rows = [r for r in csv.reader(io.StringIO(page)) if any(c.strip() for c in r)]
    return rows[1:]


def fetch(server, offset: int, limit: int, tries: int = 5, wait: float = 0.5) -> list[list[str]]:
    """A page's records; failures are tried again after growing waits, or after what the failure asks for."""
    for attempt in range(tries):
        try:
            return records_of(server.page(offset, limit))
        except Exception as e:  # noqa: BLE001
            if attempt + 1 == tries:
                raise
            time.sleep(getattr(e, "retry_after", None) or wait * 2**attempt)
    raise AssertionError("unreachable")


def server_of(options) -> object:
    where = options.get("server", "granary.sources.paged.FileServer")
    module, _, name = where.rpartition(".")
    return getattr(importlib.import_module(module), name)(options["path"])


class _Page(InputPartition):
    def __init__(self, offset: int, limit: int) -> None:
        super().__init__(offset)
        self.offset, self.limit = offset, limit


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options) -> None:
        self.width, self.options = len(schema), dict(options)

    def partitions(self) -> list[InputPartition]:
        total, limit = int(self.options["total"]), int(self.options.get("limit", 5000))
        return [_Page(at, limit) for at in range(int(self.options.get("offset", 0)), total, limit)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        server = server_of(self.options)
        for row in fetch(server, partition.offset, partition.limit):
            yield tuple((row + [None] * self.width)[: self.width])


class _StreamReader(SimpleDataSourceStreamReader):
    """One page a batch; the offset advances by the limit that was asked for."""

    def __init__(self, schema: StructType, options) -> None:
        self.width, self.options = len(schema), dict(options)

    def initialOffset(self) -> dict:
        return {"offset": int(self.options.get("offset", 0))}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        limit = int(self.options.get("limit", 5000))
        if start.get("done"):
            return iter([]), start
        rows = fetch(server_of(self.options), start["offset"], limit)
        end = {"offset": start["offset"] + limit, "done": len(rows) < limit}
        return iter([tuple((r + [None] * self.width)[: self.width]) for r in rows]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        limit = int(self.options.get("limit", 5000))
        server = server_of(self.options)
        for at in range(start["offset"], end["offset"], limit):
            for row in fetch(server, at, limit):
                yield tuple((row + [None] * self.width)[: self.width])


class _PagesStreamReader(DataSourceStreamReader):
    """All pages up to a known total, each read by a task of its own."""

    def __init__(self, schema: StructType, options) -> None:
        self.batch = _Reader(schema, options)

    def initialOffset(self) -> dict:
        return {"offset": int(self.batch.options.get("offset", 0))}

    def latestOffset(self) -> dict:
        return {"offset": int(self.batch.options["total"])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        limit = int(self.batch.options.get("limit", 5000))
        return [_Page(at, limit) for at in range(start["offset"], end["offset"], limit)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        return self.batch.read(partition)


class PagedCsv(DataSource):
    """spark.read.format("paged_csv").schema(...).options(path=, total=, limit=).load(); as a stream the total may be unknown,
    and one page is then read at a time until a short one comes."""

    @classmethod
    def name(cls) -> str:
        return "paged_csv"

    def schema(self) -> str:
        raise ValueError("paged_csv needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if "total" not in self.options:
            raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED", messageParameters={"feature": "streamReader"})
        return _PagesStreamReader(schema, self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _StreamReader(schema, self.options)


class PageCheckpoint:
    """The next offset of a harvest, replaced as a whole, refused for another dataset; older files get the defaults."""

    DEFAULTS = {"next_offset": 0, "rows": 0, "dataset": None, "done": False}

    def __init__(self, spark: SparkSession, path: str, dataset: str) -> None:
        self.spark, self.path, self.dataset = spark, path, dataset

    def load(self) -> dict:
        state = dict(self.DEFAULTS) | json.loads(get_text(self.spark, self.path) or "{}")
        if state["dataset"] not in (None, self.dataset):
            raise ValueError(f"checkpoint of {state['dataset']}, not of {self.dataset}")
        return state | {"dataset": self.dataset}

    def advance(self, state: dict, asked: int, got: int) -> dict:
        """After a page: the offset grows by what was asked for; a short page ends the data."""
        state = state | {"next_offset": state["next_offset"] + asked, "rows": state["rows"] + got, "done": got < asked}
        put_text(self.spark, self.path, json.dumps(state))
        return state


def harvest(spark: SparkSession, options: dict[str, str], schema: str, path: str, checkpoint: PageCheckpoint, pages: int = 100) -> dict:
    """All pages of a service appended to a table below batch=n, `pages` at a time and read in parallel, until a short page.

    After each batch the checkpoint moves on, and a run that is started again goes on behind it; a batch that was written and
    not yet noted is written again in its place.
    """
    spark.dataSource.register(PagedCsv)
    state, limit = checkpoint.load(), int(options.get("limit", 5000))
    while not state["done"]:
        asked = pages * limit
        read = spark.read.format("paged_csv").schema(schema).options(**options, offset=state["next_offset"], total=state["next_offset"] + asked).load()
        where = f"{path}/batch={state['next_offset'] // asked}"
        read.write.mode("overwrite").parquet(where)
        state = checkpoint.advance(state, asked, spark.read.parquet(where).count())
    return state


def harvested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn("batch", F.col("batch").cast("int"))
