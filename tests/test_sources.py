"""Sources, checkpoints and streams."""

import csv

import pytest
from pyspark.sql import functions as F

from granary.functions import html
from granary.plans.sources import page_loader
from granary.sources import files
from granary.sources.files import combine, detect_encoding, read_csv, report
from granary.sources.paged import PageCheckpoint, PagedCsv, fetch, harvest, harvested, records_of
from granary.streaming.dedup import clean_stream, event_counts, number_batches, read_stream, run_available


@pytest.fixture
def terms(tmp_path):
    path = tmp_path / "terms.csv"
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([["id", "name"], *[[i, f"line {i}\nbroken"] for i in range(25)]])
    return str(path)


def test_pages(spark, terms):
    spark.dataSource.register(PagedCsv)
    df = spark.read.format("paged_csv").schema("id string, name string").options(path=terms, total=25, limit=10).load()
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3
    assert df.filter("name like '%broken'").count() == 25


def test_paged_stream(spark, terms, tmp_path):
    spark.dataSource.register(PagedCsv)
    stream = spark.readStream.format("paged_csv").schema("id string, name string").options(path=terms, limit=10).load()
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).select("id").distinct().count() == 25


def test_record_count():
    assert len(records_of('a,b\n1,"x\ny"\n\n2,z\n')) == 2


def test_fetch_tries_again():
    class Flaky:
        n = 0

        def page(self, offset, limit):
            self.n += 1
            if self.n < 3:
                raise ConnectionError
            return "a\n1\n"

    assert fetch(Flaky(), 0, 10, wait=0) == [["1"]]


def test_checkpoint(spark, tmp_path):
    point = PageCheckpoint(spark, str(tmp_path / "c.json"), "d")
    state = point.advance(point.load(), 10, 10)
    state = point.advance(state, 10, 4)
    assert point.load() == state and state["next_offset"] == 20 and state["rows"] == 14 and state["done"]
    with pytest.raises(ValueError, match="checkpoint"):
        PageCheckpoint(spark, str(tmp_path / "c.json"), "other").load()


def test_csv(spark, terms, tmp_path):
    assert read_csv(spark, terms, ["id"]).count() == 25
    with pytest.raises(ValueError, match="missing"):
        read_csv(spark, terms, ["absent"])
    with pytest.raises(ValueError, match="records"):
        combine(spark, [terms], 24)
    odd = tmp_path / "odd.csv"
    odd.write_bytes("name\ncafé “€”\n".encode("cp1252"))
    assert detect_encoding(spark, str(odd)) == "cp1252" and detect_encoding(spark, terms) == "utf-8"
    assert [r[0] for r in read_csv(spark, str(odd)).collect()] == ["café “€”"]
    assert "| a | 1 |" in report({"a": 1})


def test_articles(spark):
    page = "<html><body><p>Long enough to be kept&nbsp;  as text</p><ul><li>short<li>This item is open and long enough</ul><footer><p>A footer that is long enough</p></footer></body></html>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(html.article_text(F.col("h")))
    assert [r[0] for r in df.collect()] == ["Long enough to be kept as text\nThis item is open and long enough", None, ""]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "Q one", "fine answer"), (2, "q  one", "other answer"), (3, "q two", "उत्तर"), (4, None, "an answer"), (5, "", "again an answer")]
    df = spark.createDataFrame(rows, "call_id long, querytext string, kccans string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        run_available(clean_stream(read_stream(spark, str(tmp_path / "in"), df.schema)), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["question"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["", "Q one"]


def test_event_counts(spark):
    events = spark.createDataFrame([("2024-01-01 10:05:00", "a"), ("2024-01-01 10:50:00", "a"), ("2024-01-01 11:00:00", "b")], "t string, event_type string")
    got = event_counts(events.select(F.to_timestamp("t").alias("ts"), "event_type")).collect()
    assert sorted(r["n"] for r in got) == [1, 2]


def test_harvest_goes_on_behind_its_checkpoint(spark, terms, tmp_path):
    options, path, point = {"path": terms, "limit": "4"}, str(tmp_path / "rows"), PageCheckpoint(spark, str(tmp_path / "c.json"), "terms")
    point.advance(point.load(), 8, 8)  # as if a first batch of two pages were there
    state = harvest(spark, options, "id string, name string", path, point, pages=2)
    assert state["done"] and state["next_offset"] == 32 and state["rows"] == 25
    assert sorted(int(r["id"]) for r in harvested(spark, path).collect()) == list(range(8, 25))
    assert harvest(spark, options, "id string, name string", path, point, pages=2) == state


def test_files_in_and_out(spark, tmp_path):
    rows = spark.createDataFrame([(i, f" a\n\"{i}\" ") for i in range(25)] + [(99, None)], "i int, t string")
    files.write_csv(rows, str(tmp_path / "full"))
    assert {r["t"] for r in read_csv(spark, str(tmp_path / "full"), ["i"]).collect()} >= {" a\n\"3\" ", None}
    files.write_csv(rows.filter("false"), str(tmp_path / "none"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "none")).collect()] == ['"i","t"'] and read_csv(spark, str(tmp_path / "none")).count() == 0
    named = files.write_batches(rows, ["i"], str(tmp_path / "batches"), 10).orderBy("batch_no").collect()
    assert [(r["first_row"], r["last_row"], r["name"]) for r in named][-1] == (21, 26, "Batch 3 Range (21 - 26).csv")
    assert len(list((tmp_path / "batches" / "batch=1").glob("*.csv"))) == 1
    for i in range(2):
        spark.createDataFrame([("k", "text")], "key string, text string").write.mode("overwrite").json(str(tmp_path / "c")) if not i else None
        got = files.rewrite_chapters(spark, str(tmp_path / "c"), lambda df: df.withColumn("text", F.concat("text", F.lit("!"))), "key string, text string")
    assert got.first()["text"] == "text!!" and spark.read.json(str(tmp_path / "c.before")).first()["text"] == "text"
    with pytest.raises(ValueError, match="field"):
        files.load_dataset(spark, str(tmp_path / "c"), "absent")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.txt").write_bytes("one\ftwo\f".encode())
    assert [(r["page"], r["text"]) for r in files.load_pages(spark, str(tmp_path / "b")).orderBy("page").collect()] == [(1, "one"), (2, "two"), (3, "")]
    paths = []
    for i, folder in ((2, "a"), (10, "a"), (1, "longer-folder")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"page{i}.csv").write_text(f"n\n{i}\n")
        paths.append(str(tmp_path / folder / f"page{i}.csv"))
    assert sorted(paths, key=files._by_number) == [paths[2], paths[0], paths[1]] and combine(spark, paths, 3).count() == 3


def test_progress_counts_for_the_same_input_only(spark, tmp_path):
    path = str(tmp_path / "p.json")
    files.Progress(spark, path, "f", "c").save(7)
    assert files.Progress(spark, path, "f", "c").last() == 7 and files.Progress(spark, path, "f", "d").last() == 0
    files.put_text(spark, path, "{")
    assert files.Progress(spark, path, "f", "c").last() == 0 and files.Progress(spark, str(tmp_path / "q"), "f", "c").last() == 0


def test_ids_run_on_over_batches(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([(i * 10 + j,) for j in range(5)], "v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: read_stream(spark, str(tmp_path / "in"), "v int")
    number_batches(stream(), ["v"], str(tmp_path / "out"), str(tmp_path / "state"))
    spark.createDataFrame([(100,)], "v int").write.mode("append").parquet(str(tmp_path / "in"))
    number_batches(stream(), ["v"], str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 22)) and got[-1]["v"] == 100


def test_forms(spark):
    page = "<input name=a value=1><input value=x><select name='ctl$Month'><option value=01>January</option><option value=2>Feb &amp; on</select><select name=other><option>z</option></select>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(html.form_state(F.col("h")).alias("f"))
    got = df.select("f.fields", html.select_named(F.col("f.options"), "MONTH").alias("o"), html.form_post(F.col("f.fields"), F.lit("t"), F.create_map(F.lit("a"), F.lit("9"))).alias("p")).collect()
    assert got[0]["fields"] == {"a": "1"} and [(o["value"], o["text"]) for o in got[0]["o"]] == [("01", "January"), ("2", "Feb & on")]
    assert got[0]["p"] == {"__EVENTTARGET": "t", "__EVENTARGUMENT": "", "a": "9"} and got[1]["fields"] is None and got[2]["fields"] == {}


def test_books_of_any_name_and_length(spark, tmp_path):
    last = 2**31 - 1
    rows = [(1, "a", 1, "one"), (2, "a", 3, ""), (3, "a", 3, "again"), (4, "a", 1001, "next file"), (5, "a", last, "far"), (6, "a", 0, "nought"), (7, "a", -1, "before"), (8, "a", None, "no number")]
    rows += [(9, "b/c=ü %2F", 2, "line\nline"), (10, "", 1, "no name"), (None, "d", 1, "later"), (11, "d", 1, "first"), (12, "d", 2, None), (13, "d", 3, "two\fpages"), (14, None, 1, "x")]
    spark.createDataFrame(rows, "block_id long, book_key string, page_no int, text string").write.parquet(str(tmp_path / "page_blocks.parquet"))
    got = {tuple(r) for r in page_loader(spark, str(tmp_path)).collect()}
    assert got == {(b, p, t) for i, b, p, t in rows if i not in (3, 12, 13, 14, None)}
    spark.createDataFrame([], "block_id long, book_key string, page_no int, text string").write.parquet(str(tmp_path / "none" / "page_blocks.parquet"))
    assert page_loader(spark, str(tmp_path / "none")).count() == 0


def test_small_files_are_read_together(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}.txt").write_bytes(b"one\ftwo")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 22)
    try:
        pages = files.load_pages(spark, str(tmp_path))
        assert pages.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and pages.count() == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
