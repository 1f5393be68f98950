"""Operators on small tables with the awkward rows in them."""

import random
import unicodedata

from pyspark.sql import functions as F

from granary.functions import nested, tables
from granary.models import tasks
from granary.models.clients import HttpClient, StubClient, call, complete, filter_noise, provider_of
from granary.operators import chapters, clean, dedup, evaluate, generate, normalize, quality, rules, sampling, windows
from granary.operators.ids import with_row_ids


def test_row_ids_follow_the_order(spark):
    values = list(range(200))
    random.Random(1).shuffle(values)
    got = with_row_ids(spark.createDataFrame([(v,) for v in values], "v int"), ["v"]).orderBy("id").collect()
    assert [(r["v"], r["id"]) for r in got] == [(v, v + 1) for v in range(200)]
    assert with_row_ids(spark.createDataFrame([], "v int"), ["v"]).count() == 0


def test_clean_and_dedup_keeps_the_first(spark):
    rows = [("b", 1, "Same  q?", "answer one"), ("a", 2, "same q?", "answer two"), ("a", 1, None, "only answer"), ("c", 1, "q", "उत्तर")]
    df = spark.createDataFrame(rows, "file_name string, row_no long, querytext string, kccans string")
    for c in clean.REQUIRED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    got = [(r["id"], r["file_name"], r["question"]) for r in clean.clean_and_dedup(df).orderBy("id").collect()]
    assert got == [(1, "a", ""), (2, "a", "Same q?")]


def test_cleaning_composes_every_column_before_the_language_is_judged(spark):
    apart = lambda t: unicodedata.normalize("NFD", t)
    rows = [("a", 1, "one", apart("éèêëàâüö ok"), apart("Maïs")), ("a", 2, "two", "plain words", apart("Maïs"))]
    df = spark.createDataFrame(rows, "file_name string, row_no long, querytext string, kccans string, crop string")
    for c in clean.REQUIRED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(apart("Bénin")))
    got = clean.clean_and_dedup(df).collect()
    assert [(r["row_no"], r["crop"], r["district"], r["state"], r["block"]) for r in got] == [(2, "Maïs", "Bénin", "Bénin", "Bénin")]


def test_pairs_and_summary(spark):
    rows = [("f", 1, "q", "a"), ("f", 2, "q", "a"), ("f", 3, None, "a"), ("f", 4, None, "a"), ("f", 5, "q", "b")]
    df = spark.createDataFrame(rows, "f string, n int, q string, a string")
    assert [r["n"] for r in dedup.first_pairs(df, "f", "q", "a", "n").orderBy("n").collect()] == [1, 5]
    got = {r["file"]: (r["initial"], r["final"], r["removed"]) for r in dedup.dedup_summary(df, "f", "q", "a").collect()}
    assert got == {"f": (5, 2, 3), None: (5, 2, 3)}


def test_rules(spark):
    rows = [(1, ["Sir ", "x", "{bad}"], {"Dhaan": "paddy", "a": "A"}), (2, None, {"dhaan": "Rice"}), (3, [], {})]
    df = spark.createDataFrame(rows, "response_id long, prefixes array<string>, canonical_replacements map<string,string>")
    config = rules.rule_config(df)
    assert config.prefixes == ("sir",) and config.canonical_replacements == {"dhaan": "rice"}


def test_normalizer(spark):
    df = spark.createDataFrame([("1", "SIR dhaan   rate!"), ("2", None), ("3", "12 3"), ("4", "?!")], "id string, question string")
    config = rules.RuleConfig(("sir",), {"dhaan": "paddy"})
    got = {r["id"]: r for r in normalize.normalize(df, config, "now").collect()}
    assert got["1"]["normalized_question"] == "paddy rate" and got["1"]["is_valid"] and got["1"]["location"] is None
    assert got["2"]["validation_errors"] == ["empty_question", "too_short"]
    assert got["3"]["validation_errors"] == ["only_numbers"]
    assert got["1"]["changed_prefix"] and not got["3"]["changed_prefix"]
    totals = normalize.counters(normalize.normalize(df, config, "now")).first()
    assert (totals["rows_processed"], totals["rows_valid"], totals["rows_empty"]) == (4, 1, 2)


def test_density(spark):
    rows = [(None, "x"), ("1234 5678 90", "quant_fact_ledger"), ("plain words of prose here", None), ("a b c d e f g", "x"), ("word 123456 word words", "exam_bank_grounded")]
    df = spark.createDataFrame(rows, "t string, k string")
    assert [r[0] for r in df.select(quality.density(F.col("t"), F.col("k"))["reason"]).collect()] == ["empty_text", "alpha_ratio", "", "alpha_ratio", ""]


def test_unusable(spark):
    values = ["no_usable_data.", "x" * 299, "x" * 300, "no usable " + "x" * 400, "no usable " + "x" * 800, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(quality.is_unusable(F.col("v"))).collect()] == [True, True, False, True, False, True]


def model_windows(n, size, overlap, least):
    out, start = [], 0
    while start < n:
        end = min(start + size, n)
        first = max(0, end - least) if end == n and end - start < least else start
        out.append((first, end - first))
        if end == n:
            break
        start += size - overlap
    return out


def test_windows_equal_model(spark):
    counts = [0, 1, 79, 80, 199, 200, 201, 350, 351, 500, 1234]
    df = spark.createDataFrame([(n,) for n in counts], "n int").select("n", windows.window_bounds(F.col("n"), 200, 50, 80).alias("b"))
    assert {r["n"]: [tuple(x) for x in r["b"]] for r in df.collect()} == {n: model_windows(n, 200, 50, 80) for n in counts}


def test_packing_in_order(spark):
    sizes = [3, 0, 5, 20, 2, 2]
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate(sizes)], "shard string, ord long, n long")
    got = [(r["ord"], r["length"], r["block"]) for r in windows.pack_in_order(df, "shard", "ord", "n", 11).orderBy("ord").collect()]
    assert got == [(0, 4, 0), (2, 6, 0), (3, 10, 1), (4, 3, 2), (5, 3, 2)]


def test_chapter_bounds(spark):
    toc = spark.createDataFrame([("b", 4), ("b", 1), ("b", 9)], "book string, start_page int")
    got = chapters.chapter_bounds(toc, "book", "start_page", F.lit(12), F.lit(2)).orderBy("start_page").collect()
    assert [(r["first_page"], r["last_page"]) for r in got] == [(3, 5), (6, 10), (11, 14)]


def test_stride_sample(spark):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(10)], "n int, question string")
    assert [r["n"] for r in sampling.stride_sample(df, ["n"], 3).orderBy("n").collect()] == [0, 3, 6]
    assert sampling.stride_sample(df, ["n"], 50).count() == 10
    assert sampling.question_column(df) == "question"


def test_replies_in_three_shapes(spark):
    bodies = [
        '```json\n{"qna_groups":[{"authoritative_answer":" A ","alternative_questions":["q1",""," q2 "]}]}\n```',
        '{"qna_groups":[{"answer":"B","question":"q3"},{"variations":[{"question":"q4","answer":"C"},{"question":"","answer":"D"}]}]}',
        "no json",
    ]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "k string, b string")
    lines = df.select(nested.envelope(F.col("k"), F.col("b")).alias("line")).union(spark.createDataFrame([('{"key":"e","error":"x"}',), ("{",)], "line string"))
    assert sorted((r["question"], r["answer"]) for r in generate.flatten_replies(lines, "line").collect()) == [("q1", "A"), ("q2", "A"), ("q3", "B"), ("q4", "C")]


def test_json_salvage(spark):
    values = ['{"a":1}', 'x ```json\n[1]\n``` y', 'so {"a": {"b": 2}} it is', "none", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(nested.salvage_json(F.col("v"))).collect()] == ['{"a":1}', "[1]", '{"a": {"b": 2}}', None, None]


def test_figures(spark):
    image = "![x](data:image/png;base64,QUI=)"
    df = spark.createDataFrame([(f"a{image}b{image}", ["note"])], "t string, n array<string>")
    assert df.select(nested.interleave_figures(F.col("t"), F.col("n"))).first()[0] == "a\n[FIGURE 0: note]\nb\n[FIGURE 1: visual asset present in the original book page]\n"


def test_blocks(spark):
    df = spark.createDataFrame([(0, "good"), (10, "please Skip this"), (20, None)], "s long, t string")
    made = [r[0] for r in df.select(generate.format_chunk(F.col("t"), F.col("s"), 10)).collect()]
    assert made[0] == "=== BATCH_ROWS_0_TO_9 ===\ngood\n<eos>\n\n" and "<SKIPPED_CHUNK>" in made[1] and "<SKIPPED_CHUNK>" in made[2]
    content = spark.createDataFrame([("f", "".join(made))], "file string, t string")
    assert [(r["chunk_index"], r["block"]) for r in generate.blocks_of(content, "file", "t").orderBy("chunk_index").collect()] == [(0, "good"), (1, "<SKIPPED_CHUNK>"), (2, "<SKIPPED_CHUNK>")]


def test_models(spark):
    class Broken:
        def complete(self, prompt):
            raise TimeoutError

    assert call(Broken(), "x", tries=2) == (None, "failed: TimeoutError")
    assert provider_of("small:4b") == "ollama" and provider_of("large") == "google"
    df = spark.createDataFrame([("1", "a\nb"), ("2", None)], "k string, p string")
    assert [tuple(r) for r in complete(df, "k", F.col("p"), StubClient).orderBy("key").collect()] == [("1", "Reply: b", "ok"), ("2", "Reply: ", "ok")]
    asked = spark.createDataFrame([(1, "Market\nrate of rice"), (2, "pests"), (3, None)], "k int, q string")
    assert [tuple(r) for r in filter_noise(asked, "k", F.col("q")).orderBy("key").collect()] == [("1", "DISCARD"), ("2", "KEEP"), ("3", "KEEP")]
    assert {r["decision"] for r in filter_noise(asked, "k", F.col("q"), Broken).collect()} == {"KEEP"}


class Broken:
    def complete(self, prompt):
        raise OSError("400")


class Echo:
    """Replies with what the prompt ends with."""

    def complete(self, prompt):
        return prompt.rpartition("\n")[2]


def test_providers():
    seen = []
    replies = {"google": {"candidates": [{"content": {"parts": [{"text": "hi"}]}}]}, "anthropic": {"content": [{"text": "hi"}]}, "ollama": {"response": "hi"}}
    for provider in ("google", "openai", "anthropic", "nvidia", "vllm", "ollama"):
        client = HttpClient("m", provider, "k", send=lambda url, headers, body, p=provider: seen.append((url, headers, body)) or replies.get(p, {"choices": [{"message": {"content": "hi"}}]}))
        assert client.complete("ask") == "hi" and "ask" in str(seen[-1][2])
    assert len({url for url, _, _ in seen}) == 6 and provider_of("a:1") == "ollama"


def test_model_tasks_have_defaults(spark):
    df = spark.createDataFrame([("a", ["x", None, "y"]), ("b", []), ("c", None)], "k string, images array<string>")
    assert {r["key"]: r["captions"] for r in tasks.caption_images(df, "k", "images", Broken).collect()} == {"a": ["", "", ""], "b": [], "c": []}
    assert {r["key"]: r["captions"] for r in tasks.caption_images(df, "k", "images", Echo).collect()}["a"] == ["", "", ""]
    pairs = spark.createDataFrame([("1", "s", '{"verdict": "PASS"}'), ("2", "s", "prose"), ("3", None, None)], "k string, s string, o string")
    got = {r["key"]: (r["status"], r["verdict"]) for r in tasks.verdicts(pairs, "k", F.col("s"), F.col("o"), Echo).collect()}
    assert got["1"] == ("ok", '{"verdict": "PASS"}') and got["2"] == got["3"] == ("unreadable", None)
    assert tasks.verdicts(pairs, "k", F.col("s"), F.col("o"), Broken).filter("status = 'failed: OSError' and verdict is null").count() == 3
    samples = spark.createDataFrame([("f", ["sir q"]), ("g", None)], "k string, q array<string>")
    assert {(r["batch_file"], r["prefixes"]) for r in tasks.discover_rules(samples, "k", "q", Broken).collect()} == {("f", None), ("g", None)}
    chapters_ = spark.createDataFrame([("one", None)], "c string, t string")
    exam = tasks.exam(chapters_, "c", "t", str, Broken, Broken).first()
    assert (exam["accuracy"], exam["fluency"], exam["retention"], exam["answer"]) == (70, 80, 70, None) and "one" in exam["question"]
    book = tasks.dialogue(chapters_, "c", "t", Broken, Echo, turns=2, whole_book=True).first()
    assert (book["accuracy"], book["fluency"], book["depth"]) == (80, 85, 80) and len(book["transcript"]) == 4
    assert tasks.exam(chapters_.limit(0), "c", "t", str, Broken, Broken).count() == 0


def test_reply_lists_under_any_key(spark):
    rows = ['{"a": 1, "x": [{"n": 1}], "y": []}', '{"qna_groups": [], "x": [1]}', '{"a": {}}', "no json", None]
    got = [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string").orderBy("i").select(nested.groups_json(F.col("r"))).collect()]
    assert got == ['[{"n":1}]', "[]", None, None, None]


def test_packing_by_stretches_equals_one_pass(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.choice([0, 1, 3, 9, 20, 40])) for i in range(400)]
    df = spark.createDataFrame(rows, "shard string, ord long, n long")
    want = {}
    for shard in "ab":
        used = block = 0
        for s, i, n in rows:
            if s == shard and n:
                size = min(n + 1, 30)
                if used and used + size > 30:
                    used, block = 0, block + 1
                used += size
                want[i] = block
    assert {r["ord"]: r["block"] for r in windows.pack_in_order(df, "shard", "ord", "n", 31, stretch=37).collect()} == want


def test_training_steps():
    assert windows.training_steps(1000, 2, 4, 1, 0.1, 10) == {"batch_size": 2, "accumulation": 4, "steps": 125, "warmup_steps": 12, "logging_steps": 10}
    small = windows.training_steps(5, 4, 4, 2, 0.03, 10)
    assert small["batch_size"] == small["accumulation"] == 1 and small["steps"] == 10 and small["warmup_steps"] == 1 and small["logging_steps"] == 2


def test_transcripts_in_parts(spark):
    turns = spark.createDataFrame([("h", i, "user" if i % 2 else "model", None if i == 3 else f"t{i}") for i in range(7)] + [("k", 1, "user", "only")], "c string, n int, r string, t string")
    got = {(r["c"], r["part"]): (r["turns"], r["history"]) for r in evaluate.transcripts(turns, "c", "n", "r", "t", per_part=3).collect()}
    assert got == {("h", 0): (3, "model: t0\nuser: t1\nmodel: t2"), ("h", 1): (3, "user: \nmodel: t4\nuser: t5"), ("h", 2): (1, "model: t6"), ("k", 0): (1, "user: only")}


def test_decisions_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "q string")
    assert quality.split_decisions(df, F.lit("KEEP"), str(tmp_path / "d")) and not quality.split_decisions(df, F.lit("DISCARD"), str(tmp_path / "d"))
    assert sorted(x.name for x in (tmp_path / "d").glob("decision=*")) == ["decision=KEEP"]


def test_table_blocks():
    assert tables.repair_text("|![f](x.png)|\n|---|")["text"] == "![f](x.png)"
    ragged = tables.repair_text("before\n| a | b |\n|---|---|\n| 1 |\nafter")
    assert ragged["text"] == "before\nafter" and ragged["dropped_artifacts"] == 1
    good = tables.repair_text("| a | b |\n|---|---|\n| 1<br>2 | 3 |")
    assert "1; 2" in good["text"] and good["kept_tables"] == 1
    assert tables.repair_text("<br>\nprose")["text"] == "prose"


def test_flattened_tables():
    lines = ["Crop yield by zone", "- 1 North 1.5 2.5", "- 2 Far South 3.5", "4.5 5.5", "- 3 East 6 7", "Total 11 14.5", "Then the prose goes on. It has sentences, and it is not part of the table at all."]
    got = tables.repair_text("\n".join(lines))
    assert got["rebuilt_flattened"] == 1
    rows = got["text"].split("\n")
    assert rows[1] == "Crop yield by zone" and "| 1 | North | 1.5 | 2.5 |" in rows and "| 2 | Far South | 3.5 | 4.5 |" in rows and "|  | Total | 11 | 14.5 |" in rows
    assert rows[-1].startswith("Then the prose")
    bullets = "- 3 sacks of seed\n- 4 sacks of lime\n- 5 men"
    assert tables.repair_text(bullets)["text"] == bullets


def test_repair_handles_nulls(spark):
    df = spark.createDataFrame([(None,), ("",)], "t string").select(tables.repair_tables(F.col("t")).alias("r")).select("r.*").collect()
    assert df[0]["text"] is None and df[1]["text"] == ""
