"""Text functions against plain Python models."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import dates, hashing, text

ALPHABET = st.text(alphabet=st.sampled_from(list("abcXYZ .!?\n\t 12é कि-/%_()")), max_size=40)


def model_clean(value):
    if value is None:
        return ""
    value = re.sub(r"[\r\n\t]+|\s{2,}", " ", value.strip()).strip()
    value = unicodedata.normalize("NFC", value).lower()
    return re.sub(r"(?:^|[.!?]\s+)([a-z])", lambda m: m[0].upper(), value)


def apply(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(ALPHABET, min_size=40, max_size=40))
def test_clean_text_equals_model(spark, values):
    values = [*values, None, "", "a\n b. c", "  Décomposé é! ok"]
    assert [r[0] for r in apply(spark, values, text.clean_text(F.col("v")))] == [model_clean(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(ALPHABET, min_size=40, max_size=40))
def test_english_equals_model(spark, values):
    def model(v):
        letters = [c for c in v or "" if c.isalpha()]
        return bool(letters) and sum(c.isascii() for c in letters) / len(letters) >= 0.8

    values = [v for v in values if not any(unicodedata.category(c).startswith("M") for c in v)] + [None, "", "12", "abcdकखगघ", "abcdefghकख"]
    assert [r[0] for r in apply(spark, values, text.is_english(F.col("v")))] == [model(v) for v in values]


def test_scalar_functions(spark):
    values = ["How? to-do (now)!", None, "sir tell me", "```json\n{}\n```", 'a/b:c*"d"', "x" * 10]
    got = apply(
        spark, values, text.clean_punctuation(F.col("v")), text.strip_prefix(F.col("v"), ["sir", "sir tell"]), text.strip_fence(F.col("v")),
        text.safe_filename(F.col("v")), text.shorten(F.col("v"), 9),
    )
    assert got[0][0] == "How  to-do  now  " and got[1] == (None,) * 5
    assert got[2][1] == "me" and got[3][2] == "{}" and got[4][3] == "abcd" and got[5][4] == "x" * 9 + "..."


def test_replacements_feed_each_other_longest_first(spark):
    got = apply(spark, ["chillies and chilli", "a.b $x"], text.replace_terms(F.col("v"), {"chilli": "chili", "chillies": "chilli", "a.b": "$1"}))
    assert [r[0] for r in got] == ["chili and chili", "$1 $x"]


def test_many_rules_equal_the_fold(spark):
    import random

    rng = random.Random(3)
    words = ["ab", "cd", "ef", "gh", "(ij)", "kl"]
    rules = {" ".join(rng.choices(words, k=rng.randint(1, 3))): " ".join(rng.choices(words, k=rng.randint(1, 2))) for _ in range(60)}
    texts = [" ".join(rng.choices(words + ["x"], k=rng.randint(0, 12))) for _ in range(80)] + [None]
    folded = [r[0] for r in apply(spark, texts, text.replace_terms(F.col("v"), rules))]
    replacer = text.TermReplacer(sorted(rules.items(), key=lambda kv: -len(kv[0])))
    assert [replacer(t) for t in texts] == folded


def test_questions_and_pages(spark):
    got = apply(spark, ["according to the text, what is it?", "from the given chapter name two"], text.clean_question(F.col("v")))
    assert [r[0] for r in got] == ["What is it?", "Name two"]
    page = "Field Guide\n12\n\nProse 3 here\n FIELD guide again "
    assert apply(spark, [page], text.clean_page(F.col("v"), ["field guide"]))[0][0] == "Prose 3 here"


@pytest.mark.parametrize(
    ("created", "parts", "want"),
    [
        ("2024-01-05T10:00:00", (None,) * 3, "2024-01-05 10:00:00"), ("05/01/2024", (None,) * 3, "2024-01-05 00:00:00"), ("25-12-2023 07:30", (None,) * 3, "2023-12-25 07:30:00"),
        ("31/02/2024", ("2024", "2", "9"), "2024-02-09 00:00:00"), ("00/00/0000", ("2024", "13", "1"), ""), (None, ("", "1", "1"), ""), ("not noted", (None, None, None), ""),
    ],
)
def test_dates(spark, created, parts, want):
    df = spark.createDataFrame([(created, *parts)], "c string, y string, m string, d string")
    assert df.select(dates.call_date(F.col("c"), F.col("y"), F.col("m"), F.col("d"))).first()[0] == want


def test_hash_is_unsigned(spark):
    import hashlib
    import struct

    values = ["", "abc", "कपास", "x" * 100]
    got = [r[0] for r in apply(spark, values, hashing.md5_number(F.col("v")))]
    assert got == [str(struct.unpack("<Q", hashlib.md5(v.encode()).digest()[:8])[0]) for v in values]
    assert hashing.config_hash({"a": 1, "b": 2}) == hashing.config_hash({"b": 2, "a": 1})


def test_native_functions_need_no_python(spark):
    df = spark.createDataFrame([("a",)], "v string").select(text.clean_text(F.col("v"), composed=True), text.is_english(F.col("v")), text.clean_punctuation(F.col("v")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@settings(max_examples=5, deadline=None)
@given(st.lists(ALPHABET, min_size=40, max_size=40))
def test_sentence_case_equals_model(spark, values):
    values = [*values, None, "", "one.      two. three", "a", ".a", ". a?  b.c"]
    model = lambda v: v and re.sub(r"(?:^|[.!?]\s+)([a-z])", lambda m: m[0].upper(), v)
    assert [r[0] for r in apply(spark, values, text.sentence_case(F.col("v")))] == [model(v) for v in values]


def test_many_rules_equal_the_fold(spark):
    rules = {f"w{i}": f"w{i + 1}" if i % 3 else f"v {i}" for i in range(10_000)} | {"v 3": "three", "two words": "w5", "é": "e"}
    texts = ["w3 w4, w9999!", "two words w10x", None, "", "é é́ w1"]
    ordered = sorted(rules.items(), key=lambda kv: -len(kv[0]))

    def fold(value):
        for k, v in ordered:
            value = re.sub(rf"\b{re.escape(k)}\b", lambda _, v=v: v, value)
        return value

    got = [r[0] for r in apply(spark, texts, text.replace_terms(F.col("v"), rules))]
    assert got == [t if t is None else fold(t) for t in texts]


def test_many_prefixes(spark):
    listed = [f"p{i} " for i in range(10_000)] + ["p77 p7 ", "sir"]
    assert [r[0] for r in apply(spark, ["p77 p7  x", "p9999 y", "p10000 z", None, "sir"], text.strip_prefix(F.col("v"), listed))] == ["x", "y", "p10000 z", None, ""]
