"""Problems 1 to 3: canonical forms, copies, typed values and repeats."""

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import copies, history, mapping, slips
from granary.llm.canon import canonical


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("How to sow?", "how\tTO, sow!!", True), ("dose 2.5 ml", "Dose 2.5 ML", True), ("dose 2.5 ml", "dose 25 ml", False), ("dose 2. 5", "dose 2.5", False),
        ("Crop: rice; Village: X", "village = x | crop = rice", True), ("Crop: rice; Village: X", "crop rice village x", True), ("Crop: rice; Previous crop: X", "crop: x; previous crop: rice", False),
        ("Crop: a\nSoil: b\nStage: c", "STAGE - C\nSOIL - B\nCROP - A", True), ("a: b", "b: a", False), ("How to: sow; crop in: field", "how to sow crop in field", True),
        ("café", "CAFÉ", True), ("", "...", True), ("season: kharif; crop: rice; soil: red", "soil: red; crop: rice; season: kharif", True),
    ],
)
def test_canonical(a, b, same):
    assert (canonical(a) == canonical(b)) is same


def test_canonical_leaves_out_empty():
    assert canonical(None) is None and canonical(" ?! ") is None and canonical("́") is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=12), max_size=200), st.randoms())
def test_trie_counts(keys, rng):
    trie = copies.CountingTrie()
    want = {}
    for i, key in enumerate(keys + keys[:3] + [b"aaaaaaaa" + bytes([i]) for i in range(80)]):
        trie.add(key, 1, i)
        n, least = want.get(key, (0, i))
        want[key] = (n + 1, min(least, i))
    assert {k: (n, m) for k, n, m in trie.items()} == want


def questions(spark, rows):
    return spark.createDataFrame(rows, "call_id long, querytext string, batch_no int, keep_id string")


def test_copies_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "?", "hot question", "x" * 5000] + [f"how to grow {c} in {v}" for c in ("rice", "wheat") for v in range(20)]
    dress = [str.upper, str.title, lambda t: t.replace(" ", "  "), lambda t: t + "?", lambda t: unicodedata.normalize("NFD", t)]
    rows = [(i, t if t is None else rng.choice(dress)(t), 1, "clash") for i, t in enumerate(rng.choices(texts, k=600) + ["Hot question!"] * 400, 1)]
    rows.append((None, "hot question", 1, None))
    rows.append(rows[10])
    first, want = {}, set()
    for i, t, *_ in rows:
        key = canonical(t)
        if key is not None and i is not None:
            first[key] = min(first.get(key, i), i)
    want = {(first[canonical(t)], i) for i, t, *_ in rows if i is not None and canonical(t) is not None and first[canonical(t)] != i}
    df = questions(spark, rows)
    assert {tuple(r) for r in copies.find_copies(df).collect()} == want
    assert sum(r["copies"] for r in copies.collapse_copies(df).collect()) == sum(1 for i, t, *_ in rows if i is not None and canonical(t) is not None)


def test_forms_with_labels_of_their_own_collapse(spark):
    forms = [("Season: kharif; District: Pune; Seed: basmati", "district = PUNE | seed = Basmati | season = kharif"), ("मौसम: खरीफ; जिला: पुणे; बीज: धान", "जिला: पुणे; बीज: धान; मौसम: खरीफ")]
    prose = ["how: to sow, rice: in pune", "how to sow rice in pune", "district news for pune", "district office in pune", "Season: kharif; District: Pune; Seed: Basmati II", "note: one", "note: one"]
    rows = [(2 * i + k, t, 1, None) for i, pair in enumerate(forms) for k, t in enumerate(pair)] + [(100 + i, t, 1, None) for i, t in enumerate(prose)] + [(200 + i, f"how to sow {i}", 1, None) for i in range(20)]
    rows += [(300, "season kharif district pune seed basmati", 1, None)]
    assert {tuple(r) for r in copies.find_copies(questions(spark, rows)).collect()} == {(0, 1), (2, 3), (100, 101), (105, 106), (0, 300)}


def test_buckets_are_cut_until_they_fit(spark):
    keys = [f"how to control pest {i:04d}".encode() for i in range(500)] + [b"hot"] * 700
    keyed = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, id long")
    levels = copies.plan_buckets(keyed, len(keys), 50)
    assert [depth for depth, _ in levels][:3] == [4, 8, 16]
    sizes = keyed.filter("length(key) > 3").groupBy(copies.bucket_label(levels).alias("b")).count().collect()
    assert max(r["count"] for r in sizes) <= 50
    got = {bytes(r["key"]): r["copies"] for r in copies.count_copies(keyed, fits=50).collect()}
    assert got[b"hot"] == 700 and len(got) == 501


def test_copies_of_nothing(spark):
    assert copies.find_copies(questions(spark, [])).count() == 0


TERMS = [(1, "paddy", "crop", ["dhaan"]), (2, "sweet potato", "crop", None), (3, "potato", "crop", []), (4, "leaf folder", "pest", [None, "patta lapetak"]), (5, None, "crop", None)]


def terms(spark):
    return spark.createDataFrame(TERMS, "term_id long, term string, kind string, aliases array<string>")


@pytest.mark.parametrize(
    ("value", "term"),
    [("Paddy,", 1), ("pddy", 1), ("DHAAN - Paddy", 1), ("potatto", 3), ("potato, sweet", 2), ("sweetpotato", 2), ("1056-Potato", 3), ("hybrid potatoes", 3), ("fodder", 0), ("leaf folder", 0), ("9999", 0), ("??", 0)],
)
def test_mapping(spark, value, term):
    calls = spark.createDataFrame([(7, value, "clash")], "call_id long, crop string, term_id string")
    rules = spark.createDataFrame([], "response_id long, canonical_replacements map<string,string>")
    assert [tuple(r) for r in mapping.find_mapped(calls, rules, terms(spark)).collect()] == [("crop", 7, value, term)]


def test_mapping_edges(spark):
    calls = spark.createDataFrame([(1, None), (2, " "), (3, "paddy"), (4, "padddy"), (4, "padddy"), (5, "z" * 3000)], "call_id long, crop string")
    rules = spark.createDataFrame([(1, None), (2, {}), (3, {"a": "leaf foldr", "b": "leaf foldr", "c": "leaf folder", "d": None, "e": ""})], "response_id long, canonical_replacements map<string,string>")
    got = sorted(tuple(r) for r in mapping.find_mapped(calls, rules, terms(spark)).collect())
    assert got == [("crop", 4, "padddy", 1), ("crop", 4, "padddy", 1), ("crop", 5, "z" * 3000, 0), ("rule", 3, "", 0), ("rule", 3, "leaf foldr", 4)]


def test_similarity_join_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcde", k=rng.randint(2, 9))) for _ in range(60)]
    typed, listed = words[:40], words[40:]
    rank = {t: i for i, t in enumerate(sorted({p for w in listed for p in mapping.pairs_of(w)}))}
    side = lambda ws: spark.createDataFrame([(w,) for w in sorted(set(ws))], "form string")
    got = {(r["typed"], r["listed"]) for r in mapping.similar_forms(side(typed), side(listed), rank, True).collect()}
    jaccard = lambda a, b: len(set(mapping.pairs_of(a)) & set(mapping.pairs_of(b))) / len(set(mapping.pairs_of(a)) | set(mapping.pairs_of(b)))
    assert got == {(a, b) for a in typed for b in listed if jaccard(a, b) >= mapping.JACCARD}


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_slips_agree(a, b):
    far = slips.slip_distance(a, b, 100)
    assert far == 0 if a == b else far > 0
    assert slips.slips_within(a, b, 10) and (not slips.slips_within(a, b, 0)) == (a != b)


BASE = "how to control pod borer in paddy at harvest stage at lotheeta"
NEAR = ["madam I want ask how to control pod borer in paddy at harvest stage at Lotheeta", "at lotheeta how to controll pod borer in pady at harvest stage", "how control pod borer paddy at harvest stage at lotheeta ???"]
FAR = [BASE.replace("paddy", "wheat"), BASE.replace("pod", "stem"), BASE.replace("harvest", "nursery"), BASE.replace("lotheeta", "movakiree")]


def test_repeats(spark):
    filler = [(i, f"how to control {p} borer in {c} at {s} stage at {v}", 1) for i, (p, c, s, v) in enumerate(
        [(p, c, s, f"village{chr(97 + k)}{chr(97 + j)}ee") for k, p in enumerate(("pod", "stem")) for c in ("paddy", "wheat", "maize") for j, s in enumerate(("harvest", "nursery", "flowering"))] * 2, 100)]
    rows = [(1, BASE, 1), (2, BASE.upper(), 1), *[(10 + i, t, 2) for i, t in enumerate(NEAR)], *[(30 + i, t, 3) for i, t in enumerate(FAR)], (50, None, 3), (51, "?", 3), (None, BASE, 3)]
    rows += [(60, "is onion better after maize at vee", 2), (61, "is maize better after onion at vee", 3)]
    df = spark.createDataFrame([(i, t, b, "clash") for i, t, b in rows + filler], "call_id long, querytext string, batch_no int, accepted_id string")
    got = {tuple(r) for r in history.find_repeats(df).collect()}
    assert {x for x in got if x[1] < 100} == {(1, 10), (1, 11), (1, 12)}
    assert history.find_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [("dose urea paddy", "dose urea paddy", True), ("dose urea paddy sow", "dose paddy sow", True), ("dose urea paddy", "dose urea wheat", False),
     ("onion better after maize", "maize better after onion", False), ("crop: rice soil: red", "crop: rice", False), ("a b c d e f", "f e d c b a", False)],
)
def test_nearly_same(a, b, same):
    assert history.nearly_same(a.split(), b.split()) is same


def test_index_grows_by_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    fix = lambda w: (w, True)
    keys = [history.content_key(canonical(t), fix) for t in (BASE, "dose of urea for maize")]
    old = spark.createDataFrame([(1, *keys[0]), (2, *keys[1])], "first_call long, anchors string, content string")
    history.append_index(history.index_rows(old), path)
    fresh = history.index_rows(spark.createDataFrame([(9, *history.content_key(canonical(BASE + " urgent"), fix))], "first_call long, anchors string, content string"))
    found = history.probe(history.read_index(spark, path, fresh), fresh).collect()
    assert [tuple(r) for r in found] == [(9, 1)]
    history.append_index(fresh, path)
    assert history.read_index(spark, path).select("first_call").distinct().count() == 3


def test_chains_link_to_the_nearest_in_time(spark):
    chain = [(1, "v", "a b c d e f"), (2, "v", "a b c d e f g h"), (3, "v", "a b c d e f g h i j"), (4, "v", "a b c d e f g h i j k l")]
    index = history.index_rows(spark.createDataFrame(chain, "first_call long, anchors string, content string"))
    one_key = index.withColumn("band_key", index.band_key * 0)
    assert {tuple(r) for r in history.probe(one_key).collect()} == {(2, 1), (3, 2), (4, 2)}


@pytest.mark.parametrize("counts", [{}, {"a": 9, "b": 5, "c": 5, "d": 1}])
def test_probe_equals_brute_force(spark, counts):
    rng = random.Random(6)
    made = sorted({(rng.choice("xy"), " ".join(rng.choices("abcdefghijkl", k=rng.randint(0, 9)))) for _ in range(400)})
    rows = [(i, *row) for i, row in enumerate(made)]
    want = {}
    for i, anchors, content in rows:
        near = [j for j, a, c in rows[:i] if a == anchors and history.nearly_same(c.split(), content.split())]
        if near:
            want[i] = near[0]
    index = history.index_rows(spark.createDataFrame(rows, "first_call long, anchors string, content string"), counts)
    assert {r["first_call"]: r["target"] for r in history.probe(index).collect()} == want
    assert {r["first_call"]: r["target"] for r in history.probe(index, split=3).collect()} == want


def test_batches_go_through_the_stored_history(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = [(1, BASE, 1), (2, "dose of urea for maize", 1), (10, BASE + " urgent", 2), (11, "price of onion today", 2), (20, "at lotheeta how to control pod borer in paddy at harvest stage", 3), (21, "price of onion", 3), (22, "price onion", 3)]
    filler = [(0, w, 0) for w in (BASE, "dose of urea for maize", "price of onion today")]
    df = spark.createDataFrame([(i, t, b, None) for i, t, b in rows], "call_id long, querytext string, batch_no int, accepted_id string")
    history.start_history(history.canonical_calls(spark.createDataFrame(filler * 9, "call_id long, querytext string, batch_no int"), "call_id", "querytext", "batch_no"), path)
    keyed = lambda b: history.canonical_calls(df.filter(df.batch_no == b), "call_id", "querytext", "batch_no")
    step = lambda b: {tuple(r) for r in history.add_batches(keyed(b), path).collect()}
    assert step(1) == set() and step(2) == {(1, 10)}
    size = history.read_index(spark, f"{path}/index").count()
    assert step(2) == {(1, 10)} and history.read_index(spark, f"{path}/index").count() == size
    assert step(3) == {(1, 20), (11, 21), (11, 22)}
    assert {tuple(r) for r in history.find_repeats(df).collect()} == {(1, 10), (1, 20), (11, 21), (11, 22)}


def test_repeats_without_places_or_numbers(spark):
    """Recall and precision on questions that no rare word or number tells apart, against the questions they were made of."""
    rng = random.Random(12)
    crops, troubles, tools = "paddy wheat maize cotton onion".split(), "wilt blast smut aphid thrips".split(), "sprayer tiller planter".split()
    asked = [f"how to control {t} in {c}" for c in crops for t in troubles] + [f"subsidy on {m} for {c} growers" for c in crops for m in tools] + [f"which variety of {c} resists {t} best" for c in crops for t in troubles]
    noise = ["sir {}", "{} please tell me", "kindly {}", "{} urgent", "my {}", "{} ?"]

    def slip(text):
        words = text.split()
        at = rng.choice([i for i, w in enumerate(words) if len(w) >= 6])
        w, i = words[at], rng.randrange(1, len(words[at]) - 1)
        words[at] = rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + w[i] + w[i:], w[:i] + rng.choice("aeiou") + w[i + 1 :]])
        return " ".join(words)

    first = [(i, t, 1) for i, t in enumerate(asked)]
    again = [(1000 + j, rng.choice(noise).format(slip(t) if j % 2 else t), 2) for j, (_, t, _) in enumerate(first * 3)]
    df = spark.createDataFrame([(*r, None) for r in first + again], "call_id long, querytext string, batch_no int, accepted_id string")
    want = {(first[j % len(first)][0], i) for j, (i, _, _) in enumerate(again)}
    got = {tuple(r) for r in history.find_repeats(df).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)
