"""Problems 4 to 9 on small tables with the awkward rows in them."""

import numpy as np
import pytest

from granary.llm import language, mixing, packing, pairs, scans, stuffing, tokens

SAYINGS = {
    "en": ["Keep the bunds free of weeds and release natural enemies in the evening.", "Apply urea in two equal doses at the flowering stage.", "Light rain is expected, so delay the irrigation of the field.", "Remove the plants that are affected and burn them away from the plot."],
    "hi": ["सड़ी हुई गोबर की खाद डालने से जड़ें मजबूत होती हैं और उपज बढ़ती है।", "खेत की मेड़ों को साफ रखें ताकि कीड़े दोबारा न फैलें।", "अगले दिनों तक बारिश की संभावना है इसलिए दवा का प्रयोग अभी न करें।"],
    "mr": ["पुढील दिवस पावसाची शक्यता आहे म्हणून सध्या औषध मारू नका.", "कुजलेले शेणखत घातल्याने मुळे मजबूत होतात आणि उत्पादन वाढते.", "रोगट झाडे उपटून शेताबाहेर खड्ड्यात पुरून टाकावीत."],
    "ta": ["அடுத்த நாட்களுக்கு மழை பெய்யும் என்பதால் இப்போது மருந்து அடிக்க வேண்டாம்.", "வரப்புகளை சுத்தமாக வைத்தால் பூச்சி தாக்குதல் குறையும்."],
}


@pytest.fixture(scope="module")
def model():
    return language.train_language_model([(k, s) for k, v in SAYINGS.items() for s in v])


def test_segments(model):
    en, hi, ta = SAYINGS["en"], SAYINGS["hi"], SAYINGS["ta"]
    langs = lambda t: [k for k, _ in model.segments(t)]
    assert langs(" ".join(en)) == ["en"]
    assert langs(f"{en[0]} {hi[0]} {en[1]}") == ["en", "hi", "en"]
    assert langs(f"{hi[1]}\n{ta[0]}") == ["hi", "ta"]
    assert langs(f"{en[0]} [பஞ்சகவ்யம்]") == ["en"]
    assert langs(hi[0].replace("गोबर", "Varnol EC")) == ["hi"]
    assert langs(f"{en[0][:-1]} {hi[0]}") == ["en", "hi"]
    assert langs("12 34 ...") == [] and model.segments("") == []
    assert len(langs((en[0] + " ") * 3000)) == 1


def test_confidence_is_a_probability(model):
    for text in ("urea", "खेत", SAYINGS["mr"][0]):
        assert 0 <= model.whole(text)[1] <= 1
    assert model.whole("123") is None


def test_romanised():
    assert language.romanise("कपास", 0)[0] == "k" and language.romanise("abc") == "abc"


def test_held_out_accuracy(model):
    told = [("hi", "खाद डालने से उपज बढ़ती है"), ("mr", "शेणखत घातल्याने उत्पादन वाढते"), ("en", "release the natural enemies of the field"), ("ta", "மழை பெய்யும் இப்போது மருந்து")]
    assert np.mean([model.whole(t)[0] == k for k, t in told]) == 1


def test_labels(spark, model):
    rows = [("1", "EN-in", SAYINGS["en"][0]), ("2", None, SAYINGS["hi"][0]), ("3", "und", SAYINGS["en"][1]), ("4", "en", SAYINGS["ta"][0]), ("5", "hi", None), ("6", "hi", "12"), (None, "hi", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id string, language string, original_question string, lang string")
    assert {(r["record_id"], r["lang"]) for r in language.relabelled(df, model).collect()} == {(2, "hi"), (3, "en"), (4, "ta")}
    assert language.relabelled(df.limit(0), model).count() == 0


def test_untrained():
    bare = language.train_language_model([])
    assert bare.segments("any text") and bare.whole("any text")


FULL = "Lift the crop when the lower leaves have dried. Cure it for {} days in an airy shade, then grade it by size."
Q = ["When do I lift my crop?", "What curing period is advised?"]
GROUPS = [
    (1, Q, FULL.format(4)), (2, Q, FULL.format(7)[:-1]), (3, Q, FULL.format(9)[:62]), (4, Q, None), (5, Q, " N/A. "), (6, Q, "<p></p>"), (7, Q, "You asked: when do I lift my crop"), (8, Q, Q[0] + " " + FULL.format(3)),
    (9, Q, "Sorry, I don't know the answer to this. Please ask the block office."), (10, Q, "Sorry plots need beds first. " + FULL.format(2)), (11, Q, "अगले दिनों तक बारिश की संभावना है इसलिए दवा का प्रयोग अभी न करें।"),
    (12, Q, FULL.format(5).replace("crop", "crop (कपास)")), (13, None, FULL.format(6)), (14, [], "..."), (15, Q, FULL.format(8)[:70] + "…"), (16, Q, "It cannot be treated once the crop has matured, so no spray is available after that stage."),
    (None, Q, None), (1, Q, FULL.format(4)),
]


def test_pairs(spark, model):
    df = spark.createDataFrame([(*g, None, "clash") for g in GROUPS], "group_id long, alternative_questions array<string>, authoritative_answer string, exact_source_quote string, defect string")
    got = sorted(tuple(r) for r in pairs.judge_pairs(df, model).collect())
    assert got == [
        (3, "truncated_answer"), (4, "empty_answer"), (5, "empty_answer"), (6, "empty_answer"), (7, "copied_question"), (9, "refusal"), (11, "other_language"), (14, "empty_answer"), (15, "truncated_answer"),
    ]
    assert pairs.judge_pairs(df.limit(0), model).count() == 0


#: Ways to decline that none of the listed patterns was made from, and sound answers with the same words.
REFUSED = ["I have no idea about that.", "We regret that we cannot guide you here.", "That topic is outside my remit.", "I'd rather not say.", "No comment.", "I am not sure what to tell you about urea.", "Our desk is unable to assist with this query.", "Sorry, I have nothing to say on the dose of urea for wheat.", "I must decline.", "It is not possible for me to say anything on this matter.", "Unfortunately we lack the information.", "This request can't be handled by our assistant, it has no knowledge of it.", "I don't feel competent to comment on wheat.", "We are sorry, but there is nothing we can suggest here.", "My apologies, I am not equipped to respond to it.", "I cannot be of help with that question.", "मुझे इसके बारे में कोई जानकारी नहीं है।", "हम इस सवाल का जवाब देने की स्थिति में नहीं हैं।", "माफ़ कीजिए, मैं आपकी मदद नहीं कर सकता।", "मला याबद्दल काहीच माहिती नाही.", "আমি এই বিষয়ে কিছু জানি না, সাহায্য করতে পারছি না।", "என்னால் இதற்கு பதில் சொல்ல முடியாது.", "અમને આ વિશે કોઈ ખબર નથી.", "ਮੈਨੂੰ ਇਸ ਬਾਰੇ ਪਤਾ ਨਹੀਂ।", "నాకు దీని గురించి తెలియదు, సమాధానం చెప్పలేను."]
SOUND = ["We do not advise spraying at noon.", "Do not irrigate before the rain.", "It cannot be treated once the crop has matured, so no spray is available after that stage.", "No, the seed needs no treatment.", "Never mix copper with urea; the leaves burn.", "I know a dose of 2 kg suits it, not more.", "Sorry plots need beds first.", "No spray is needed if the count is low.", "Urea is not sold without a record of the holding.", "The variety is not known to resist wilt.", "हम दोपहर में छिड़काव की सलाह नहीं देते, शाम को करें।", "बारिश से पहले सिंचाई न करें।", "No advice is needed on dry soil: wait for rain.", "Growers report that help arrives within two days."]


def test_refusals_in_other_words():
    asked = ["What dose of urea suits wheat on 2 acre?", "How much urea for wheat?"]
    assert sum(pairs.is_refusal(t, asked) for t in REFUSED) >= 0.9 * len(REFUSED)
    assert sum(pairs.is_refusal(t, asked) for t in SOUND) <= 0.1 * len(SOUND)
    assert not pairs.is_refusal("I cannot say. " + "Spray neem oil in the evening and repeat after ten days. " * 200, asked)


def test_shortened_fragments_across_partitions(spark):
    sentences = [f"{c}{d} and the rest of it" for c in "abcdefgh" for d in "xyz"]
    parts = [s[:4] for s in sentences[::2]] + ["zz", sentences[1]]
    got = pairs.shortened_fragments(spark.createDataFrame([(p,) for p in parts], "fragment string"), spark.createDataFrame([(s,) for s in sentences], "text string"))
    want = {p for p in parts if any(s.startswith(p) and s != p for s in sentences) and p not in sentences}
    assert {r["fragment"] for r in got.collect()} == want


PROSE = "the farmers keep the bunds free of weeds and release natural enemies in the evening while the weather stays dry under open conditions"


def book(noise):
    words = PROSE.split()
    out = []
    for page in range(1, 13):
        lines = [" ".join(words[i : i + 6]) for i in range(0, len(words), 6)] * 4
        head = "Guide of Dryland Tillage" if page % 2 else f"{page}    Leaf Diseases"
        if page == 4:
            head = "4    Lcaf Diseases"
        body = ["Chapter 1: Leaf Diseases", "", *lines] if page == 1 else [head, *lines]
        out.append((page, "b", page, "\n".join([*noise.get(page, lambda b: b)(body), "", f"- {page} -"])))
    return out


def test_scans(spark):
    noise = {
        3: lambda b: [*b[:2], b[2].replace("weeds", "we€ds"), *b[3:]],
        5: lambda b: [*b[:-1], "release natural ene-"], 6: lambda b: [b[0], "mies in the evening", *b[1:]],
        7: lambda b: [b[0], "keep the far¬", "mers free of rain-", "fed weeds", *b[1:]],
        8: lambda b: [b[0], "Z5 farmers use rain-fed land, rain-fed bunds and rain-fed weeds", *b[1:]],
        9: lambda b: [*b, "| Plot | Crop | Yield |"],
    }
    extra = [(99 + i, "c", i, "the farmers on rain-fed land keep weeds and rain-fed bunds free") for i in range(1, 8)] + [(200, "d", 1, None), (201, None, None, ""), (None, "d", 2, "x")]
    df = spark.createDataFrame([(*r, "clash") for r in book(noise) + extra], "block_id long, book_key string, page_no int, text string, noise_kind string")
    got = {tuple(r) for r in scans.find_noise(df).collect()}
    lines = {r[0]: r[3].split("\n") for r in book(noise)}
    at = lambda page, start: next(i for i, x in enumerate(lines[page], 1) if x.startswith(start))
    numbers = {(p, len(lines[p]), "page_number") for p in lines}
    heads = {(p, 1, "running_header") for p in lines if p > 1}
    want = {(5, len(lines[5]) - 2, "split_word"), (7, at(7, "keep the far"), "split_word"), (8, at(8, "Z5"), "misread")}
    assert numbers | heads | want <= got
    rest = got - numbers - heads - want
    assert {k for k in rest if k[2] != "misread"} == set()
    assert scans.find_noise(df.limit(0)).count() == 0


def test_repaired_paragraphs(spark):
    noise = {
        3: lambda b: [*b[:2], b[2].replace("dry", "dry."), "", *b[3:]],
        5: lambda b: [*b[:-1], "release natural ene-"], 6: lambda b: [b[0], "mies in the evening.", "", "Z5 farmers keep the far¬", "mers free of rain-", "fed weeds.", "", "| Plot | Crop |", "", *b[1:]],
    }
    extra = [(99 + i, "c", i, "the farmers on rain-fed land keep weeds and rain-fed bunds free.") for i in range(1, 8)] + [(200, "d", 1, None), (201, None, None, " \n"), (None, "d", 2, "x"), (300, "c", 1, "scanned twice")]
    df = spark.createDataFrame([(*r, "clash") for r in book(noise) + extra], "block_id long, book_key string, page_no int, text string, paragraph_no string")
    got = {(r["book_key"], r["paragraph_no"]): (r["block_id"], r["text"]) for r in scans.repair_pages(df).collect()}
    texts = [got["b", i][1] for i in range(1, max(n for b, n in got if b == "b") + 1)]
    assert texts[0] == "Chapter 1: Leaf Diseases" and "Tillage" not in "".join(texts[1:]) and "Diseases" not in "".join(texts[1:])
    assert any(t.endswith("release natural enemies in the evening.") for t in texts)
    assert "25 farmers keep the farmers free of rain-fed weeds." in texts and "| Plot | Crop |" in texts
    assert sorted(n for b, n in got if b == "c") == list(range(1, 8)) and {b for b, _ in got} == {"b", "c"}
    assert scans.repair_pages(df.limit(0)).count() == 0


def test_editor_reads_by_learnt_confusions():
    counts = {w: 100 for w in PROSE.split()} | {"number": 100, "office": 90}
    odd = ["we€ds", "fre€", "w€ath€r", "€vening", "stay5", "bund5", "cond1tions", "re1ease", "re1eas€", "natura1", "na+ural", "wea+her"] * 3
    editor = scans.train_editor(counts, {"rain-fed": 50}, odd)
    assert editor.read("farm€rs") == ("farmers", (4,)) and editor.read("re1€ase")[0] == "release"
    assert editor.read("farmers") is None and editor.read("Z5")[0] == "25" and editor.read("unheard") is None
    assert editor.joins("far", "-", "mers") and not editor.joins("rain", "-", "fed")


def test_editor_inserts_and_deletes_by_what_it_learnt():
    words = "fertiliser nitrogen potassium irrigation cultivation harvesting germination transplanting laboratory committee district advisory".split()
    counts = {w: 100 for w in [*PROSE.split(), *words]}
    odd = [w[:i] + "~" + w[i:] for w in words for i in (2, 4, 6)] + [w[:i] + w[i + 1 :] for w in words for i in range(1, len(w) - 1) if w[i] == "i"]
    editor = scans.train_editor(counts, {}, odd)
    assert ("", "i") in editor.options[""] and ("~", "") in editor.options["~"]
    assert editor.read("wea~ther") == ("weather", (3,)) and editor.read("condtions")[0] == "conditions" and editor.read("wether") is None
    assert editor.read("x" * 500) is None and editor.read("con~d~itions" + "y" * 60) is None


def test_readings_are_found_by_any_number_of_changes():
    editor = scans.Editor({"hill" * 8: 9, "hi": 9}, {}, {}, {"!": [("!", "i"), ("!", "l")], "l": [("l", "i")], "1": [("1", "l"), ("1", "i")]})
    assert editor.read("h!!1" * 8)[0] == "hill" * 8


def test_ends_of_lines():
    counts = {w: 100 for w in PROSE.split()} | {"rainfed": 40, "presowing": 3}
    compounds = {"rain-fed": 60, "rain-fed fields": 55, "pre-sowing": 30, "pre-sowing check": 30, "long-term": 20}
    editor = scans.train_editor(counts, compounds, ["we€ds", "fre€", "w€ath€r", "€vening"] * 3)
    assert editor.joins("far", "-", "mers") and editor.joins("wea", "¬", "ther") and editor.joins("w€a", "-", "ther")
    assert not editor.joins("rain", "-", "fed", "fields") and editor.joins("rain", "-", "fed", "conditions") and not editor.joins("long", "-", "term")
    assert not editor.joins("natural", "-", "weeds") and editor.joins("Sep", "-", "tember")


def test_page_numbers():
    good = ["- 13 -", "14", "[7]", "Page 12", "xiv", "39 / lO5", "- lO -"]
    assert all(map(scans.is_page_number, good))
    assert not any(map(scans.is_page_number, ["353 kg", "- 1 Maize 12.38", "early one.", "", "Weeds", "in 1994 we sowed the field"]))


@pytest.mark.parametrize(("histogram", "capacity"), [({3: 10, 5: 10, 7: 4}, 10), ({1: 1}, 4), ({4: 3}, 4), ({}, 5), ({9: 50, 1: 20, 2: 30}, 10), ({k: 7 for k in range(1, 100)}, 100)])
def test_packing(histogram, capacity):
    filled = packing.fill_containers(dict(histogram), capacity)
    used = {}
    for lengths, times in filled:
        assert 0 < sum(lengths) <= capacity and times > 0
        for s in lengths:
            used[s] = used.get(s, 0) + times
    assert used == histogram
    least = -(-sum(s * n for s, n in histogram.items()) // capacity)
    assert sum(t for _, t in filled) <= least * 1.15 + 1


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes, prices, most = rng.integers(1, 8, 4), rng.random(4), rng.integers(0, 4, 4)
        got = packing.best_configuration(sizes, prices, most, 15)
        best = max(float(np.dot(c, prices)) for c in np.ndindex(*(most + 1)) if np.dot(c, sizes) <= 15)
        assert np.dot(got, sizes) <= 15 and (got <= most).all() and abs(np.dot(got, prices) - best) < 1e-9


def documents(spark, rows):
    return spark.createDataFrame([(*r, "en", "clash") for r in rows], "doc_id long, text string, source string, lang string, container_no string")


def test_pack_documents(spark):
    rows = [(i, "word " * (i % 9 + 1), "A_b" if i % 2 else "a-b ") for i in range(60)] + [(100, "long " * 95, "a b"), (101, "", "a_b"), (102, None, "a_b"), (103, "other words", None), (None, "x", "a_b")]
    plans = spark.createDataFrame([(1, 10, "a_B"), (2, 40, None), (3, 0, None), (4, 10, "absent")], "plan_id long, capacity_tokens int, only_source string")
    packed = packing.pack_documents(documents(spark, rows), plans).cache()
    by_container = {}
    for r in packed.collect():
        by_container.setdefault((r["plan_id"], r["container_no"]), []).append(r)
    for (plan, _), items in by_container.items():
        assert sum(r["size"] for r in items) + items[0]["unused"] == {1: 10, 2: 40}[plan]
        assert sorted(r["position"] for r in items) == list(range(1, len(items) + 1))
    pieces = [r for r in packed.collect() if r["plan_id"] == 1 and r["doc_id"] == 100]
    assert sorted(r["piece"] for r in pieces) == list(range(len(pieces))) and len(pieces) >= 9
    ids = {(r["plan_id"], r["doc_id"]) for r in packed.collect()}
    assert (2, 103) in ids and (1, 103) not in ids and not {x for _, x in ids} & {101, 102}
    assert {r["plan_id"] for r in packing.packing_report(packed, plans).collect()} == {1, 2}
    assert packing.pack_documents(documents(spark, []), plans).count() == 0


def test_poisson_rates():
    for mean, most in ((0.3, 1), (0.9, 1), (2.7, 3), (0.01, 5)):
        assert abs(mixing.capped_mean(mixing.rate_for(mean, most), most) - mean) < 1e-6
    assert mixing.replication_plan([(1, "a", 0.5, 2), (1, "gone", 0.5, 2)], {"a": 100})[0][3] == pytest.approx(1.8)


def test_mixing(spark):
    rows = [(i, "some words of text", "Big") for i in range(2000)] + [(5000 + i, "some words of text", "small") for i in range(100)] + [(9000, None, "big"), (9001, "x", None)]
    targets = spark.createDataFrame([(1, "big", 0.7, 1), (1, "SMALL", 0.3, 4), (1, "none", 0.2, 2), (2, "none", 1.0, 1)], "mix_id long, source string, target_share double, max_repeats int")
    mixed = mixing.mix_sources(documents(spark, rows), targets).cache()
    shares = {(r["mix_id"], r["source"]): r for r in mixing.mix_report(mixed, targets).collect()}
    assert shares[1, "big"]["actual_share"] == pytest.approx(0.7, abs=0.05) and shares[1, "small"]["most_repeats"] <= 4 and shares[1, "none"]["tokens"] == 0
    assert mixed.groupBy("mix_id", "doc_id").count().agg({"count": "max"}).first()[0] <= 4
    assert [tuple(r) for r in mixed.collect()] == [tuple(r) for r in mixing.mix_sources(documents(spark, rows), targets).collect()]
    assert mixing.mix_sources(documents(spark, []), targets).count() == 0


def test_tokens(spark):
    df = documents(spark, [(1, "hello world", "x"), (2, None, "Y-y"), (3, "", " ")])
    assert [tuple(r) for r in tokens.document_tokens(df).orderBy("doc_id").collect()] == [(1, "x", 2), (2, "y_y", 0), (3, None, 0)]


def test_stuffed_pages(spark):
    rng = np.random.default_rng(5)
    subjects = "farmer officer grower tenant clerk council member keeper neighbour student".split()
    verbs = "keeps checks plans moves grows sells cleans waters spares counts".split()
    things = "field pump seed store canal plot barn fence tool crop".split()
    sentence = lambda: f"The {rng.choice(subjects)} {rng.choice(verbs)} the {rng.choice(things)} of the {rng.choice(subjects)} before the rain and in the {rng.choice(things)}."
    rows = [(i, " ".join(sentence() for _ in range(int(rng.integers(4, 20)))), "x") for i in range(300)]
    keywords = "buy pump price near me | pump dealer offer | cheap pump price online | pump near me discount, "
    table = "Rates noted:\n" + "\n".join(f"{w}  {rng.integers(100, 999)}  {rng.integers(100, 999)}" for w in things * 3)
    rows += [(1000, keywords * 12, "x"), (1001, sentence() + "\n" + "\n".join(["Tags: pump / zorix / offer", "Tags: drill / zorix / price"] * 15), "x"), (1002, sentence() * 6 + "\n" + keywords, "x"), (1003, table, "x"), (1004, None, "x"), (1005, "", "x"), (None, keywords, "x"), (1000, keywords, "x")]
    assert sorted(r["doc_id"] for r in stuffing.find_stuffed(documents(spark, rows)).collect()) == [1000, 1001]
    assert stuffing.find_stuffed(documents(spark, [])).count() == 0


def test_stuffed_pages_are_not_the_rule(spark):
    rng = np.random.default_rng(8)
    subjects = "farmer officer grower tenant clerk council member keeper neighbour student".split()
    things = "field pump seed store canal plot barn fence tool crop".split()
    sentence = lambda: f"The {rng.choice(subjects)} checks the {rng.choice(things)} of the {rng.choice(subjects)} before the rain and in the {rng.choice(things)}."
    rows = [(i, " ".join(sentence() for _ in range(int(rng.integers(9, 12)))), f"s{i % 90}") for i in range(200)]
    copies = [(1000 + i, "buy zorix price near me | zorix dealer offer | cheap zorix price online | zorix near me discount, " * 8, f"s{i % 90}") for i in range(200)]
    tags = "sale brand drill motor valve nozzle hose filter engine spare deal store".split()
    site = [(2000 + i, " / ".join(rng.choice(tags, 4)) * 3 + " | " + " | ".join(" / ".join(rng.choice(tags, 4)) for _ in range(30)), "hot") for i in range(150)]
    for stuffed in (copies, site):
        df = spark.createDataFrame([(*r, "en") for r in rows + stuffed], "doc_id long, text string, site_id string, lang string")
        assert sorted(r["doc_id"] for r in stuffing.find_stuffed(df).collect()) == [r[0] for r in stuffed]


def test_all_pages_of_a_large_site_tell_what_is_usual(spark):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(1000 + i))
    rows = [(i, f"the rain {word(i)}", "large" if i < 200 else f"s{i}", "en") for i in range(300)]
    plain = stuffing.plain_pages(spark.createDataFrame(rows, "doc_id long, text string, site_id string, lang string"))
    usual = stuffing.usual_pages(plain)
    assert {r["doc_id"] for r in usual.collect()} == set(range(300))
    pages = plain.join(usual, "doc_id")
    shares = {r["word"]: r["share"] for r in stuffing.common_words(pages).collect()}
    # The site's 200 texts weigh as much as 2 % of the 300, the others 1 each.
    assert shares[word(0)] == shares[word(199)] == pytest.approx(0.03 / 318) and shares[word(200)] == pytest.approx(1 / 318)
    cells = spark.createDataFrame([("slope", v, w * stuffing.ONE) for v, w in ((10, 1), (20, 1), (30, 6))], "name string, value long, weight long")
    found = stuffing.weighted_quartiles(cells, []).first()
    assert found["pages"] == 8 and found["slope"] == pytest.approx([0.002, 0.003, 0.003])
