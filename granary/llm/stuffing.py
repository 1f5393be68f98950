"""Problem 9: pages of repeated keywords, links or product tags.

Each page's rank-frequency curve is fit with SQL windows; pages whose slope, residual or divergence from prose of the same
language stands out among pages of comparable length are suspects. Of these, the share of words in lines or sentences that
themselves diverge from prose decides.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.language import LANGUAGES, base_label
from granary.session import materialize

#: Words rarer than this in their language count as this rare; it bounds the table of words that is broadcast.
WORD_SHARE = 2e-5
#: Deviations from the median of comparable pages from which a page is a suspect.
DIVERGENT, STEEP, UNEVEN = 3.0, 5.0, 6.0
#: A group of comparable pages needs so many pages; else pages of that length in all languages, then all pages.
GROUP_LEAST = 15
#: A line or sentence diverges by its words' average rarity, and by how much more common they are on its page.
RARE, REPEATED, SURELY_REPEATED = 1.45, 1.0, 1.5
#: Without any of so many commonest words of its language, less rarity will do.
COMMONEST, BARE_RARE = 30, 0.7
#: Rows of figures are no keywords, from this share of numbers on.
FIGURES = 0.35
SHARE = 0.55
#: What is usual is learnt from each different text once; all those of a site together weigh up to this share of the different texts.
SITE_SHARE = 0.02
#: The weight of a page; whole numbers, so that sums don't depend on their order.
ONE = 1_000_000
#: Quartiles are taken of values rounded to this, far less than the least spread.
GRID = 1e-4
BROADCAST_IDS = 500_000

UNIT = regex.compile(r"\n+|(?<=[.!?।॥])\s+")
WORDS = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")
DIGITS = regex.compile(r"\p{Nd}+")
#: The scripts of the languages, as in Java's regular expressions.
SCRIPTS = {"en": "Latin", "hi": "Devanagari", "mr": "Devanagari", "bn": "Bengali", "ta": "Tamil", "te": "Telugu", "gu": "Gujarati", "pa": "Gurmukhi"}


def page_language(text: Column, label: Column) -> Column:
    """The number in LANGUAGES of the labelled language if the text has letters of its script, else of the first language whose script it has; -1 if none."""
    has = lambda k: text.rlike(f"\\p{{Is{SCRIPTS[k]}}}")
    base, number = base_label(label), lambda k: F.lit(LANGUAGES.index(k))
    chosen = F.coalesce(*[F.when((base == k) & has(k), number(k)) for k in LANGUAGES])
    return F.coalesce(chosen, *[F.when(has(k), number(k)) for k in (*LANGUAGES[1:], "en")], F.lit(-1))


def plain_pages(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, site, plain): texts in lower case, numbers alike, single blanks for what is no word; lang as a number."""
    site = F.col("site_id").cast("string") if "site_id" in documents.columns else F.lit(None).cast("string")
    bare = F.regexp_replace(F.regexp_replace(F.lower("text"), r"\p{Nd}+", "0"), r"[^\p{L}\p{M}\p{Nd}]+", " ")
    pages = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), page_language(F.col("text"), F.col("lang")).alias("lang"), site.alias("site"), F.btrim(bare).alias("plain"))
    return pages.filter("doc_id is not null and plain <> ''")


def usual_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, weight): one page of each different text, which tell what is usual; the weight is ONE, on a site with more than SITE_SHARE of these pages less, so that they have as much together.

    So neither copies of a page nor one site can make themselves the rule. Texts that differ in case, marks or numbers only count as one.
    """
    texts = pages.select("doc_id", "site", F.unhex(F.md5("plain")).alias("digest"))
    firsts = materialize(texts.groupBy("digest").agg(F.min(F.struct("doc_id", "site")).alias("first")).select("first.doc_id", "first.site"), "firsts")
    most = max(1.0, SITE_SHARE * firsts.count())
    # Fewer than 1 / SITE_SHARE sites by definition.
    large = firsts.filter("site is not null").groupBy("site").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > most)
    weight = F.coalesce(F.round(F.lit(ONE * most) / F.col("m")).cast("bigint"), F.lit(ONE))
    return firsts.join(F.broadcast(large), "site", "left").groupBy("doc_id").agg(F.max(weight).alias("weight"))


def common_words(pages: DataFrame) -> DataFrame:
    """(lang, word, share) of the words with at least WORD_SHARE of their language on usual pages by weight: at most 1 / WORD_SHARE a language."""
    counts = pages.filter("weight > 0").select("lang", "weight", F.explode(F.split("plain", " ")).alias("word")).groupBy("lang", "word").agg(F.sum("weight").alias("n"))
    counts = materialize(counts, "counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(totals), "lang").select("lang", "word", (F.col("n") / F.col("all")).alias("share")).filter(F.col("share") >= WORD_SHARE)


#: Fixed value: the second derivative of Riemann's zeta function at 0.
ZETA2 = -2.00635645590858


def log_sum(n: Column) -> Column:
    """ln 1 + ... + ln n by Stirling's series; 0 for n = 0."""
    x = n.cast("double")
    return F.when(n > 0, x * F.ln(x) - x + F.ln(2 * math.pi * x) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x)).otherwise(F.lit(0.0))


def log_square_sum(n: Column) -> Column:
    """(ln 1)^2 + ... + (ln n)^2 by the series of Euler and Maclaurin; 0 for n < 2."""
    x = n.cast("double")
    y = F.ln(x)
    third = (4 * y - 6) / (x * x * x)
    return F.when(n > 1, x * y * y - 2 * x * y + 2 * x + y * y / 2 + y / (6 * x) - third / 720 + ZETA2).otherwise(F.lit(0.0))


def page_curves(pages: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, lang, weight, total, slope, residual, divergence) of each page.

    Slope and root mean square residual of log frequency on log rank over all its words; divergence is the page's
    Kullback-Leibler divergence from its language. Words of one frequency have neighbouring ranks, whichever comes first,
    so the windows run over a page's different frequencies and add up the ranks of each by closed forms. The texts are
    brought together by page once; counting and ranking need no further shuffle.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = pages.repartition(parts, "doc_id").select("doc_id", "lang", "weight", F.explode(F.split("plain", " ")).alias("word"))
    counted = words.groupBy("doc_id", "word").agg(F.min("lang").alias("lang"), F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    rarity = -F.ln(F.coalesce("share", F.lit(WORD_SHARE)))
    held = counted.join(F.broadcast(common), ["lang", "word"], "left")
    steps = held.groupBy("doc_id", "n").agg(F.min("lang").alias("lang"), F.max("weight").alias("weight"), F.count(F.lit(1)).alias("m"), F.sum(rarity).alias("rarity"))
    page = Window.partitionBy("doc_id")
    last = F.sum("m").over(page.orderBy(F.desc("n")))
    ranked = steps.select("*", last.alias("last"), (last - F.col("m")).alias("before"), F.sum(F.col("m") * F.col("n")).over(page).alias("total"))
    y = F.ln(F.col("n") / F.col("total"))
    ranked = ranked.select("*", y.alias("y"), (log_sum(F.col("last")) - log_sum(F.col("before"))).alias("x"), (log_square_sum(F.col("last")) - log_square_sum(F.col("before"))).alias("xx"))
    fit = ranked.groupBy("doc_id").agg(
        F.min("lang").alias("lang"), F.max("weight").alias("weight"), F.max("total").alias("total"), F.sum("m").cast("double").alias("k"), F.sum(F.col("m") * F.col("y")).alias("sy"),
        F.sum(F.col("m") * F.col("y") * F.col("y")).alias("qy"), F.sum("x").alias("sx"), F.sum("xx").alias("qx"), F.sum(F.col("x") * F.col("y")).alias("xy"),
        F.sum(F.col("n") / F.col("total") * (F.col("m") * F.col("y") + F.col("rarity"))).alias("divergence"),
    )
    sxx, syy, sxy = (F.col("qx") - F.col("sx") * F.col("sx") / F.col("k"), F.col("qy") - F.col("sy") * F.col("sy") / F.col("k"), F.col("xy") - F.col("sx") * F.col("sy") / F.col("k"))
    slope = F.when(F.col("k") > 1, sxy / F.greatest(sxx, F.lit(1e-9))).otherwise(F.lit(0.0))
    residual = F.sqrt(F.greatest(F.lit(0.0), syy - slope * sxy) / F.col("k"))
    return fit.select("doc_id", "lang", "weight", "total", slope.alias("slope"), residual.alias("residual"), "divergence")


def weighted_quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pages, slope, residual, divergence): the pages by weight of each group, and the quartiles of the three, an array each, from (lang, size, name, value, weight)."""
    by = [*keys, "name"]
    merged = cells.groupBy(*by, "value").agg(F.sum("weight").alias("weight"))
    group = Window.partitionBy(*by)
    upto, whole = F.sum("weight").over(group.orderBy("value")), F.sum("weight").over(group)
    placed = merged.select(*by, (F.col("value") * GRID).alias("value"), upto.alias("upto"), whole.alias("whole"))
    # A quartile is the least value up to which its share of the weight lies.
    quartiles = F.array(*[F.min(F.when(F.col("upto") * 4 >= F.col("whole") * k, F.col("value"))) for k in (1, 2, 3)])
    found = placed.groupBy(*by).agg(quartiles.alias("quartiles"), F.max("whole").alias("whole"))
    held = [F.max(F.when(F.col("name") == c, F.col("quartiles"))).alias(c) for c in ("slope", "residual", "divergence")]
    return found.groupBy(*keys).agg((F.max("whole") / ONE).alias("pages"), *held)


def suspects(curves: DataFrame) -> DataFrame:
    """(doc_id, lang, usual): pages that stand out among the usual ones of their language and length; usual is their divergence.

    The spread is that of the lower half where it is smaller, since stuffed pages widen the upper one.
    """
    sized = curves.withColumn("size", F.floor(2 * F.log2("total")).cast("int"))
    names = ("slope", "residual", "divergence")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.round(F.col(c) / GRID).cast("bigint").alias("value")) for c in names]))
    # Bounded by the grid, however many pages there are.
    cells = sized.filter("weight > 0").select("lang", "size", "weight", values.alias("v")).groupBy("lang", "size", "v.name", "v.value").agg(F.sum("weight").alias("weight"))
    cells = materialize(cells, "cells")
    groups, sizes, overall = (weighted_quartiles(cells, keys) for keys in (["lang", "size"], ["size"], []))
    groups, sizes = groups.filter(F.col("pages") >= GROUP_LEAST), sizes.filter(F.col("pages") >= GROUP_LEAST)
    held = lambda df, name, *keys: df.select(*keys, F.struct(*names).alias(name))
    # Languages and lengths are few: nine by twice the binary logarithm of the longest page.
    joined = (
        sized.join(F.broadcast(held(groups, "g", "lang", "size")), ["lang", "size"], "left")
        .join(F.broadcast(held(sizes, "s", "size")), "size", "left").crossJoin(F.broadcast(held(overall, "o")))
    )
    base = {c: F.coalesce(F.col(f"g.{c}"), F.col(f"s.{c}"), F.col(f"o.{c}")) for c in names}
    least = {"slope": 0.03, "residual": 0.02, "divergence": 0.05}
    spread = {c: (base[c][2] - base[c][0]) / 1.349 for c in names}
    spread["divergence"] = F.least(spread["divergence"], (base["divergence"][1] - base["divergence"][0]) / 0.6745)
    z = {c: (F.col(c) - base[c][1]) / (spread[c] + least[c]) for c in names}
    stands_out = (z["divergence"] > DIVERGENT) | (F.abs(z["slope"]) > STEEP) | (F.abs(z["residual"]) > UNEVEN)
    return joined.filter(stands_out).select("doc_id", "lang", base["divergence"][1].alias("usual"))


def spam_share(text: str, usual: float, shares: dict[str, float], entropy: float, commonest: set[str]) -> float:
    """The share of a page's words that stand in lines or sentences of keywords."""
    units = []
    for unit in UNIT.split(text):
        words = [DIGITS.sub("0", w) for w in WORDS.findall(unit.lower())]
        if words:
            units.append(words)
    counts = Counter(w for words in units for w in words)
    total = sum(counts.values())
    if not total:
        return 0.0
    rarity = {w: -math.log(shares.get(w, WORD_SHARE)) for w in counts}
    spam = 0
    for words in units:
        rare = sum(rarity[w] for w in words) / len(words) - entropy
        repeated = sum(math.log(counts[w] / total) + rarity[w] for w in words) / len(words) - usual
        figures = sum(w == "0" for w in words) / len(words)
        bare = rare >= BARE_RARE and commonest.isdisjoint(words)
        if figures < FIGURES and (repeated >= SURELY_REPEATED or bare or (rare >= RARE and repeated >= REPEATED)):
            spam += len(words)
    return spam / total


def judge_pages(documents: DataFrame) -> DataFrame:
    """(doc_id BIGINT, spam_share DOUBLE) of the suspects."""
    plain = materialize(plain_pages(documents), "plain")
    pages = plain.drop("site").join(usual_pages(plain), "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("bigint")))
    common = materialize(common_words(pages), "common")
    found = materialize(suspects(materialize(page_curves(pages, common), "curves")), "suspects")
    shares: dict[int, dict[str, float]] = {}
    for row in common.collect():
        shares.setdefault(row["lang"], {})[row["word"]] = row["share"]
    entropy = {k: sum(-p * math.log(p) for p in v.values()) / max(1e-9, sum(v.values())) for k, v in shares.items()}
    commonest = {k: set(sorted(v, key=lambda w: (-v[w], w))[:COMMONEST]) for k, v in shares.items()}
    shared = documents.sparkSession.sparkContext.broadcast((shares, entropy, commonest))
    small = found.count() <= BROADCAST_IDS
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    picked = texts.join(F.broadcast(found) if small else found, "doc_id").select("doc_id", "text", "lang", "usual")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_language, levels, frequent = shared.value
        for batch in batches:
            values = zip(*(batch.column(i).to_pylist() for i in range(1, 4)))
            out = [spam_share(text, usual, by_language.get(lang, {}), levels.get(lang, 0.0), frequent.get(lang, set())) for text, lang, usual in values]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "spam_share"])

    return picked.mapInArrow(run, "doc_id bigint, spam_share double")


def find_stuffed(documents: DataFrame) -> DataFrame:
    """(doc_id BIGINT): pages that are for the larger part repeated search words, links or product tags.

    Null ids, null texts and texts without words give no row; rows of one doc_id are taken as one page and give one row; the label is only
    a hint at the language; extra columns are ignored.
    """
    return judge_pages(documents).filter(F.col("spam_share") >= SHARE).select("doc_id").distinct()
