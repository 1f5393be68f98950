"""Problem 6: the language of texts and of the segments of mixed texts.

Averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy on a bounded
sample of labelled texts and on romanised copies of them; calibrated by a temperature on held-out texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("en", "hi", "mr", "bn", "ta", "te", "gu", "pa")
#: Where the languages' Unicode blocks begin.
BLOCKS = {"hi": 0x900, "mr": 0x900, "bn": 0x980, "pa": 0xA00, "gu": 0xA80, "ta": 0xB80, "te": 0xC00}
BUCKETS = 1 << 15
WIDTH = 16
#: The bound of the labelled sample: documents of each language, and labelled questions in all.
SAMPLE_DOCUMENTS = 250
SAMPLE_QUESTIONS = 4000
#: Training texts of each language and script.
TEXTS = 600
EPOCHS = 5
#: Cost of a change of language inside a sentence, in log-likelihood; a name or product doesn't pay for it.
SWITCH = 11.0
#: Below this calibrated confidence a segment is rejected.
REJECT = 0.25
#: A label other than English on a text in Latin letters needs this confidence of the first round.
SURE = 0.9
#: A group's texts in a language and script count from so many on; fewer may all be wrongly labelled.
POOL_LEAST = 15
#: Evidence of a sentence below this joins it to the sentence before.
WEAK = 2.0

WORD = regex.compile(r"[\p{L}\p{M}]+")
UNIT = regex.compile(r"(?<=[.!?।॥])\s+|\s*\n\s*|\s+[-–—/|]\s+")
BRACKET = regex.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
NUMBER = regex.compile(r"\p{Nd}+")

#: Latin letters for the places of an Indic block (the blocks are laid out alike).
_LETTERS = dict(
    zip(
        range(0x05, 0x3A),
        "a aa i ee u oo ri li e e e ai o o o au k kh g gh ng ch chh j jh ny t th d dh n t th d dh n n p ph b bh m y r r l l l v sh sh s h".split(),
    )
)
_SIGNS = {0x3E: "aa", 0x3F: "i", 0x40: "ee", 0x41: "u", 0x42: "oo", 0x43: "ri", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au"}
_MARKS = {0x01: "n", 0x02: "n", 0x03: "h", 0x3C: "", 0x70: "n", 0x71: ""}
_VIRAMA = 0x4D
_SPELLINGS = (("aa", "a"), ("ee", "i"), ("oo", "u"), ("v", "w"), ("chh", "ch"), ("ai", "ay"), ("j", "z"))


def romanise(word: str, seed: int = 0) -> str:
    """A Latin spelling of a word in an Indic script; `seed` varies long vowels and doubtful letters."""
    out: list[str] = []
    bare = False
    for ch in word:
        code = ord(ch)
        if not 0x900 <= code < 0xD80:
            return word
        place = (code - 0x900) % 0x80
        if place in _LETTERS:
            if bare:
                out.append("a")
            out.append(_LETTERS[place])
            bare = place >= 0x15
        elif place in _SIGNS:
            out.append(_SIGNS[place])
            bare = False
        elif place == _VIRAMA:
            bare = False
        else:
            if bare and _MARKS.get(place):
                out.append("a")
                bare = False
            out.append(_MARKS.get(place, ""))
    text = "".join(out)
    h = zlib.crc32(f"{word}{seed}".encode())
    for i, (long, short) in enumerate(_SPELLINGS):
        if h >> i & 1:
            text = text.replace(long, short)
    return text


@lru_cache(100_000)
def features(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its letter groups of two to four letters."""
    marked = f"<{word.casefold()}>"
    groups = {marked} | {marked[i : i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)}
    return tuple(zlib.crc32(g.encode()) % BUCKETS for g in sorted(groups))


class LanguageModel:
    """`table` holds each bucket's part of the logits (embedding times output weights)."""

    def __init__(self, table: np.ndarray, bias: np.ndarray, temperature: float = 1.0) -> None:
        self.table, self.bias, self.temperature = table, bias, temperature
        self._words: dict[str, tuple[np.ndarray, int, np.ndarray, int, float]] = {}
        self._units = lru_cache(50_000)(self._unit)

    def __reduce__(self):
        return LanguageModel, (self.table, self.bias, self.temperature)

    def logits(self, words: list[str]) -> np.ndarray:
        places = [f for w in words for f in features(w)]
        return self.table[places].mean(axis=0) + self.bias if places else self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits * self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def _word(self, word: str):
        known = self._words.get(word)
        if known is None:
            places = list(features(word))
            total = self.table[places].sum(axis=0)
            p = self.probabilities(total / len(places) + self.bias)
            scores = np.maximum(np.log(p + 1e-9), -5.0)
            order = np.argsort(scores)
            if len(self._words) > 200_000:
                self._words.clear()
            known = self._words[word] = (total, len(places), scores, int(order[-1]), float(scores[order[-1]] - scores[order[-2]]))
        return known

    def _unit(self, text: str) -> tuple[tuple[int, float, int, np.ndarray], ...]:
        """Runs of one language in a sentence: (language, evidence, features, summed logits)."""
        words = [self._word(w) for w in WORD.findall(text)]
        if not words:
            return ()
        scores = np.array([w[2] for w in words])
        totals = scores.sum(axis=0)
        top = int(totals.argmax())
        strong = sum(1 for w in words if w[3] != top and w[4] > 1.5)
        path = [top] * len(words) if strong < 4 else self._path(scores)
        runs, at = [], 0
        for i in range(1, len(path) + 1):
            if i == len(path) or path[i] != path[at]:
                part = scores[at:i].sum(axis=0)
                best, second = np.sort(part)[::-1][:2]
                evidence = float(part[path[at]] - (second if part[path[at]] == best else best))
                runs.append((path[at], evidence, sum(w[1] for w in words[at:i]), sum(w[0] for w in words[at:i])))
                at = i
        return tuple(runs)

    @staticmethod
    def _path(scores: np.ndarray) -> list[int]:
        states = scores.shape[1]
        value, back = scores[0].copy(), []
        for row in scores[1:]:
            best = int(value.argmax())
            stay = value >= value[best] - SWITCH
            back.append(np.where(stay, np.arange(states), best))
            value = np.where(stay, value, value[best] - SWITCH) + row
        path = [int(value.argmax())]
        for came in reversed(back):
            path.append(int(came[path[-1]]))
        return path[::-1]

    def segments(self, text: str) -> list[tuple[str, float]]:
        """(language, confidence) of each longest run of sentences in one language."""
        outside = BRACKET.sub(" ", text)
        if not WORD.search(outside):
            outside = text
        runs: list[list] = []
        pending = None
        for unit in UNIT.split(NUMBER.sub("0", outside)):
            for language, evidence, count, total in self._units(unit):
                if runs and (language == runs[-1][0] or evidence < WEAK):
                    runs[-1][1] += count
                    runs[-1][2] = runs[-1][2] + total
                elif not runs and evidence < WEAK and pending is None:
                    pending = [language, count, total]
                else:
                    runs.append([language, count, total])
        if not runs and pending:
            runs.append(pending)
        return [(LANGUAGES[k], float(self.probabilities(total / count + self.bias)[k])) for k, count, total in runs]

    def whole(self, text: str) -> tuple[str, float] | None:
        """(language, confidence) of a text in one language, or None if it has no words."""
        words = WORD.findall(text)
        if not words:
            return None
        native = [w for w in words if not w.isascii()]
        if 2 * len(native) >= len(words):  # names, products and courtesies in Latin letters don't count then
            words = native
        known = [self._word(w) for w in words]
        top = int(sum(w[2] for w in known).argmax())
        mean = sum(w[0] for w in known) / sum(w[1] for w in known) + self.bias
        return LANGUAGES[top], float(self.probabilities(mean)[top])


def _fit(texts: list[list[str]], labels: list[int], epochs: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((len(LANGUAGES), WIDTH), np.float32)
    bias = np.zeros(len(LANGUAGES), np.float32)
    places = [np.array([f for w in t for f in features(w)], np.int64) for t in texts]
    labels = np.array(labels)
    size, steps = 32, 0
    total = epochs * (len(texts) // size + 1)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), size):
            batch = order[at : at + size]
            rate = 0.8 * (1 - steps / total)
            steps += 1
            lengths = np.array([len(places[i]) for i in batch])
            flat = np.concatenate([places[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), lengths)
            starts = np.concatenate(([0], lengths.cumsum()[:-1]))
            hidden = np.add.reduceat(emb[flat], starts, axis=0) / lengths[:, None]
            z = hidden @ out.T + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            back = (p @ out) / lengths[:, None] * 8
            out -= rate * (p.T @ hidden) / 4
            bias -= rate * p.sum(axis=0) / len(batch) / 4
            np.subtract.at(emb, flat, (rate * back[owner]).astype(np.float32))
    return (emb @ out.T).astype(np.float32), bias


def in_script(text: str, language: str) -> bool:
    """Whether a text has letters of the Indic block of a language."""
    start = BLOCKS.get(language)
    return start is not None and any(start <= ord(ch) < start + 0x80 for ch in text)


def train_language_model(*groups: list[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS) -> LanguageModel:
    """A model from (language, text) pairs; texts of unknown languages or without words are left out.

    Each group of pairs has the same part in a language's texts, however large it is.

    Sentences and short windows of words are drawn, TEXTS for each language and script; texts in an Indic script also
    give romanised copies. A tenth is held out for the temperature.
    """
    rng = np.random.default_rng(seed)
    pools: dict[tuple[int, bool], dict[int, list[list[str]]]] = {}
    for group, labelled in enumerate(groups):
        for language, text in labelled:
            for unit in UNIT.split(text) if language in LANGUAGES else ():
                words = WORD.findall(BRACKET.sub(" ", unit))
                if words:
                    native = [w for w in words if not w.isascii()]
                    pool = pools.setdefault((LANGUAGES.index(language), not native), {})
                    pool.setdefault(group, []).append(native or words)
    texts: list[list[str]] = []
    labels: list[int] = []

    def draw(key: int, by_group: dict[int, list[list[str]]], roman: bool) -> None:
        most = max(by_group.values(), key=len)
        groups_of_key = [pool for pool in by_group.values() if len(pool) >= POOL_LEAST] or [most]
        for i in range(TEXTS):
            pool = groups_of_key[(i // 3) % len(groups_of_key)]
            words = pool[int(rng.integers(len(pool)))]
            if i % 3:
                n = int(rng.integers(1, 9))
                at = int(rng.integers(max(1, len(words) - n + 1)))
                words = words[at : at + n]
            texts.append([romanise(w, i % 5) for w in words] if roman else words)
            labels.append(key)

    for (key, latin), pool in sorted(pools.items()):
        draw(key, pool, False)
        if not latin:
            draw(key, pool, True)
    if not texts:
        return LanguageModel(np.zeros((BUCKETS, len(LANGUAGES)), np.float32), np.zeros(len(LANGUAGES), np.float32))
    order = rng.permutation(len(texts))
    held, kept = order[: len(order) // 10], order[len(order) // 10 :]
    table, bias = _fit([texts[i] for i in kept], [labels[i] for i in kept], epochs, seed)
    model = LanguageModel(table, bias)
    z = np.array([model.logits(texts[i]) for i in held]) if len(held) else np.zeros((0, len(LANGUAGES)))
    y = np.array([labels[i] for i in held], int)

    def loss(t: float) -> float:
        s = z * t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean()) if len(y) else 0.0

    return LanguageModel(table, bias, min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss))


def base_label(label):
    """A language label without case, blanks and region, null if blank."""
    bare = F.lower(F.trim(F.regexp_replace(label, r"[-_].*$", "")))
    return F.when(bare != "", bare)


def sample_documents(documents: DataFrame) -> list[tuple[str, str]]:
    """About SAMPLE_DOCUMENTS labelled documents of each language, picked by the hash of their id."""
    named = documents.select("doc_id", base_label(F.col("lang")).alias("lang"), "text").filter(F.col("lang").isin(*LANGUAGES) & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(1e6 * min(1.0, SAMPLE_DOCUMENTS / n)))])
    picked = named.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")))
    return [(r["lang"], r["text"]) for r in picked.select("lang", "text").limit(2 * SAMPLE_DOCUMENTS * len(LANGUAGES)).collect()]


def sample_questions(questions: DataFrame) -> list[tuple[str, str]]:
    """About SAMPLE_QUESTIONS labelled questions, picked by the hash of their id."""
    rows = questions.select("id", base_label(F.col("language")).alias("lang"), F.col("original_question").alias("text"))
    rows = rows.filter(F.col("lang").isin(*LANGUAGES) & F.col("text").isNotNull())
    share = min(1.0, SAMPLE_QUESTIONS / max(1, rows.count()))
    picked = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1e6 * share))
    return [(r["lang"], r["text"]) for r in picked.select("lang", "text").limit(2 * SAMPLE_QUESTIONS).collect()]


def fit_language_model(documents: DataFrame, questions: DataFrame | None = None) -> LanguageModel:
    """A model fit in two rounds: documents alone, then with the questions whose noisy label the first round shares.

    A question in the script of its label is kept too: a wrong label rarely happens to be one of the same script.

    Without labelled documents the questions are taken as they are labelled.
    """
    written = sample_documents(documents)
    asked = sample_questions(questions) if questions is not None else []
    if not written or not asked:
        return train_language_model(written or asked)
    first = train_language_model(written)
    kept = []
    for k, text in asked:
        found = first.whole(text)
        if found and (in_script(text, k) or (found[0] == k and (k == "en" or found[1] >= SURE))):
            kept.append((k, text))
    return train_language_model(written, kept)


_SEGMENTS = "record_id bigint, segment_no bigint, lang string, confidence double"


def segment_languages(rows: DataFrame, id_col: str, text_col: str, model: LanguageModel, home: str | None = None) -> DataFrame:
    """(record_id, segment_no, lang, confidence): every segment of every text, numbered from 1 in reading order.

    With `home`, texts wholly in that language give no row. `lang` is null where the confidence is below REJECT. Null ids, null texts and texts without words give no row.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, numbers, langs, sure = [], [], [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = own.segments(text)
                if home and all(language == home for language, _ in found):
                    continue
                for number, (language, confidence) in enumerate(found, 1):
                    ids.append(id_)
                    numbers.append(number)
                    langs.append(language if confidence >= REJECT else None)
                    sure.append(confidence)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(langs, pa.string()), pa.array(sure, pa.float64())],
                names=["record_id", "segment_no", "lang", "confidence"],
            )

    picked = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null and text is not null")
    return picked.mapInArrow(run, _SEGMENTS)


def relabelled(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(record_id, segment_no, lang, confidence) of the rows whose label is missing, unknown or not the question's language."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, langs, sure = [], [], []
            for id_, label, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = own.whole(text)
                if found and found[0] != label:
                    ids.append(id_)
                    langs.append(found[0] if found[1] >= REJECT else None)
                    sure.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([1] * len(ids), pa.int64()), pa.array(langs, pa.string()), pa.array(sure, pa.float64())],
                names=["record_id", "segment_no", "lang", "confidence"],
            )

    picked = rows.select(F.col("id").cast("bigint").alias("id"), base_label(F.col("language")).alias("label"), F.col("original_question").alias("text"))
    return picked.filter("id is not null and text is not null").mapInArrow(run, _SEGMENTS)


def label_languages(calls: DataFrame, normalized: DataFrame, documents: DataFrame) -> DataFrame:
    """(origin STRING, record_id BIGINT, segment_no BIGINT, lang STRING, confidence DOUBLE).

    Origin `answer`: the segments of each kccans that isn't wholly English. Origin `label`: rows of `normalized` whose
    label is missing, unknown or wrong. Null texts and texts without words give no row; `lang` is null for a rejected
    segment; repeated rows give repeated results; extra columns are ignored.
    """
    model = fit_language_model(documents, normalized)
    answers = segment_languages(calls, "call_id", "kccans", model, home="en").select(F.lit("answer").alias("origin"), "*")
    labels = relabelled(normalized, model).select(F.lit("label").alias("origin"), "*")
    return answers.unionByName(labels)


def find_languages(calls: DataFrame, normalized: DataFrame, documents: DataFrame) -> DataFrame:
    """The rows of `label_languages` that aren't rejected, without confidence."""
    return label_languages(calls, normalized, documents).filter("lang is not null").select("origin", "record_id", "segment_no", "lang")
