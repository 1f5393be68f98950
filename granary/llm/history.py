"""Problem 3: new batches against all history, by persisted band keys.

A text is brought to a content key: spelling slips are undone against the frequent words of the corpus, courtesies and
small words dropped, named fields ordered. Its anchors (numbers, places and other rare words) must be equal for two texts
to be nearly the same. The signature of a class is its minwise sketch, the smallest hashes of its content words; each band
key hashes the anchors with one of the least words in an order by rarity and hash. So many of them are taken that two texts
that pass the verification always share a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.canon import FIELD_END, FORM_LABELS, VALUE_START, _by_first, _label_starts, canonical
from granary.llm.skew import attach
from granary.llm.slips import shortened, slip_distance, slips_within
from granary.session import materialize, shared_path

#: A word is frequent from this share of the different texts on; so their number is bounded by text length / share.
FREQUENT_SHARE = 0.0002
FREQUENT_LEAST = 8
#: Words that may lack or be added between two texts, and the share of the longer text that they may be.
LOOSE_WORDS = 2
LOOSE_SHARE = 0.34
BUCKETS = 64
#: Runs that the batches of a whole table are put through the index in.
GROUPS = 4
#: Hashes in a signature; a text of no more different words is in it as a whole.
SKETCH = 16
#: Classes of one band key that one task compares; larger keys are split by a second word that both texts must share.
SPLIT = 4096
INDEX = "band_key bigint, first_call bigint, anchors bigint, content string, signature binary, bucket int"

#: Courtesies, remarks and small words that don't change a question.
FILLERS = frozenset(
    (
        "sir madam namaste hello hi dear kisan query please kindly tell me us you your we our guide i want wants ask asked asks asking to learn "
        "know the is are was of for about regarding farmer grower caller inform in at a an and or be can could what how should would it its with "
        "does do did my that this these those there on by from as any urgent twice call back remark remarks again today now ji bhai help need needs"
    ).split()
)
#: Words that only introduce a place or number; these must be equal themselves.
PLACE_WORDS = frozenset("village plot reg no number".split())
#: Spelling variants and abbreviations, and the usual word.
VARIANTS = {
    "mkt": "market", "qtl": "quintal", "quintals": "quintal", "plz": "please", "pls": "please", "skeem": "scheme", "required": "needed",
    "liter": "litre", "litres": "litre", "ltr": "litre", "acres": "acre", "ac": "acre", "kgs": "kg", "govt": "government", "fert": "fertiliser",
    "fertilizer": "fertiliser", "colour": "color", "vill": "village", "msp": "price", "pesticides": "pesticide", "info": "information",
}
_LABELS = _by_first(FORM_LABELS)
_DIGIT = regex.compile(r"\p{Nd}")
_LATIN = regex.compile(r"\p{Latin}+")




def _reach(word: str) -> int:
    return 0 if len(word) < 4 else 1 if len(word) < 5 else 2


class Speller:
    """The frequent words of a corpus; finds the one that a rare word is a slip of.

    `counts` holds the number of texts of each frequent word. A frequent word with a neighbour at one slip that is eight (of four letters: twenty)
    times as frequent is itself a slip or variant of it.
    """

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts = {**dict.fromkeys(VARIANTS, 1), **counts}
        self.index: dict[str, list[str]] = {}
        for word in counts:
            if len(word) >= 4 and _LATIN.fullmatch(word):
                for short in shortened(word, _reach(word)):
                    self.index.setdefault(short, []).append(word)
        self.same: dict[str, str] = {}
        for word in sorted(counts, key=lambda w: (counts[w], w)):
            if len(word) >= 4 and word not in VARIANTS and _LATIN.fullmatch(word):
                better = [w for w in self._near(word, 1) if w != word and counts[w] >= (8 if len(word) > 4 else 20) * counts[word]]
                if better:
                    self.same[word] = max(better, key=lambda w: (counts[w], w))
        self.fix = lru_cache(200_000)(self._fix)

    def _near(self, word: str, most: int) -> set[str]:
        return {w for short in shortened(word, most) for w in self.index.get(short, ()) if slips_within(word, w, most)}

    def _fix(self, word: str) -> tuple[str, bool]:
        """The usual spelling, and whether it is a frequent word."""
        word = VARIANTS.get(word, word)
        if word in self.counts:
            word = self.same.get(word, word)
            return VARIANTS.get(word, word), True
        if len(word) < 4 or not _LATIN.fullmatch(word):
            return word, False
        limit = 1.75 if len(word) < 7 else 2.0
        near = [(d, -self.counts[w], w) for w in self._near(word, _reach(word)) if (d := slip_distance(word, w, limit)) <= limit]
        near = [x for x in near if x[0] <= 1 or x[2][0] == word[0]]
        if not near:
            return word, False
        best = min(near)[2]
        best = self.same.get(best, best)
        return VARIANTS.get(best, best), True


def content_key(key: str, fix: Callable[[str], tuple[str, bool]]) -> tuple[str, str]:
    """(anchors, content words) of a canonical text, each joined by blanks."""
    anchors: list[str] = []

    def usual(words: list[str]) -> list[tuple[str, bool]]:
        return [fix(w) if not _DIGIT.search(w) else (w, False) for w in words]

    def keep(words: list[tuple[str, bool]], drop: frozenset[str]) -> list[str]:
        out = []
        for word, known in words:
            if _DIGIT.search(word):
                anchors.append(word)
            elif word in drop:
                continue
            elif known:
                out.append(word)
            elif len(word) > 3 or not word.isascii():
                anchors.append(word)
                out.append(f"?{word}")
        return out

    if VALUE_START in key:
        pairs = [field.split(VALUE_START) for field in key.split(FIELD_END)]
        fields = [([w for w, _ in usual(label.split()) if w not in FILLERS or w == "remark"], usual(value.split())) for label, value in pairs]
    else:
        words = [(w, known) for w, known in usual(key.split()) if w not in FILLERS or w == "remark"]
        plain = [w for w, _ in words]
        starts = _label_starts(plain, _LABELS) if plain and plain[0] in _LABELS else []
        if len(starts) >= 3 and starts[0][0] == 0:
            ends = [i for i, _ in starts[1:]] + [len(words)]
            fields = [(plain[i : i + n], words[i + n : end]) for (i, n), end in zip(starts, ends)]
        else:
            fields = []
    if len(fields) >= 3:
        content = []
        for label, value in sorted(fields, key=lambda f: " ".join(f[0])):
            if label != ["remark"]:
                content.append("_".join(label) + ":")
                content.extend(keep(value, frozenset()))
    else:
        flat = [pair for label, value in fields for pair in [*((w, True) for w in label), *value]] if fields else words
        content = keep(flat, FILLERS | PLACE_WORDS)
    # One rare word is the place, which may stand anywhere; of several, their order may tell who does what.
    if sum(w[0] == "?" for w in content) < 2:
        content = [w for w in content if w[0] != "?"]
    return " ".join(sorted(anchors)), " ".join(content)


def most_loose(length: int) -> int:
    """Words of a text of this length that may lack in a text that is not longer."""
    return max(LOOSE_WORDS, int(LOOSE_SHARE * length))


def nearly_same(a: list[str], b: list[str]) -> bool:
    """Whether two texts of equal anchors ask the same, by their content words.

    Words may lack on either side, up to LOOSE_WORDS or LOOSE_SHARE, but none may stand in the place of another, and
    forms must fill in the same fields.
    """
    if a == b:
        return True
    if {w for w in a if w[-1] == ":"} != {w for w in b if w[-1] == ":"}:
        return False
    most = most_loose(max(len(a), len(b)))
    if abs(len(a) - len(b)) > most:
        return False
    n, m = len(a), len(b)
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    if n - table[0][0] > most or m - table[0][0] > most or not table[0][0]:
        return False
    i = j = lack_a = lack_b = 0
    while i < n or j < m:
        if i < n and j < m and a[i] == b[j]:
            i, j, lack_a, lack_b = i + 1, j + 1, 0, 0
        elif j == m or (i < n and table[i + 1][j] >= table[i][j + 1]):
            i, lack_b = i + 1, lack_b + 1
        else:
            j, lack_a = j + 1, lack_a + 1
        if lack_a and lack_b:
            return False
    return True


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def least_words(words: list[str], counts: dict[str, int]) -> list[str]:
    """The different words that two nearly same texts must share one of: the rarest by `counts`, then by hash.

    At most most_loose(length) words of a text may lack in one that is nearly the same (in a longer one too, since
    most_loose grows slower than the length). So of that many words and one more, in an order that both texts share, the
    first common word is among those of either: no pair is missed.
    """
    rank = lambda w: (counts.get(w, 0), xxhash.xxh64_intdigest(w), w)
    return sorted(set(words), key=rank)[: most_loose(len(words)) + 1]


def band_keys(anchors: str, content: str, counts: dict[str, int]) -> list[int]:
    """Signed 64-bit keys: the anchors hashed with each of the least words (no word: one key)."""
    return [signed(xxhash.xxh64_intdigest(repr((anchors, word)))) for word in least_words(content.split(), counts) or [""]]


def second_keys(band_key: int, content: str) -> list[int]:
    """The keys that split an oversized band key, none of its pairs being lost.

    Texts of which one has more than LOOSE_WORDS + 1 words share two words at least; of the different words, by hash, the
    first or second common one is among the first most_loose + 2. Shorter texts are also compared under a key of their own,
    of which there are no more than short lists of frequent words.
    """
    words = content.split()
    first = sorted(set(words), key=lambda w: (xxhash.xxh64_intdigest(w, 1), w))[: most_loose(len(words)) + 2]
    pairs = [f"{a} {b}" for i, a in enumerate(first) for b in first[i + 1 :]]
    if len(words) <= LOOSE_WORDS + 1:
        pairs.append("")
    return [signed(xxhash.xxh64_intdigest(repr((band_key, pair)))) for pair in dict.fromkeys(pairs)]


def sketch(content: str) -> bytes:
    """The signature: the SKETCH least 16-bit hashes of the different content words, two bytes each."""
    return b"".join(h.to_bytes(2, "big") for h in sorted({xxhash.xxh32_intdigest(w) & 0xFFFF for w in content.split()})[:SKETCH])


def sketched(signature: bytes) -> frozenset[int]:
    return frozenset(int.from_bytes(signature[i : i + 2], "big") for i in range(0, len(signature), 2))


def may_be_same(a: list[str], sketch_a: frozenset[int], b: list[str], sketch_b: frozenset[int]) -> bool:
    """Whether the signatures leave room for the words that nearly same texts share; true where they don't tell.

    Equal hashes of different words only let a pair through.
    """
    if len(sketch_a) >= SKETCH or len(sketch_b) >= SKETCH:
        return True
    longer = max(len(a), len(b))
    again = min(len(a) - len(sketch_a), len(b) - len(sketch_b))
    return len(sketch_a & sketch_b) + again >= longer - most_loose(longer)


def canonical_calls(calls: DataFrame, id_col: str, text_col: str, batch_col: str) -> DataFrame:
    """(key STRING, call_id BIGINT, batch_no INT) of the texts that have a letter or digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([canonical(t) for t in batch.column(2).to_pylist()], pa.string())
            whole = pa.RecordBatch.from_arrays([keys, batch.column(0), batch.column(1)], names=["key", "call_id", "batch_no"])
            yield whole.filter(keys.is_valid())

    picked = calls.select(
        F.col(id_col).cast("bigint").alias("call_id"), F.col(batch_col).cast("int").alias("batch_no"), F.col(text_col).cast("string").alias("text")
    ).filter("call_id is not null and batch_no is not null and text is not null")
    return picked.mapInArrow(run, "key string, call_id bigint, batch_no int")


def fit_speller(texts: DataFrame, total: int) -> Speller:
    """The frequent words of all different texts."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key in batch.column(0).to_pylist():
                for word in set(key.replace(FIELD_END, " ").replace(VALUE_START, " ").split()):
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) > 200_000:
                yield flush()
                counts.clear()
        yield flush()

    least = max(FREQUENT_LEAST, int(FREQUENT_SHARE * total))
    rows = texts.select("key").mapInArrow(words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()
    return Speller({row["word"]: row["n"] for row in rows if not _DIGIT.search(row["word"])})


_spellers: dict[str, Speller] = {}


def _own_speller(token: str, counts) -> Speller:
    """The speller of a worker process, which serves many tasks."""
    if token not in _spellers:
        _spellers.clear()
        _spellers[token] = Speller(counts.value)
    return _spellers[token]


def content_keys(keyed: DataFrame, speller: Speller) -> DataFrame:
    """(call_id, batch_no, anchors, content) of canonical texts; equal content keys are one class."""
    shared, token = keyed.sparkSession.sparkContext.broadcast(speller.counts), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own_speller(token, shared)
        read = lru_cache(50_000)(lambda key: content_key(key, own.fix))
        for batch in batches:
            anchors, content = zip(*map(read, batch.column(0).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(anchors, pa.string()), pa.array(content, pa.string())], names=["call_id", "batch_no", "anchors", "content"])

    return keyed.select("key", "call_id", "batch_no").mapInArrow(run, "call_id bigint, batch_no int, anchors string, content string")


_CLASS = "first_call bigint, anchors bigint, content string, signature binary"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
_NAMES = ["band_key", "first_call", "anchors", "content", "signature"]


def index_rows(classes: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """The index: (bucket INT, band_key, first_call, anchors BIGINT, content STRING, signature BINARY), a row for each band key of a class.

    `counts` give the words' order, which must be the same for all rows of an index. Anchors are kept as a hash of their own,
    which with that in the band key makes 128 bits; the content stays, since verification needs the words in order.
    """
    shared = classes.sparkSession.sparkContext.broadcast(counts or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for call, anchors, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held, least = signed(xxhash.xxh64_intdigest(anchors, 1)), sketch(content)
                for key in dict.fromkeys(band_keys(anchors, content, shared.value)):
                    for column, x in zip(out, (key, call, held, content, least)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _KINDS)], names=_NAMES)

    keyed = classes.select("first_call", "anchors", "content").mapInArrow(run, f"band_key bigint, {_CLASS}")
    return keyed.select(F.pmod("band_key", F.lit(BUCKETS)).cast("int").alias("bucket"), *_NAMES)


_FOUND = f"target bigint, known boolean, band_key bigint, {_CLASS}, is_new boolean"


def _compare(split: int | None):
    """Within each band key, in order of arrival: each new class with the first earlier one that is nearly the same (or null),
    and whether an equal class stands before it.

    Every class is compared with all earlier ones of its key and anchors, whether these have links or not. Rows of keys with
    more than `split` classes come out as they are, with `known` null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, earlier = None, {}
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(8))
            for key, call, anchors, content, signature, new, n in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if split is not None and n > split:
                    row = (None, None, key, call, anchors, content, signature, new)
                else:
                    if key != at:
                        at, earlier = key, {}
                    words, hashes = content.split(), sketched(signature)
                    group = earlier.setdefault(anchors, [])
                    target, equal = None, any(others == words for _, others, _ in group)
                    if new:
                        target = next((other for other, others, sketched in group if other != call and may_be_same(others, sketched, words, hashes) and nearly_same(others, words)), None)
                    if not equal:
                        group.append((call, words, hashes))
                    if not new or (target is None and not equal):
                        continue
                    row = (target, equal, None, call, None, None, None, True)
                for column, x in zip(out, row):
                    column.append(x)
            kinds = (pa.int64(), pa.bool_(), *_KINDS, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["target", "known", *_NAMES, "is_new"])

    return run


def _resplit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, ...] = tuple([] for _ in range(6))
        for key, call, anchors, content, signature, new in zip(*(batch.column(i).to_pylist() for i in range(6))):
            for second in second_keys(key, content):
                for column, x in zip(out, (second, call, anchors, content, signature, new)):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (*_KINDS, pa.bool_()))], names=[*_NAMES, "is_new"])


def linked(index: DataFrame, new: DataFrame | None = None, split: int = SPLIT) -> DataFrame:
    """(first_call, target, known): as `probe`, and whether the index held the class already; target may be null then.

    One shuffle by band key; keys that have no new class, or a single one, end before Python. What is left of keys with more
    than `split` classes is compared by `second_keys`.
    """
    rows = index.select(*_NAMES, F.lit(new is None).alias("is_new"))
    if new is not None:
        rows = rows.unionByName(new.select(*_NAMES, F.lit(True).alias("is_new")))

    def compare(rows: DataFrame, limit: int | None) -> DataFrame:
        key = Window.partitionBy("band_key")
        sized = rows.select("*", F.count(F.lit(1)).over(key).alias("n"), F.max("is_new").over(key).alias("wanted")).filter("wanted and n > 1").drop("wanted")
        return sized.sortWithinPartitions("band_key", "first_call", "is_new").mapInArrow(_compare(limit), _FOUND)

    found = materialize(compare(rows, split), "found")
    links = found.filter("known is not null").select("first_call", "target", "known")
    large = found.filter("known is null")
    if not large.isEmpty():
        smaller = large.select(*_NAMES, "is_new").mapInArrow(_resplit, f"band_key bigint, {_CLASS}, is_new boolean")
        links = links.unionByName(compare(smaller, None).select("first_call", "target", "known"))
    return links.groupBy("first_call").agg(F.min("target").alias("target"), F.max("known").alias("known"))


def probe(index: DataFrame, new: DataFrame | None = None, split: int = SPLIT) -> DataFrame:
    """(first_call, target): classes of `new` (by default of the index itself) and the earliest class nearly the same.

    The target is nearly the same itself, not by way of a third class.
    """
    return linked(index, new, split).filter("target is not null").select("first_call", "target")


def append_index(index: DataFrame, path: str) -> None:
    """Add the keys of accepted records to a persisted index, partitioned by hash."""
    index.repartition("bucket").sortWithinPartitions("bucket", "band_key").write.mode("append").partitionBy("bucket").parquet(path)


def read_index(spark: SparkSession, path: str, new: DataFrame | None = None) -> DataFrame:
    """A persisted index; with `new`, only the partitions whose buckets occur in it."""
    index = spark.read.schema(INDEX).parquet(path)
    if new is None:
        return index
    buckets = [row["bucket"] for row in new.select("bucket").distinct().collect()]
    return index.filter(F.col("bucket").isin(buckets))


def start_history(keyed: DataFrame, path: str) -> None:
    """A folder with an empty index and the speller, fitted on these calls; later batches are read with it as it is stored."""
    texts = materialize(keyed.select("key").distinct(), "texts")
    counts = fit_speller(texts, texts.count()).counts
    spark = keyed.sparkSession
    spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n bigint").coalesce(1).write.parquet(f"{path}/speller")
    spark.createDataFrame([], INDEX).write.partitionBy("bucket").parquet(f"{path}/index")


def stored_speller(spark: SparkSession, path: str) -> Speller:
    return Speller({row["word"]: row["n"] for row in spark.read.schema("word string, n bigint").parquet(f"{path}/speller").collect()})


def add_batches(keyed: DataFrame, path: str) -> DataFrame:
    """(accepted_id BIGINT, call_id BIGINT) of one or more new batches, whose classes are then appended to the history in `path`.

    `keyed` comes from `canonical_calls`. Only the index rows that share a band key with the new classes are compared; the calls of
    earlier batches are not read. A batch that comes again gives the same rows and adds nothing.
    """
    speller = stored_speller(keyed.sparkSession, path)
    digest = F.unhex(F.md5(F.concat_ws("\x01", "anchors", "content"))).alias("digest")
    rows = materialize(content_keys(keyed, speller).withColumn("digest", digest), "content")
    heads = rows.groupBy("digest", "anchors", "content").agg(F.min("call_id").alias("first_call"), F.count(F.lit(1)).alias("n"))
    heads = materialize(heads, "classes")
    fresh = materialize(index_rows(heads, speller.counts), "bands")
    links = materialize(linked(read_index(keyed.sparkSession, f"{path}/index", fresh), fresh), "links")
    found = heads.select("first_call", "digest", "n").join(links, "first_call", "left").select("digest", "n", F.coalesce("target", "first_call").alias("accepted_id"))
    # Ids rise with the batches, so what is smaller than the first id of a batch belongs to a smaller one.
    starts = rows.groupBy("batch_no").agg(F.min("call_id").alias("start"))
    total = heads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = attach(rows.select("digest", "call_id", "batch_no"), "digest", materialize(found, "targets"), "n", total).join(starts, "batch_no").filter("accepted_id < start")
    out = materialize(out.select("accepted_id", "call_id"), "repeats")
    append_index(fresh.join(links.filter("known"), "first_call", "left_anti").select(*fresh.columns), f"{path}/index")
    return out


def find_repeats(calls: DataFrame, id_col: str = "call_id", text_col: str = "querytext", batch_col: str = "batch_no") -> DataFrame:
    """(accepted_id BIGINT, call_id BIGINT): calls that ask what a call of a smaller batch asked, and that call.

    The batches go through a new history in GROUPS runs, smaller numbers first; the speller alone is fitted on all calls.
    Call ids rise with the batches, so the first call of a question is its smallest id and in its smallest batch. Null ids,
    batches and texts and texts without letter or digit give no row; repeats within a batch give none; extra columns are ignored.
    """
    keyed = materialize(canonical_calls(calls, id_col, text_col, batch_col), "calls")
    path = shared_path(keyed.sparkSession, "history")
    start_history(keyed, path)
    edges = sorted(set(keyed.approxQuantile("batch_no", [i / GROUPS for i in range(1, GROUPS)], 0.01)))
    ranges = [(low, high) for low, high in zip([None, *edges], [*edges, None])]
    runs = []
    for low, high in ranges:
        run = keyed
        if low is not None:
            run = run.filter(F.col("batch_no") > low)
        if high is not None:
            run = run.filter(F.col("batch_no") <= high)
        runs.append(add_batches(run, path))
    return reduce(DataFrame.unionByName, runs)
