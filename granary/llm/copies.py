"""Problem 1: records that differ only in formatting, collapsed and counted.

Radix partitioning on the canonical bytes with a counting trie in each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.canon import canonical, known_labels, marked_labels
from granary.session import materialize

#: Depths in bytes at which a bucket may be cut; the next depth is only used below oversized prefixes.
FIRST_CUT = 4
#: A group of copies is hot from this share of all rows on, so there are at most HOT_SHARE hot groups.
HOT_SHARE = 1024
#: Entries of a local trie before it is emptied into the exchange.
LOCAL_ENTRIES = 50_000
BURST = 48
#: A label is learnt if it labels fields in this share of the texts with marks, in LABEL_LEAST at least, and in so large a share
#: of those that have its first word; so there are at most 1 / LABEL_SHARE times the fields of a text.
LABEL_SHARE, LABEL_LEAST, LABEL_RATE = 1e-4, 2, 0.5
BATCH = 8192


class _Node:
    __slots__ = ("children", "tails", "count", "least")

    def __init__(self) -> None:
        self.children: dict[int, _Node] | None = None
        self.tails: dict[bytes, list[int]] | None = {}
        self.count = 0
        self.least = 0


class CountingTrie:
    """A byte trie with terminal counters: copies and smallest id of each key.

    A node keeps up to BURST tails in one container before it branches by their next byte.
    """

    def __init__(self) -> None:
        self.root = _Node()
        self.entries = 0

    def add(self, key: bytes, count: int, least: int) -> None:
        node, at, size = self.root, 0, len(key)
        while node.children is not None:
            if at == size:
                self._end(node, count, least)
                return
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node()
            node, at = child, at + 1
        slot = node.tails.get(key[at:])
        if slot is None:
            node.tails[key[at:]] = [count, least]
            self.entries += 1
            if len(node.tails) > BURST:
                self._branch(node)
        else:
            slot[0] += count
            slot[1] = min(slot[1], least)

    def _end(self, node: _Node, count: int, least: int) -> None:
        self.entries += not node.count
        node.least = min(node.least, least) if node.count else least
        node.count += count

    def _branch(self, node: _Node) -> None:
        tails, node.tails, node.children = node.tails, None, {}
        for tail, (count, least) in tails.items():
            if not tail:
                node.count, node.least = count, least
                continue
            child = node.children.setdefault(tail[0], _Node())
            child.tails[tail[1:]] = [count, least]

    def items(self) -> Iterator[tuple[bytes, int, int]]:
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            if node.count:
                yield prefix, node.count, node.least
            if node.children is None:
                for tail, (count, least) in node.tails.items():
                    yield prefix + tail, count, least
            else:
                for byte, child in node.children.items():
                    stack.append((child, prefix + bytes((byte,))))


_COUNTED = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("keep_id", pa.int64())])


def _counted(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    keys, copies, least = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(copies, pa.int64()), pa.array(least, pa.int64())], schema=_COUNTED
    )


def _drain(trie: CountingTrie) -> Iterator[pa.RecordBatch]:
    rows = []
    for row in trie.items():
        rows.append(row)
        if len(rows) == BATCH:
            yield _counted(rows)
            rows = []
    if rows:
        yield _counted(rows)


def _count_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within one input partition, so that a hot record leaves it once and not once for each copy."""
    trie = CountingTrie()
    for batch in batches:
        for key, id_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            trie.add(key, 1, id_)
        if trie.entries > LOCAL_ENTRIES:
            yield from _drain(trie)
            trie = CountingTrie()
    yield from _drain(trie)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie for each bucket; the rows come sorted by bucket."""
    trie, bucket = CountingTrie(), None
    rows: list[tuple[bytes, int, int]] = []
    for batch in batches:
        for label, key, copies, least in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if label != bucket:
                rows.extend(trie.items())
                if len(rows) >= BATCH:
                    yield _counted(rows)
                    rows = []
                trie, bucket = CountingTrie(), label
            trie.add(key, copies, least)
    rows.extend(trie.items())
    for at in range(0, len(rows), BATCH):
        yield _counted(rows[at : at + BATCH])


def learn_labels(rows: DataFrame, text_col: str) -> tuple[str, ...]:
    """The field labels of forms: what stands before a label mark in texts whose parts all have one, and seldom elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: dict[str, int] = {}
        words: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            both = [(0, x, n) for x, n in labels.items()] + [(1, x, n) for x, n in words.items()]
            labels.clear()
            words.clear()
            kinds, names, counts = zip(*both) if both else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["kind", "name", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found, seen = marked_labels(text)
                for label in found:
                    labels[label] = labels.get(label, 0) + 1
                for word in seen:
                    words[word] = words.get(word, 0) + 1
            words[""] = words.get("", 0) + batch.num_rows
            if len(words) > LOCAL_ENTRIES:
                yield flush()
        yield flush()

    marked = rows.select(F.col(text_col).cast("string").alias("text")).filter(r"text rlike '[:=]|->|\\s[-–—]\\s'")
    counts = materialize(marked.mapInArrow(run, "kind int, name string, n bigint").groupBy("kind", "name").agg(F.sum("n").alias("n")), "labels")
    total = counts.filter("kind = 1 and name = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    labels = counts.filter(f"kind = 0 and name <> '' and n >= {max(LABEL_LEAST, int(LABEL_SHARE * total))}").select(F.col("name").alias("label"), F.col("n").alias("named"))
    words = counts.filter("kind = 1").select(F.col("name").alias("first"), "n")
    kept = labels.withColumn("first", F.substring_index("label", " ", 1)).join(words, "first").filter(F.col("named") >= LABEL_RATE * F.col("n"))
    return tuple(sorted(row["label"] for row in kept.collect()))


def canonical_rows(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key BINARY, id BIGINT): the canonical bytes of every text that has a letter or digit; labels of forms are learnt from all texts."""
    known = known_labels(learn_labels(rows, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = canonical(text, known)
                if key is not None:
                    keys.append(key.encode())
                    ids.append(id_)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "id"])

    picked = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.filter("id is not null and text is not null").mapInArrow(run, "key binary, id bigint")


def plan_buckets(keyed: DataFrame, total: int, fits: int) -> list[tuple[int, list[int]]]:
    """The oversized prefixes by depth: [(depth, hashes)], from FIRST_CUT on, each depth twice the last.

    A prefix is oversized if more than `fits` rows have it and some go on behind it; only below those are further
    bytes looked at. Each depth has fewer than total / fits of them, which bounds what the driver gets.
    """
    levels: list[tuple[int, list[int]]] = []
    left, depth = keyed.select("key"), FIRST_CUT
    while total > fits:
        head = F.xxhash64(F.substring("key", 1, depth))
        found = (
            left.filter(F.length("key") > depth)
            .groupBy(head.alias("head"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .filter((F.col("n") > fits) & (F.col("low") != F.col("high")))
            .select("head")
            .collect()
        )
        if not found:
            break
        hashes = [row["head"] for row in found]
        levels.append((depth, hashes))
        left = left.filter((F.length("key") > depth) & head.isin(hashes))
        depth *= 2
    return levels


def bucket_label(levels: list[tuple[int, list[int]]]):
    """The bucket of a key: its bytes up to the cut behind its longest oversized prefix."""
    label = F.substring("key", 1, FIRST_CUT)
    for depth, hashes in levels:
        inside = (F.length("key") > depth) & F.xxhash64(F.substring("key", 1, depth)).isin(hashes)
        label = F.when(inside, F.substring("key", 1, depth * 2)).otherwise(label)
    return label


def count_copies(keyed: DataFrame, fits: int | None = None) -> DataFrame:
    """(key BINARY, copies BIGINT, keep_id BIGINT): one row for each different key of (key, id) rows.

    Buckets of the radix partitioning hold at most `fits` rows, unless they are copies of one key, which the tries
    of the input partitions have already collapsed; by default an eighth of a shuffle partition's share.
    """
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = keyed.count()
    fits = fits or max(10_000, -(-total // (parts * 8)))
    levels = plan_buckets(keyed, total, fits)
    local = keyed.select("key", "id").mapInArrow(_count_locally, "key binary, copies bigint, keep_id bigint")
    return (
        local.select(bucket_label(levels).alias("bucket"), "key", "copies", "keep_id")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_count_buckets, "key binary, copies bigint, keep_id bigint")
    )


def collapse_copies(rows: DataFrame, id_col: str = "call_id", text_col: str = "querytext") -> DataFrame:
    """(keep_id BIGINT, record STRING, copies BIGINT): one row for each different record, with its number of copies.

    `keep_id` is the smallest id of the record. Rows with a null id, a null text or a text without letter or digit are
    left out; an empty table gives an empty result; a row that comes twice counts twice; other columns are ignored.
    """
    keyed = materialize(canonical_rows(rows, id_col, text_col), "records")
    return count_copies(keyed).select("keep_id", F.col("key").cast("string").alias("record"), "copies")


def find_copies(rows: DataFrame, id_col: str = "call_id", text_col: str = "querytext") -> DataFrame:
    """(keep_id BIGINT, call_id BIGINT): each row whose text is the same record as that of a smaller id.

    Null ids and texts and texts without letter or digit give no row, and so does a repeated row of one id. The rows of
    a group find their `keep_id` by the digest of the key: the hot groups, at most HOT_SHARE by their definition, by a
    broadcast, the others, none of which is large, by a shuffle of digest and id.
    """
    keyed = materialize(canonical_rows(rows, id_col, text_col), "records")
    total = keyed.count()
    digest = F.unhex(F.md5("key")).alias("digest")
    groups = materialize(count_copies(keyed).filter("copies > 1").select(digest, "copies", "keep_id"), "groups")
    hot_from = max(1, total // HOT_SHARE)
    hot = groups.filter(F.col("copies") > hot_from).select("digest", F.col("keep_id").alias("hot_id"))
    cold = groups.filter(F.col("copies") <= hot_from).select("digest", "keep_id")
    marked = keyed.select(digest, "id").join(F.broadcast(hot), "digest", "left")
    in_hot = marked.filter("hot_id is not null").select(F.col("hot_id").alias("keep_id"), "id")
    in_cold = marked.filter("hot_id is null").select("digest", "id").join(cold, "digest").select("keep_id", "id")
    return in_hot.unionByName(in_cold).filter("id <> keep_id").select("keep_id", F.col("id").alias("call_id"))
