"""Token counts by a public tokenizer, and the sources of documents under one spelling."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are; every executor needs the folder.
TOKENIZERS = os.environ.get("GRANARY_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary's text is cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoding(folder: str, vocabulary: str):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def one_spelling(source: Column) -> Column:
    """A source name in lower case with single underscores, null if blank."""
    bare = F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_")
    return F.when(bare != "", bare)


def document_tokens(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id BIGINT, source STRING, tokens BIGINT) of the documents with an id; a null text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(folder, vocabulary).encode_ordinary
        for batch in batches:
            counts = [len(encode(text)) if text else 0 for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "source", "tokens"])

    picked = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), one_spelling(F.col("source")).alias("source"), F.col("text").cast("string").alias("text"))
    return picked.filter("doc_id is not null").mapInArrow(run, "doc_id bigint, source string, tokens bigint")
