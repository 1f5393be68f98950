"""Hashes that other systems can compute again."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(text: Column) -> Column:
    """The first eight bytes of the MD5 hash as an unsigned little-endian number, written out."""
    digest = F.md5(F.encode(text, "UTF-8"))
    pairs = [F.substring(digest, i, 2) for i in range(15, 0, -2)]
    return F.conv(F.concat(*pairs), 16, 10)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def config_hash(config: dict) -> str:
    """The hash of a configuration, whatever the order of its keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()


def file_hash(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as lines:
        for block in iter(lambda: lines.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()
