"""Queries with the DuckDB SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.functions.text import SPACE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '{SPACE}+', ' ', 'g')")


def sql_sentence_case(x: str) -> str:
    stop = f"[.!?]{SPACE}+[a-z]"
    each = f"list_transform(regexp_extract_all({x}, '{stop}|[^.!?]|[.!?]'), lambda t: case when regexp_matches(t, '^{stop}$') then upper(t) else t end)"
    joined = f"array_to_string({each}, '')"
    return f"(case when regexp_matches({x}, '^[a-z]') then upper(substr({x}, 1, 1)) || substr({joined}, 2) else coalesce({joined}, '') end)"


def sql_clean(x: str) -> str:
    flat = sql_strip(f"regexp_replace({sql_strip(f'coalesce({x}, $$$$)')}, '[\\r\\n\\t]+|{SPACE}{{2,}}', ' ', 'g')")
    return f"(select {sql_sentence_case('y')} from (select lower(nfc_normalize({flat})) as y))"


def sql_english(x: str) -> str:
    letters = f"length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))"
    return f"({letters} > 0 and length(regexp_replace({x}, '[^A-Za-z]', '', 'g')) * 10 >= {letters} * 8)"
