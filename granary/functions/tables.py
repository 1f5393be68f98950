"""Repair of tables in extracted page text: broken markdown blocks, and tables flattened into list records."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

STATS = ("unwrapped_images", "dropped_artifacts", "kept_tables", "rebuilt_flattened")
RESULT = "struct<text:string," + ",".join(f"{s}:bigint" for s in STATS) + ">"

#: The forms of numbers, records, images, headings and labels, and the limits of a cluster.
NUMBER = re.compile(r"-?\d[\d,]*(?:\.\d+)?%?")
RECORD = re.compile(r"\s*[-•*]\s+(\d{1,3})[.)]?\s+(\S.*)")
IMAGE = re.compile(r"!\[[^\]]*\]\([^)]*\)")
HEADING = re.compile(r"#{1,6}\s+")
MID_SENTENCE = re.compile(r"\.\s+[A-Z]")
LABEL = re.compile(r"[A-Za-z()%&/.+-]+")
RULE = re.compile(r"\s*\|[\s:\-|]*\|?\s*")
BREAK = re.compile(r"<br\s*/?>", re.IGNORECASE)
HINTS, ALL_HINTS, HINT_SIZE, HINT_WORDS, RECORDS, GAP, VALUE_GAP = 15, 20, 90, 10, 3, 3, 2
EMPTY_SHARE = 0.4
NOTE = "[Recovered table header/caption fragments (source formatting was fragmented):]"


def _values(words: list[str]) -> int:
    """How many numbers a list of words ends with."""
    n = 0
    while n < len(words) and NUMBER.fullmatch(words[-1 - n]):
        n += 1
    return n


@dataclass
class _Line:
    """What one line may be in a flattened table."""

    bare: str
    words: list[str] = field(init=False)
    record: re.Match | None = field(init=False)

    def __init__(self, line: str) -> None:
        self.bare = line.strip()
        self.words = self.bare.split()
        self.record = RECORD.fullmatch(line)

    @property
    def numbers(self) -> list[str] | None:
        return self.words if len(self.words) >= 2 and _values(self.words) == len(self.words) else None

    @property
    def summary(self) -> tuple[str, list[str]] | None:
        n = _values(self.words)
        label = self.words[: len(self.words) - n]
        if n >= 2 and 1 <= len(label) <= 4 and all(LABEL.fullmatch(w) for w in label):
            return " ".join(label), self.words[len(label) :]
        return None

    @property
    def hint(self) -> bool:
        if not self.bare or len(self.bare) > HINT_SIZE or HEADING.match(self.bare) or IMAGE.fullmatch(self.bare):
            return False
        few = len(self.words) <= 3
        return any(c.isalpha() for c in self.bare) and len(self.words) <= HINT_WORDS and (few or not MID_SENTENCE.search(self.bare))


class _Cluster:
    """Records with their values, summary rows and stray header lines, from the first record's line on."""

    def __init__(self, lines: list[_Line], start: int) -> None:
        self.lines, self.start, self.at = lines, start, start
        self.rows: list[tuple[str, str, list[str]]] = []
        self.totals: list[tuple[str, list[str]]] = []
        self.hints: list[str] = []

    def _blank_run(self, most: int) -> bool:
        """Moves over blank lines; false if there are more than `most` (then `at` is the first one too many)."""
        seen = 0
        while self.at < len(self.lines) and not self.lines[self.at].bare:
            seen += 1
            if seen > most:
                return False
            self.at += 1
        return True

    def _record(self) -> bool:
        serial, rest = self.lines[self.at].record.groups()
        words = rest.split()
        n = _values(words)
        name, values = words[: len(words) - n], words[len(words) - n :]
        self.at += 1
        while self._blank_run(VALUE_GAP) and self.at < len(self.lines) and (more := self.lines[self.at].numbers):
            values += more
            self.at += 1
        if name:
            self.rows.append((serial, " ".join(name), values))
        return bool(name)

    def read(self) -> bool:
        """Whether a table of RECORDS records or more begins here."""
        if not self._record():
            return False
        while self._blank_run(GAP) and self.at < len(self.lines):
            line = self.lines[self.at]
            if line.record:
                if not self._record():
                    break
                continue
            if line.numbers:
                self.rows[-1][2].extend(line.numbers)
            elif line.summary:
                self.totals.append(line.summary)
            elif len(self.hints) < HINTS and line.hint:
                self.hints.append(line.bare)
            else:
                break
            self.at += 1
        self.width = Counter(len(v) for _, _, v in self.rows).most_common(1)[0][0]
        return len(self.rows) >= RECORDS and self.width >= 2 and self._above()

    def _above(self) -> bool:
        """Header lines above the first record, with single blank lines between; false if there are too many in all."""
        found: list[str] = []
        at, blank = self.start - 1, 0
        while at >= 0 and len(found) < HINTS:
            line = self.lines[at]
            blank = 0 if line.bare else blank + 1
            if blank > 1 or (line.bare and not line.hint):
                break
            if line.bare:
                found.append(line.bare)
            at -= 1
        self.top = at + 1
        self.hints = list(dict.fromkeys(found[::-1] + self.hints))
        return len(self.hints) <= ALL_HINTS

    def markdown(self) -> list[str]:
        names = ["No.", "Item", *(f"Field {i}" for i in range(1, self.width + 1))]
        cells = [[no, item, *values[: self.width]] for no, item, values in self.rows]
        cells += [["", label, *values[: self.width]] for label, values in self.totals]
        table = [names, *(row + [""] * (len(names) - len(row)) for row in cells)]
        drawn = ["| " + " | ".join(row) + " |" for row in table]
        head = [NOTE, *self.hints, ""] if self.hints else []
        return [*head, drawn[0], "|" + "---|" * len(names), *drawn[1:]]


def rebuild_flattened(text: str) -> tuple[str, int]:
    """Tables out of list records; header lines found around them come first."""
    raw = text.split("\n")
    lines = [_Line(x) for x in raw]
    out: list[str] = []
    at = rebuilt = 0
    while at < len(raw):
        cluster = _Cluster(lines, at) if lines[at].record else None
        if cluster and cluster.read():
            del out[max(0, len(out) - (at - cluster.top)) :]
            out += cluster.markdown()
            at, rebuilt = cluster.at, rebuilt + 1
        else:
            out.append(raw[at])
            at += 1
    return "\n".join(out), rebuilt


def _is_row(line: str) -> bool:
    return line.lstrip().startswith("|")


def _cells(row: str) -> list[str]:
    return [c.strip() for c in row.strip().removeprefix("|").removesuffix("|").split("|")]


def _blocks(lines: list[str]) -> list[tuple[bool, list[str]]]:
    """The lines in groups: (table block, its lines); stray breaks within a table belong to it."""
    inside, marks = False, []
    for line in lines:
        junk = bool(line.strip()) and not _is_row(line) and bool(BREAK.search(line) or RULE.fullmatch(line.strip()))
        inside = _is_row(line) or (inside and junk)
        marks.append(inside)
    return [(kind, [line for _, line in group]) for kind, group in groupby(zip(marks, lines), key=lambda x: x[0])]


def _mend(block: list[str], stats: Counter) -> list[str]:
    rows = [r for r in block if not re.fullmatch(r"\s*\|[\s:\-|]*\|\s*", r)]
    if not rows:
        return block
    images = [IMAGE.search(r) for r in rows if re.fullmatch(r"\s*\|?\s*" + IMAGE.pattern + r"\s*\|?\s*", r)]
    if len(images) == len(rows):
        stats["unwrapped_images"] += len(images)
        return [m[0] for m in images]
    cells = [_cells(r) for r in rows]
    flat = [c for row in cells for c in row]
    if len({len(row) for row in cells}) > 1 or flat.count("") > EMPTY_SHARE * len(flat):
        stats["dropped_artifacts"] += 1
        return []
    stats["kept_tables"] += 1
    if any("<br" in r.lower() for r in rows):
        return [BREAK.sub("; ", r) for r in rows] + [""] * (len(block) - len(rows))
    return block


def mend_blocks(text: str) -> tuple[str, Counter]:
    """Image tables unwrapped, ragged or mostly empty tables dropped, breaks in good ones written as semicolons."""
    stats: Counter = Counter()
    kept = [line for table, block in _blocks(text.split("\n")) for line in (_mend(block, stats) if table else block)]
    filled = [i for i, line in enumerate(kept) if line.strip()]
    out: list[str] = []
    for i, line in enumerate(kept):
        bare = line.strip()
        if not _is_row(bare) and BREAK.search(bare):
            continue
        if not _is_row(bare) and RULE.fullmatch(line):
            before = next((x for x in reversed(out) if x.strip()), "")
            after = next((kept[j] for j in filled if j > i), "")
            if not _is_row(before) and not _is_row(after):
                continue
        out.append(line)
    return "\n".join(out), stats


def repair_text(text: str) -> dict:
    mended, stats = mend_blocks(text)
    whole, rebuilt = rebuild_flattened(mended)
    return {"text": whole, **{s: stats.get(s, 0) for s in STATS[:3]}, "rebuilt_flattened": rebuilt}


def _repair(texts: pd.Series) -> pd.DataFrame:
    rows = [repair_text(t) if t is not None else dict.fromkeys(("text", *STATS)) for t in texts]
    return pd.DataFrame(rows, columns=["text", *STATS])


def repair_tables(text: Column) -> Column:
    """struct<text, unwrapped_images, dropped_artifacts, kept_tables, rebuilt_flattened>; nulls for a null text."""
    return F.pandas_udf(_repair, RESULT)(text)
