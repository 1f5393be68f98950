"""Scalar text functions, Column to Column. Unless a docstring says otherwise a null text gives null."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: Unicode white space as a character class that Java and RE2 both read.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters as a string, for trimming without a regular expression.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Fixed value: what counts as a word character beside white space, slash, percent sign and hyphen.
NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Pc}\s/%-]"
#: A number, and an embedded image.
NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)?"
IMAGE = r"!\[.*?\]\(data:image/[^;]+;base64,[^\)]+\)"
#: Phrases that refer to a source text in a question.
META_PHRASES = (
    r"(?i)\baccording to (the|this) (text|chapter|content|document|passage|book|article),?\s*",
    r"(?i)\bbased on (the|this) (provided|given)?\s*(text|content|document|passage|chapter|book|article),?\s*",
    r"(?i)\bas (mentioned|stated|described|discussed) in (the|this) (text|chapter|content|document|passage),?\s*",
    r"(?i)\bfrom the (provided|given)?\s*(text|content|document|passage|chapter),?\s*",
)


def _composed(form: str):
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize(form, t))

    return run


def _mapped(function):
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function)

    return run


def _normal(text: Column, form: str) -> Column:
    """Only texts beyond ASCII travel to Python."""
    return F.coalesce(F.pandas_udf(_composed(form), "string")(F.when(text.rlike(r"[^\x00-\x7f]"), text)), text)


def nfc(text: Column) -> Column:
    """Canonical composition (an Arrow function; Spark has none built in)."""
    return _normal(text, "NFC")


def nfkc(text: Column) -> Column:
    """Compatibility composition."""
    return _normal(text, "NFKC")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def squeeze(text: Column) -> Column:
    """Single blanks, none at the ends."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def sentence_case(text: Column) -> Column:
    """Capitals at the start and behind a full stop, question or exclamation mark with blanks; only a to z change."""
    # Each piece but the first begins with a stop.
    opening = rf"^[.!?]{SPACE}+[a-z]"

    def raise_first(piece: Column) -> Column:
        head = F.regexp_extract(piece, opening, 0)
        return F.when(head != "", F.concat(F.upper(head), F.substring(piece, F.length(head) + 1, F.length(piece)))).otherwise(piece)

    raised = F.transform(F.split(text, r"(?=[.!?])"), raise_first)
    whole = F.array_join(raised, "")
    return F.when(text.rlike("^[a-z]"), F.concat(F.upper(F.substring(text, 1, 1)), F.substring(whole, 2, 2**30))).otherwise(whole)


def clean_text(text: Column, composed: bool = False) -> Column:
    """Ends stripped, runs of blanks and breaks to one blank, composed, lower case, then sentence case; null gives ''.

    With `composed` the text is taken to be in canonical composition, and the expression stays free of Python.
    """
    flat = strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), rf"[\r\n\t]+|{SPACE}{{2,}}", " "))
    return sentence_case(F.lower(flat if composed else nfc(flat)))


def is_english(text: Column, tenths: int = 8) -> Column:
    """Whether at least `tenths` of ten letters are ASCII; false without letters or for null."""
    letters, ascii_letters = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit("[A-Za-z]"))
    return F.coalesce((letters > 0) & (ascii_letters * 10 >= letters * tenths), F.lit(False))


def clean_punctuation(text: Column) -> Column:
    """Each character that is no word character, white space, slash, percent sign or hyphen becomes a blank."""
    return F.regexp_replace(text, NOT_WORD, " ")


def escaped(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9_\s\u0080-\U0010ffff])", r"\\\1", literal)


def strip_prefix(text: Column, prefixes: list[str]) -> Column:
    """The longest listed prefix at the start removed once, with the blanks behind it.

    One hash lookup for each different length of a prefix, however many there are of it.
    """
    by_length: dict[int, list[str]] = {}
    for prefix in sorted({p for p in prefixes if p}):
        by_length.setdefault(len(prefix), []).append(prefix)
    if not by_length:
        return text
    size = F.coalesce(*[F.when(F.substring(text, 1, n).isin(by_length[n]), F.lit(n)) for n in sorted(by_length, reverse=True)])
    return F.when(size.isNotNull(), F.regexp_replace(F.substring(text, size + 1, F.length(text)), r"^\s+", "")).otherwise(text)


_RUN = re.compile(r"\w+")


class TermReplacer:
    """Ordered whole-word replacements, each on the result of the last, by an index on the keys' first words.

    A key can only match where its first run of word characters is a whole word of the text, so a text meets the few
    rules of its own words and not all of them.
    """

    def __init__(self, ordered: list[tuple[str, str]]) -> None:
        self.rules = ordered
        self.patterns: dict[int, re.Pattern] = {}
        self.by_word: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, (key, _) in enumerate(ordered):
            first = _RUN.search(key)
            (self.by_word.setdefault(first[0], []) if first else self.always).append(i)

    def __call__(self, text: str | None) -> str | None:
        done = -1
        while text is not None:
            near = sorted({i for w in set(_RUN.findall(text)) for i in self.by_word.get(w, ()) if i > done} | {i for i in self.always if i > done})
            for i in near:
                key, value = self.rules[i]
                pattern = self.patterns.get(i) or self.patterns.setdefault(i, re.compile(rf"\b{re.escape(key)}\b"))
                changed, n = pattern.subn(lambda _, v=value: v, text)
                done = i
                if n and changed != text:
                    text = changed
                    break
            else:
                return text
        return None


def replace_terms(text: Column, replacements: dict[str, str]) -> Column:
    """Whole-word replacements one after another, the longest key first; each works on the result of the last.

    An Arrow function at every number of rules: word boundaries are those of Unicode, which Java's are not, and a text meets
    only the rules of its own words, which a fold over all of them could not give.
    """
    ordered = sorted(replacements.items(), key=lambda kv: -len(kv[0]))
    return F.pandas_udf(_mapped(TermReplacer(ordered)), "string")(text) if ordered else text


def numeric_anchors(text: Column) -> Column:
    """How many numbers a text has."""
    return F.regexp_count(text, F.lit(NUMBER))


def anchor_target(text: Column) -> Column:
    """Four fifths of the numbers outside figure notes, at least one."""
    bare = F.regexp_replace(text, r"\[FIGURE \d+:.*?\]", "")
    return F.greatest(F.floor(numeric_anchors(bare) * 4 / 5), F.lit(1))


def anchor_retention(source: Column, output: Column) -> Column:
    """Numbers of the output for each number of the source, at most 1.5, three decimals; 1 if the source has none."""
    n, m = numeric_anchors(source), numeric_anchors(output)
    return F.round(F.when(n > 0, F.least(m / n, F.lit(1.5))).otherwise(F.lit(1.0)), 3)


def clean_page(text: Column, headers: list[str]) -> Column:
    """A page without blank lines, lines of digits only and lines that contain a header in any case."""
    kept = F.filter(F.transform(F.split(text, "\n"), strip), lambda line: (line != "") & ~line.rlike(r"^\p{Nd}+$"))
    if headers:
        listed = F.array(*[F.lit(h.lower()) for h in headers])
        kept = F.filter(kept, lambda line: ~F.exists(listed, lambda h: F.contains(F.lower(line), h)))
    return F.array_join(kept, "\n")


def clean_chapter(text: Column) -> Column:
    """Embedded images to [Image], stray image data dropped, at most one blank line in a row; null gives ''."""
    data = r"data:image/[^;]+;base64,[A-Za-z0-9+/=\s]+"
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), rf"!\[.*?\]\({data}\)", "[Image]")
    return strip(F.regexp_replace(F.regexp_replace(marked, data, ""), r"\n{3,}", "\n\n"))


def clean_question(question: Column) -> Column:
    """A question without phrases that refer to a source text, its first letter a capital."""
    out = question
    for phrase in META_PHRASES:
        out = F.regexp_replace(out, phrase, "")
    out = strip(out)
    return F.when(out.rlike(r"^\p{Ll}"), F.concat(F.upper(F.substring(out, 1, 1)), F.substring(out, 2, 2**30))).otherwise(out)


def strip_fence(text: Column) -> Column:
    """The content of a text that is one fenced code block; other texts stripped only."""
    bare = strip(text)
    inner = F.regexp_replace(F.regexp_replace(bare, r"^```(?:json)?\n", ""), r"\n```$", "")
    return F.when(F.startswith(bare, F.lit("```")), inner).otherwise(bare)


def strip_fence_lines(text: Column) -> Column:
    """A stripped text without its first line if that opens a fence of any language, and without a last line that closes one."""
    bare = strip(text)
    inner = strip(F.regexp_replace(F.regexp_replace(bare, r"^```[^\n]*(?:\n|$)", ""), r"(?:^|\n)[ \t]*```[ \t]*$", ""))
    return F.when(F.startswith(bare, F.lit("```")), inner).otherwise(bare)


def strip_fence_marks(text: Column) -> Column:
    """A stripped text without the marks of a fence: with a language of letters or none before it, line breaks or none."""
    bare = strip(text)
    inner = F.regexp_replace(F.regexp_replace(bare, r"^```[a-zA-Z]*\n?", ""), r"\n?```$", "")
    return F.when(F.startswith(bare, F.lit("```")), inner).otherwise(bare)


def safe_filename(name: Column) -> Column:
    """A name without the characters that file systems forbid."""
    return strip(F.regexp_replace(name, r'[\\/*?:"<>|]', ""))


def html_text(text: Column) -> Column:
    """No-break spaces and runs of blanks to single blanks."""
    return squeeze(F.coalesce(text, F.lit("")))


def shorten(text: Column, most: int = 3000) -> Column:
    """Longer texts cut, with three dots."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def strip_markers(text: Column) -> Column:
    """A text without <bos> at its start and <eos> at its end."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), "^<bos>", ""), "<eos>$", ""))


def drop_images(text: Column) -> Column:
    return F.regexp_replace(text, IMAGE, "")


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMM")
