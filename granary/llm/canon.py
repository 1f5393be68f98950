"""Canonical form of a short text: words and numbers only, named fields in one order."""

from __future__ import annotations

import unicodedata

import regex

WORDS = regex.compile(r"(?:[\p{L}\p{M}\p{Nd}]|(?<=\p{Nd})[./-](?=\p{Nd}))+")
HAS_WORD = regex.compile(r"[\p{L}\p{Nd}]")
#: The field labels of the call-centre form; others are learnt from the texts.
FORM_LABELS = ("crop", "problem", "stage", "village", "area acre", "previous crop", "soil", "product", "remark")
FIELD_MARKS = (";", "|", "\n", ",", "/", "\t", ".")
FIELD = regex.compile(r"[^\p{L}\p{M}\p{Nd}]*((?:[\p{L}\p{M}]+[ _]*){1,3}?)\s*(?:[:=]|->|(?<=\s)[-–—](?=\s))(.*)", regex.DOTALL)
FIELD_END = "\x01"
VALUE_START = "\x02"


def fold(text: str) -> str:
    """One Unicode composition and one letter case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())


def _marked_fields(folded: str) -> list[tuple[str, str]] | None:
    """Fields that are set apart by one kind of mark, each with a label mark of its own."""
    if ":" not in folded and "=" not in folded and "-" not in folded and "–" not in folded and "—" not in folded:
        return None
    for mark in FIELD_MARKS:
        if mark not in folded:
            continue
        fields = []
        for part in folded.split(mark):
            if not HAS_WORD.search(part):
                continue
            found = FIELD.fullmatch(part)
            if not found:
                fields = []
                break
            fields.append((" ".join(WORDS.findall(found[1].replace("_", " "))), " ".join(WORDS.findall(found[2]))))
        if len(fields) >= 2 and len({label for label, _ in fields}) == len(fields):
            return fields
    return None


def marked_labels(text: str) -> tuple[list[str], set[str]]:
    """(the labels of a text whose parts all have a label mark, else none; its different words)."""
    folded = fold(text)
    fields = _marked_fields(folded)
    return [label for label, _ in fields or ()], set(WORDS.findall(folded))


def _label_starts(words: list[str], labels: dict[str, list[tuple[str, ...]]]) -> list[tuple[int, int]]:
    starts, i = [], 0
    while i < len(words):
        for label in labels.get(words[i], ()):
            if tuple(words[i : i + len(label)]) == label:
                starts.append((i, len(label)))
                i += len(label) - 1
                break
        i += 1
    return starts


def _by_first(labels: tuple[str, ...]) -> dict[str, list[tuple[str, ...]]]:
    out: dict[str, list[tuple[str, ...]]] = {}
    for label in sorted(labels, key=lambda x: -len(x.split())):
        parts = tuple(label.split())
        out.setdefault(parts[0], []).append(parts)
    return out


_KNOWN = _by_first(FORM_LABELS)


def fields_of(folded: str, words: list[str], known=None) -> list[tuple[str, str]] | None:
    """The (label, value) pairs of a filled-in form, or None for other texts.

    A form has two or more fields with different labels, of which two at least, and half of all, are known labels:
    stray marks in prose make no form. The fields are read from their marks; where these don't set every field
    apart, a text that begins with a known label is cut at the known labels.
    """
    known = known or _KNOWN
    marked = _marked_fields(folded)
    if marked:
        named = sum(tuple(label.split()) in known.get(label.partition(" ")[0], ()) for label, _ in marked)
        if named >= 2 and 2 * named >= len(marked):
            return marked
    starts = _label_starts(words, known) if words[0] in known else []
    if len(starts) < 2 or starts[0][0] or len({tuple(words[i : i + n]) for i, n in starts}) < len(starts):
        return None
    ends = [i for i, _ in starts[1:]] + [len(words)]
    return [(" ".join(words[i : i + n]), " ".join(words[i + n : end])) for (i, n), end in zip(starts, ends)]


def known_labels(learnt: tuple[str, ...]) -> dict[str, list[tuple[str, ...]]]:
    """The labels of the call-centre form and learnt ones, for `canonical`."""
    return _by_first(tuple(dict.fromkeys((*FORM_LABELS, *learnt)))) if learnt else _KNOWN


def canonical(text: str | None, known=None) -> str | None:
    """The record that a text states, or None if it has neither letter nor digit.

    Equal results: equal words and numbers in equal order, whatever the white space, letter case, punctuation or
    Unicode composition; for forms, equal fields in any order. `known` has the labels, by default those of the call-centre form.
    """
    if text is None:
        return None
    folded = fold(text)
    words = WORDS.findall(folded)
    if not words or not HAS_WORD.search(folded):
        return None
    fields = fields_of(folded, words, known)
    if fields is None:
        return " ".join(words)
    return FIELD_END.join(f"{label}{VALUE_START}{value}" for label, value in sorted(fields))
