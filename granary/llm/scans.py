"""Problem 5: noise in text from scanned pages.

The words of all pages give a lexicon; confusions of the scanner are learnt by aligning odd words with it; an averaged
perceptron then predicts for each character of a word whether to keep, replace or delete it or to insert one before it, and
for each mark at the end of a line whether it joins the line with the next one. Running headers and page numbers are told by
their place on the page, their form, and their repetition over the pages of the book. The repair takes that noise out and puts the lines of each book
together as paragraphs.
"""

from __future__ import annotations

import random
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.skew import attach
from granary.llm.slips import shortened, slips_within
from granary.operators.ids import with_row_ids
from granary.session import materialize

#: A word belongs to the lexicon from this count, and this share of all words on; so the share bounds the lexicon.
LEXICON_LEAST = 5
LEXICON_SHARE = 1e-6
#: Odd words that the scanner's confusions are learnt from: a bounded sample by hash.
ODD_SAMPLE = 8_000
#: A confusion counts if it makes up this share of the aligned changes.
CONFUSION_SHARE = 0.002
#: A letter that is only lost or added counts from this share on.
GAP_SHARE = 0.02
#: A lexicon word is a misreading of another one that is so many times as frequent and that the editor turns it into.
MISREAD_TIMES = 15
EPOCHS = 3
#: The perceptron also learns from the commonest words, clean and spoilt, and from so many compounds and divided words.
CLEAN_SAMPLE = 4_000
JOIN_SAMPLE = 4_000
#: Tokens that a task remembers as clean before it forgets them.
REMEMBERED = 1_000_000
#: Lines from the top and bottom of a page that may be furniture.
EDGE_LINES = 2
#: A short line repeated so often at the pages' edges of a book is one of its titles.
TITLE_LEAST = 3

#: Confusions that spoil too few words to be learnt from them.
KNOWN_CONFUSIONS = {("m", "rn")}
HYPHEN = "-‐‑–—¬­"
LINE_BREAK = regex.compile(rf"(\S*?\p{{L}}\S*?)([{HYPHEN}])[ \t ]*\Z")
STRIP_LEFT = regex.compile(r"\A[\s(\[{\"'“‘|*•.,;:]+")
STRIP_RIGHT = regex.compile(r"[\s)\]}\"'”’|.,;:?]+\Z")
WORD = regex.compile(r"\p{L}+(?:['’]\p{L}+)*\Z")
COMPOUND = regex.compile(r"\p{L}+(?:-\p{L}+)+\Z")
NUMBER = regex.compile(r"\p{Nd}+(?:[.,:/]\p{Nd}+)*%?\Z")
#: Characters that are read for digits.
DIGIT_LIKE = {"O": "0", "o": "0", "l": "1", "I": "1", "|": "1", "!": "1", "i": "1", "B": "8", "S": "5", "s": "5", "Z": "2", "z": "2", "G": "6", "b": "6", "g": "9", "q": "9", "€": "6", "@": "0"}
FIGURE_LETTERS = regex.compile(r"(?=.*[OI]|ll)[lOIo]{2,4}\Z")
_FIGURE = r"[\p{Nd}OolISBZ|]{1,6}"
PAGE_NUMBER = regex.compile(
    rf"[\s\-–—*~.\[({{<|]*(?:(?:page|pg|p)\b[\s.]*)?(?:{_FIGURE}(?:\s*(?:/|of)\s*{_FIGURE})?|[ivxlcdm]{{1,8}}|[IVXLCDM]{{1,8}})[\s\-–—*~.\])}}>|]*", regex.IGNORECASE
)
HAS_FIGURE = regex.compile(r"\p{Nd}|^[\W_]*[ivxlcdmIVXLCDM]+[\W_]*$|^[\W_]*(?:page|pg|p)?[\W_]*[lOoI]{1,3}[\W_]*(?:/|$)", regex.IGNORECASE)
CHAPTER_HEADING = regex.compile(r"\s*\p{L}\S{4,7}\s+\S{1,4}\s*:\s*(\S.*)")
RUNNING_PARTS = regex.compile(r"^[\W\p{Nd}]*(?:\b(?:chapter|ch|part|section)\b[\W\p{Nd}]*)?|[\W\p{Nd}]+$", regex.IGNORECASE)
LETTERS = regex.compile(r"[^\W_]+")
ITEM = regex.compile(r"[-•*]\s*\p{Nd}")
DECIMAL = regex.compile(r"\p{Nd}+\.\p{Nd}+")
TITLE_WORD = regex.compile(r"\p{L}\S{3,}|\S\p{L}{3,}")
#: Lines that stay lines of their own: table rows, rules, list items.
ROW = regex.compile(r"\s*(?:\|.*|.*\|.*\|.*|[-=_+|\s]{3,}|.*\S\s{2,}\S.*\s{2,}[\p{Nd}.,%]+\s*|(?:[-•*]|\(?[\p{Nd}]{1,3}[.)])\s+\S.*)")
SENTENCE_END = regex.compile(r"[.!?…:]['\")\]”’]*\Z")
#: Fragments in one window of the running paragraph number.
STRETCH = 65_536


@lru_cache(300_000)
def core(token: str) -> str:
    """A token without the marks around it."""
    return STRIP_RIGHT.sub("", STRIP_LEFT.sub("", token))


@lru_cache(300_000)
def lower_core(token: str) -> tuple[str, bool]:
    """`core` in lower case, and whether it is a compound."""
    word = core(token).lower()
    return word, bool(COMPOUND.match(word))


class Editor:
    """An averaged perceptron over the characters of a word, with labels K (keep), D (delete), R:x (replace by x, alone or with
    the next character) and I:x (insert x before it); and over the ends of lines, with labels J (join) and K.

    `options` has the changes (read, true) that may be tried where a text is read; a read of '' is an insertion, a true text
    of '' a deletion.
    """

    def __init__(self, lexicon: dict[str, int], compounds: dict[str, int], weights: dict[str, dict[str, float]], options: dict[str, list[tuple[str, str]]], ends: dict[str, float] | None = None) -> None:
        self.lexicon, self.compounds, self.weights, self.options, self.ends = lexicon, compounds, weights, options, ends
        self.words = sorted(lexicon)
        self.signs = {a for a in options if len(a) == 1 and not a.isalpha()} | {c for a in options if len(a) > 1 for c in a if not c.isalnum()}
        self.read = lru_cache(200_000)(self._read)
        self.misread = lru_cache(300_000)(self._misread)
        self.clean: set[str] = set()

    def __reduce__(self):
        return Editor, (self.lexicon, self.compounds, self.weights, self.options, self.ends)

    @staticmethod
    def features(word: str, i: int) -> list[str]:
        a, b, c, d, e = (word[j] if 0 <= j < len(word) else "^" for j in (i - 2, i - 1, i, i + 1, i + 2))
        return [f"c{c}", f"p{b}{c}", f"n{c}{d}", f"w{b}{c}{d}", f"l{a}{b}{c}", f"r{c}{d}{e}", f"x{b}{d}", f"k{c.isalpha()}{b.isalpha()}{d.isalpha()}"]

    def score(self, features: list[str], label: str) -> float:
        return sum(w.get(label, 0.0) for f in features if (w := self.weights.get(f)))

    def candidates(self, word: str) -> list[tuple[float, str, tuple[int, ...]]]:
        """All readings of a word that the lexicon has, by falling score: (score against keeping all, reading, places changed).

        A walk over the changes that only goes on where some word of the lexicon begins like that. A letter that is only
        lost or added makes another word more often than a misreading, so such a reading must score better than the word kept.
        """
        words, size = self.words, len(word)
        done: dict[str, tuple[float, tuple[int, ...]]] = {}
        feats: dict[int, list[str]] = {}
        inserts = self.options.get("", ())

        def gain(i: int, label: str) -> float:
            if i not in feats:
                feats[i] = self.features(word, i)
            return self.score(feats[i], label) - self.score(feats[i], "K")

        stack: list[tuple[int, str, float, tuple[int, ...], bool]] = [(0, "", 0.0, (), False)]
        while stack:
            i, text, total, places, gap = stack.pop()
            at = bisect_left(words, text)
            if at == len(words) or not words[at].startswith(text):
                continue
            if i == size:
                if places and words[at] == text and not (gap and total <= 0) and (text not in done or total > done[text][0]):
                    done[text] = (total, places)
                continue
            stack.append((i + 1, text + word[i], total, places, gap))
            for n in (2, 1):
                for _, b in self.options.get(word[i : i + n], ()) if i + n <= size else ():
                    change = gain(i, f"R:{b}" if b else "D") + (gain(i + 1, "D") if n == 2 else 0.0)
                    stack.append((i + n, text + b, total + change, (*places, i), gap or not b))
            if not places or places[-1] != i:  # one insertion at a place
                for _, b in inserts:
                    stack.append((i, text + b, total + gain(i, f"I:{b}"), (*places, i), True))
        return sorted(((total, text, places) for text, (total, places) in done.items()), key=lambda x: (-x[0], x[1]))

    def _read(self, word: str) -> tuple[str, tuple[int, ...]] | None:
        """The lexicon word or number that a token not in the lexicon is a misreading of, with the places changed."""
        lower = word.lower()
        if not lower or lower in self.lexicon or lower in self.compounds or NUMBER.match(word):
            return None
        if FIGURE_LETTERS.match(word):
            return "".join(DIGIT_LIKE[ch] for ch in word), tuple(range(len(word)))
        if any(ch.isdigit() for ch in word) and all(ch.isdigit() or ch in DIGIT_LIKE or ch in ".,/" for ch in word):
            places = tuple(i for i, ch in enumerate(word) if not ch.isdigit() and ch not in ".,/")
            figure = "".join(DIGIT_LIKE.get(ch, ch) for ch in word)
            if NUMBER.match(figure) and not (len(places) >= len(word) - 1 and len(word) > 3):
                return figure, places
        if len(lower) < 3:
            return None
        for _, text, places in self.candidates(lower):
            return text, places
        plain = lower.replace("\\/", "v")  # a w may be read as v\/, which takes two changes at one place
        if plain != lower and ("\\/", "v") in self.options.get("\\/", ()) and (plain in self.lexicon or (further := self.read(plain))):
            return (plain, (lower.index("\\/"),)) if plain in self.lexicon else further
        return None

    def odd_sign(self, word: str) -> bool:
        """Whether a sign that the scanner puts for letters stands inside a word."""
        return any(ch in self.signs and 0 < i < len(word) - 1 and word[i - 1].isalpha() and word[i + 1].isalpha() for i, ch in enumerate(word) if not ch.isalnum())

    def _misread(self, token: str) -> bool:
        """Whether a token is, or has a part that is, wrongly recognised."""
        word = core(token)
        if not word:
            return False
        if self.read(word):
            return True
        if "-" in word and not COMPOUND.match(word):
            return any(self.read(part) for part in word.split("-") if part)
        if COMPOUND.match(word) and word.lower() not in self.compounds:
            return any(self.read(part) for part in word.split("-"))
        bare = word.rstrip("!")
        return self.odd_sign(bare) and not any(ch in "@/\\" for ch in bare) and bare.lower() not in self.lexicon

    def repaired(self, token: str, opening: bool) -> str:
        """A token as it should read; `opening` if it begins a sentence, which tells the case of a misread first letter."""
        word = core(token)
        if not word or not self.misread(token):
            return token

        def part(piece: str, first: bool) -> str:
            found = self.read(piece) if piece else None
            if not found:
                return piece
            text, places = found
            letters = [ch for ch in piece if ch.isalpha()]
            if len(letters) > 1 and all(ch.isupper() for ch in letters) and not text.isdigit():
                return text.upper()
            return text[:1].upper() + text[1:] if (first if 0 in places else piece[0].isupper()) else text

        whole = self.read(word)
        mended = part(word, opening) if whole else "-".join(part(x, opening and not i) for i, x in enumerate(word.split("-")))
        at = STRIP_LEFT.match(token)
        start = at.end() if at else 0
        return token[:start] + mended + token[start + len(word) :]

    def spoilt(self, tokens: list[str]) -> bool:
        """Whether one of the tokens is misread; clean ones are remembered."""
        new = set(tokens) - self.clean
        if not new:
            return False
        bad = {t for t in new if self.misread(t)}
        if len(self.clean) > REMEMBERED:
            self.clean.clear()
        self.clean |= new - bad
        return bool(bad)

    def end_features(self, head: str, mark: str, tail: str, after: str, known: bool = True) -> list[str]:
        """What the end of a line shows: its mark, and whether word, compound, halves and compound with the word behind are known.

        Without `known` the counts of whole and compound are left out, as for words that are not in the lexicon.
        """
        plain = mark == "-"
        whole, compound = (self.lexicon.get(head + tail, 0), self.compounds.get(f"{head}-{tail}", 0)) if known else (0, 0)
        if whole or compound:
            seen = f"{bool(whole)}{bool(compound)}{whole >= compound}"
            follows = "" if not after else str(f"{head}-{tail} {after}" in self.compounds)
            return [f"m{plain}", f"s{seen}", f"sm{seen}{plain}", f"sf{seen}{plain}{follows}"]
        read = bool(self.read(head + tail)) if known else False
        halves = all(p in self.lexicon or bool(self.read(p)) for p in (head, tail))
        return [f"m{plain}", f"r{read}", f"h{halves}{plain}", f"rh{read}{halves}{plain}"]

    def joins(self, left: str, mark: str, right: str, after: str = "") -> bool:
        """Whether the mark at a line's end divides a word (and isn't a part of it); `after` is the word behind."""
        a, b = core(left).lower(), core(right).lower()
        b = b.split("-")[0] if b.split("-")[0] else b
        if not a or not b or not right[:1].isalpha() and not self.read(a + b):
            return False
        head = a.rsplit("-", 1)[-1]
        return sum(self.ends.get(f, 0.0) for f in self.end_features(head, mark, b, core(after).lower())) > 0


def _align(noisy: str, clean: str) -> list[tuple[int, str, str]] | None:
    """The changes between two words as (place, read, true), of which one may be ''; None if they are too far apart."""
    out = []
    for tag, a, b, c, d in SequenceMatcher(None, noisy, clean, autojunk=False).get_opcodes():
        if tag == "equal":
            continue
        if b - a > 2 or d - c > 2 or (tag != "replace" and (b - a) + (d - c) > 1):
            return None
        if b - a == d - c == 2:
            out += [(a, noisy[a], clean[c]), (a + 1, noisy[a + 1], clean[c + 1])]
        elif tag == "insert" and a == len(noisy):
            return None  # a letter lost at the end is another form of the word
        else:
            out.append((a, noisy[a:b], clean[c:d]))
    return out


def _nearest(odd: list[str], lexicon: dict[str, int]) -> Iterator[tuple[str, str, list[tuple[int, str, str]]]]:
    """(odd word, lexicon word, changes) of the odd words that are near one; of several, by the fewest changes, then the commonest.

    The index is of the odd words, which are a bounded sample; the lexicon is gone through once.
    """
    index: dict[str, list[str]] = defaultdict(list)
    for word in odd:
        for short in shortened(word, 2):
            index[short].append(word)
    best: dict[str, tuple] = {}
    for clean, n in lexicon.items():
        if not 4 <= len(clean) <= 16:
            continue
        for word in {w for short in shortened(clean, 2) for w in index.get(short, ())}:
            if slips_within(word, clean, 2) and (ops := _align(word, clean)):
                rank = (any(not x or not y for _, x, y in ops), len(ops), -n, clean)
                if word not in best or rank < best[word][0]:
                    best[word] = (rank, clean, ops)
    for word in odd:
        if word in best:
            yield word, best[word][1], best[word][2]


def train_editor(counts: dict[str, int], compounds: dict[str, int], odd: list[str], seed: int = 11) -> Editor:
    """Confusions from odd words near one lexicon word, then the perceptron on those and on words spoilt likewise."""
    lexicon = {w: n for w, n in counts.items() if WORD.match(w)}
    pairs: list[tuple[str, str, list[tuple[int, str, str]]]] = []
    changes: Counter[tuple[str, str]] = Counter()
    gaps: Counter[tuple[str, str]] = Counter()
    odd = [w for w in odd if 4 <= len(w) <= 16 and not NUMBER.match(w) and w not in lexicon and w not in compounds]
    for word, clean, ops in _nearest(odd, lexicon):
        pairs.append((word, clean, ops))
        lacking = any(not a or not b for _, a, b in ops)
        (gaps if lacking else changes).update({(a, b) for _, a, b in ops})
    total = sum(changes.values())
    # One letter for one other letter is more often another word than a misreading, so it needs ten times the share.
    letter = lambda k: len(k[0]) == len(k[1]) == 1 and k[0].isalpha()
    good = {k for k, n in changes.items() if n >= max(3, CONFUSION_SHARE * total * (10 if letter(k) else 1))}
    good |= KNOWN_CONFUSIONS
    good |= {k for k, n in gaps.items() if (not k[0] or not k[1]) and n >= max(3, GAP_SHARE * (total + sum(gaps.values())))}
    single = defaultdict(list)
    for a, b in good:
        if len(a) == len(b) == 1:
            single[b].append(a)
    for a, b in [k for k in good if len(k[0]) == 2]:  # both confusions at once: li for h and ! for i make l! for h
        good |= {(x + y, b) for x in [a[0], *single[a[0]]] for y in [a[1], *single[a[1]]]}
    options: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for a, b in sorted(good):
        options[a].append((a, b))

    def labels(noisy: str, ops: list[tuple[int, str, str]]) -> list[str]:
        out = ["K"] * len(noisy)
        for at, a, b in ops:
            out[at] = f"I:{b}" if not a else f"R:{b}" if b else "D"
            if len(a) == 2:
                out[at + 1] = "D"
        return out

    rng = random.Random(seed)
    examples = [(w, labels(w, ops)) for w, _, ops in pairs if all((a, b) in good for _, a, b in ops)]
    by_true: dict[str, list[str]] = defaultdict(list)
    for a, b in sorted(good):
        by_true[b].append(a)
    words = sorted(lexicon, key=lambda w: (-lexicon[w], w))[:CLEAN_SAMPLE]
    for word in words:
        examples.append((word, ["K"] * len(word)))
        for _ in range(2):
            noisy, tags, i = "", [], 0
            while i < len(word):
                if "" in by_true and rng.random() < 0.05:  # a letter that isn't there
                    noisy += rng.choice(by_true[""])
                    tags.append("D")
                for size in (2, 1):
                    part = word[i : i + size]
                    if len(part) == size and part in by_true and rng.random() < 0.3:
                        a = rng.choice(by_true[part])
                        if not a and i + 1 == len(word):
                            continue
                        if not a:  # a lost letter is to be inserted before the next one
                            noisy += word[i + 1]
                            tags.append(f"I:{part}")
                            i += 2
                            break
                        noisy += a
                        tags += [f"R:{part}"] + ["D"] * (len(a) - 1)
                        i += size
                        break
                else:
                    noisy += word[i]
                    tags.append("K")
                    i += 1
            examples.append((noisy, tags))
    weights: dict[str, dict[str, float]] = defaultdict(dict)
    sums: dict[tuple[str, str], float] = defaultdict(float)
    step = 0
    reachable: dict[str, list[str]] = defaultdict(lambda: ["K"])
    inserted = sorted({f"I:{b}" for a, b in good if not a})
    for a, b in sorted(good):
        for ch, label in () if not a else ((a[0], f"R:{b}" if b else "D"), *(((a[1], "D"),) if len(a) == 2 else ())):
            if label not in reachable[ch]:
                reachable[ch].append(label)
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for noisy, tags in examples:
            for i, true in enumerate(tags):
                choices = (reachable[noisy[i]] if noisy[i] in reachable else ["K"]) + inserted
                if len(choices) == 1:
                    continue
                step += 1
                feats = Editor.features(noisy, i)
                guess = max(choices, key=lambda y: sum(weights[f].get(y, 0.0) for f in feats if f in weights))
                if guess != true:
                    for f in feats:
                        weights[f][true] = weights[f].get(true, 0.0) + 1
                        weights[f][guess] = weights[f].get(guess, 0.0) - 1
                        sums[f, true] += step
                        sums[f, guess] -= step
    averaged: dict[str, dict[str, float]] = {
        f: {y: w - sums[f, y] / max(1, step) for y, w in row.items() if w or sums[f, y]} for f, row in weights.items()
    }
    editor = Editor(lexicon, compounds, averaged, dict(options))
    clean = dict(lexicon)
    for word, n in lexicon.items():
        if len(word) >= 3:
            best = max((lexicon[t] for _, t, _ in editor.candidates(word)), default=0)
            if best >= MISREAD_TIMES * n:
                del clean[word]
    editor = Editor(clean, compounds, averaged, dict(options))
    editor.ends = train_ends(editor, rng)
    return editor


def train_ends(editor: Editor, rng: random.Random) -> dict[str, float]:
    """Averaged weights for joining line ends, learnt from compounds that stand within lines (not joined, where their hyphen is
    to end the line; joined, where they are also written as one and nothing known follows) and from words divided at a place of chance (joined); a third of either also as if they were unknown."""
    behind: dict[str, list[str]] = defaultdict(list)
    for entry in editor.compounds:
        if " " in entry:
            word, _, after = entry.partition(" ")
            behind[word].append(after)
    examples: list[tuple[list[str], int]] = []

    def add(head: str, mark: str, tail: str, after: str, joined: int) -> None:
        examples.append((editor.end_features(head, mark, tail, after), joined))
        if rng.random() < 0.33:
            examples.append((editor.end_features(head, mark, tail, after, False), joined))

    single = sorted((w for w in editor.compounds if " " not in w), key=lambda w: (-editor.compounds[w], w))[:JOIN_SAMPLE]
    for word in single:
        head, _, tail = word.rpartition("-")
        head = head.rsplit("-", 1)[-1]
        for after in [*sorted(behind[word])[:3], ""]:
            # Of a word that is written both ways, a compound with nothing known behind it tells nothing.
            if after or not editor.lexicon.get(head + tail) or editor.compounds[word] > editor.lexicon[head + tail]:
                add(head, "-", tail, after, -1)
        if editor.lexicon.get(head + tail):
            for _ in range(1 + len(behind[word][:3])):
                add(head, "-", tail, "zz", 1)
    for word in [w for w in sorted(editor.lexicon, key=lambda w: (-editor.lexicon[w], w)) if len(w) >= 4][:JOIN_SAMPLE]:
        cuts = [i for i in range(2, len(word) - 1)]
        for mark in ("-", "¬"):
            at = rng.choice(cuts)
            add(word[:at], mark, word[at:], "zz", 1)
        spoilt, at = word, rng.choice(cuts)
        for a, b in rng.sample([(a, b) for a in sorted(editor.options) for _, b in editor.options[a] if b and b in word], 1) if any(b and b in word for a in editor.options for _, b in editor.options[a]) else ():
            spoilt = word.replace(b, a, 1)
        if spoilt != word and editor.read(spoilt):
            examples.append((editor.end_features(spoilt[:at], "-", spoilt[at:], ""), 1))
    for word in [w for w in sorted(editor.lexicon, key=lambda w: (-editor.lexicon[w], w)) if len(w) >= 4][:JOIN_SAMPLE // 4]:  # both halves are words, and it's nowhere written
        examples.append((editor.end_features(word, "-", rng.choice(editor.words), "", False), -1))
    weights: dict[str, float] = defaultdict(float)
    sums: dict[str, float] = defaultdict(float)
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for feats, true in examples:
            step += 1
            if true * sum(weights[f] for f in feats) <= 0:
                for f in feats:
                    weights[f] += true
                    sums[f] += true * step
    return {f: w - sums[f] / max(1, step) for f, w in weights.items()}


def title_key(line: str) -> str:
    """The letters of a line without numbers, chapter word and marks at its ends."""
    return " ".join(LETTERS.findall(RUNNING_PARTS.sub("", line).casefold()))


def is_page_number(line: str) -> bool:
    bare = line.strip()
    return len(bare) <= 20 and bool(PAGE_NUMBER.fullmatch(bare)) and bool(HAS_FIGURE.search(bare))


def may_be_title(line: str) -> bool:
    """A short line without a full stop whose longer words begin with capitals; no table or list row, no heading."""
    bare = line.strip()
    if not 4 <= len(bare) <= 70 or "|" in bare or bare[-1] in ".,;:-" or CHAPTER_HEADING.fullmatch(bare) or ITEM.match(bare):
        return False
    if len(DECIMAL.findall(bare)) >= 2:
        return False
    words = TITLE_WORD.findall(bare)
    return bool(words) and sum(not w[0].islower() for w in words) >= 0.5 * len(words)


def line_break(line: str):
    """The match of a word and a division mark at the end of a line."""
    bare = line.rstrip(" \t\u00a0")
    return LINE_BREAK.search(line) if bare and bare[-1] in HYPHEN else None


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        raw: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            carried = False
            for line in text.split("\n"):
                tokens = line.split()
                if not tokens:
                    continue
                broken = line_break(line) is not None
                inner = tokens[int(carried) : len(tokens) - broken] if carried or broken else tokens
                carried = broken
                raw.update(inner)
                if "-" in line:  # what follows a compound tells it from the same word written as one
                    for token, after in zip(inner, inner[1:]):
                        if "-" in token and (word := lower_core(token))[1] and (following := lower_core(after)[0]):
                            counts[f"{word[0]} {following}"] += 1
        for token, n in raw.items():
            word = lower_core(token)[0]
            if len(word) > 1:
                counts[word] += n
        if len(counts) > 200_000:
            yield flush()
            counts.clear()
    yield flush()


def fit_editor(pages: DataFrame) -> Editor:
    """Word counts over all pages, the lexicon and a bounded sample of odd words, and the editor trained on them."""
    counted = materialize(pages.select("text").filter("text is not null").mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(LEXICON_LEAST, int(LEXICON_SHARE * total))
    frequent = {r["word"]: r["n"] for r in counted.filter(F.col("n") >= least).collect()}
    odd = [r["word"] for r in counted.filter((F.length("word") >= 4) & (F.length("word") <= 16) & ~F.col("word").rlike(r"^[\p{L}-]+$|^[0-9.,/|%-]+$| ")).orderBy(F.xxhash64("word")).limit(ODD_SAMPLE // 2).collect()]
    odd += [r["word"] for r in counted.filter((F.length("word") >= 4) & (F.length("word") <= 16) & F.col("word").rlike(r"^\p{L}+$") & (F.col("n") < max(40, 20 * least))).orderBy(F.xxhash64("word")).limit(ODD_SAMPLE // 2).collect()]
    compounds = {w: n for w, n in frequent.items() if COMPOUND.match(w.partition(" ")[0])}
    return train_editor(frequent, compounds, sorted(set(odd)))


_ROWS = (
    "kind string, block_id bigint, book string, page int, line_no bigint, key string, heading string, text string, mark string, "
    "nexts array<struct<line_no:bigint,token:string,after:string>>"
)
_NEXTS = pa.list_(pa.struct([("line_no", pa.int64()), ("token", pa.string()), ("after", pa.string())]))


def _first_words(lines: list[str], at: list[int]) -> list[dict]:
    out = []
    for j in at:
        words = lines[j].split()
        out.append({"line_no": j + 1, "token": words[0], "after": words[1] if len(words) > 1 else ""})
    return out


def _page_rows(block: int, book: str | None, page: int | None, text: str, editor: Editor) -> Iterator[tuple]:
    """What one page says by itself: furniture candidates, misread lines, divided words, and what its edges leave open."""
    lines = text.split("\n")
    full = [i for i, line in enumerate(lines) if line.strip()]
    edges = [*full[:EDGE_LINES], *full[-EDGE_LINES:]]
    edge = set(edges)
    open_next = set(full[: EDGE_LINES + 1]) | set(full[-EDGE_LINES - 1 :])
    numbers = set()
    for i in sorted(edge):
        line = lines[i]
        if is_page_number(line):
            numbers.add(i)
            yield ("page_number", block, book, page, i + 1, None, None, None, None, None)
        elif may_be_title(line):
            yield ("title", block, book, page, i + 1, title_key(line), None, line.strip(), None, None)
        elif found := CHAPTER_HEADING.fullmatch(line.strip()):
            yield ("heading", block, book, page, i + 1, title_key(found[1]), None, None, None, None)
    carried = False
    body = [i for i in full if i not in numbers]
    for at, i in enumerate(body):
        tokens = lines[i].split()
        found = line_break(lines[i])
        inner = tokens[int(carried) : len(tokens) - bool(found)]
        carried = False
        if editor.spoilt(inner):
            yield ("misread", block, book, page, i + 1, None, None, None, None, None)
        if not found:
            continue
        left, mark = tokens[-1][: tokens[-1].rfind(found[2])] if found[2] in tokens[-1] else found[1], found[2]
        rest = body[at + 1 :]
        if rest and i not in open_next and rest[0] not in edge:
            follow = _first_words(lines, rest[:1])[0]
            carried = True
            joined, spoilt = judge_break(left, mark, follow["token"], follow["after"], editor)
            if joined:
                yield ("split_word", block, book, page, i + 1, None, None, None, None, None)
            for place in spoilt:
                yield ("misread", block, book, page, (i if place == 0 else rest[0]) + 1, None, None, None, None, None)
        else:
            carried = bool(rest)
            yield ("open", block, book, page, i + 1, None, None, left, mark, _first_words(lines, rest[: 2 * EDGE_LINES]))
    yield ("head", block, book, page, 0, None, None, None, None, _first_words(lines, body[: 2 * EDGE_LINES]))


def judge_break(left: str, mark: str, right: str, after: str, editor: Editor) -> tuple[bool, list[int]]:
    """Whether the words are one, and which of the two sides (0, 1) are misread."""
    a, b = core(left), core(right)
    joined = editor.joins(left, mark, right, after)
    if not joined:
        return False, [k for k, part in enumerate((a, b)) if part and editor.misread(part)]
    head = a.rsplit("-", 1)[-1]
    tail = b.split("-")[0]
    read = editor.read(head + tail)
    sides = {0 if place < len(head) else 1 for place in read[1]} if read else set()
    return True, sorted(sides)


def scan_pages(pages: DataFrame, editor: Editor) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(editor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), _NEXTS)
        names = ["kind", "block_id", "book", "page", "line_no", "key", "heading", "text", "mark", "nexts"]
        for batch in batches:
            rows = [row for values in zip(*(batch.column(i).to_pylist() for i in range(4))) for row in _page_rows(*values, own)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    picked = pages.select(F.col("block_id").cast("bigint").alias("block_id"), F.col("book_key").alias("book"), F.col("page_no").cast("int").alias("page"), "text")
    return picked.filter("block_id is not null and text is not null").mapInArrow(run, _ROWS)


def _is_near(line: str, title: str) -> bool:
    most = max(2, len(title) // 6)
    return slips_within(line, title, most) or (len(line) > len(title) + 4 and slips_within(line, f"chapter{title}", most))


def _near_title(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_is_near(x.replace(" ", ""), y.replace(" ", "")) for x, y in zip(a, b)], dtype=bool)


def running_headers(rows: DataFrame) -> DataFrame:
    """(block_id, line_no): edge lines that repeat a title of their book, or one that differs from it by misreading."""
    titles = rows.filter("kind = 'title' and key <> ''").select("block_id", "line_no", F.coalesce("book", F.lit("")).alias("book"), "key")
    counted = titles.groupBy("book", "key").agg(F.count(F.lit(1)).alias("n"))
    named = rows.filter("kind = 'heading' and key <> ''").select(F.coalesce("book", F.lit("")).alias("book"), "key").distinct()
    known = materialize(counted.filter(F.col("n") >= TITLE_LEAST).select("book", "key").unionByName(named).distinct(), "titles")
    starts = "sequence(1, greatest(length(squeezed) - 3, 1))"
    grams = F.expr(f"array_distinct(transform({starts}, i -> substring(squeezed, i, 4)))")
    squeezed = lambda df: df.withColumn("squeezed", F.regexp_replace("key", " ", "")).withColumn("pieces", grams)
    pieces = lambda df, name: squeezed(df).select("book", F.col("key").alias(name), F.explode("pieces").alias("piece"))
    # Two slips of neighbours swapped are four letters by Spark's distance, which leaves few pairs to the exact test.
    bare = lambda c: F.regexp_replace(c, " ", "")
    most = F.greatest(F.lit(2), F.floor(F.length(bare("title")) / 6)).cast("int") * 2
    close = lambda t: F.levenshtein(bare("key"), t) <= most
    near = (
        pieces(counted.join(known, ["book", "key"], "left_anti"), "key").join(pieces(known, "title"), ["book", "piece"]).select("book", "key", "title").distinct()
        .filter(close(bare("title")) | close(F.concat(F.lit("chapter"), bare("title")))).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "title")
        .filter(F.pandas_udf(_near_title, "boolean")("key", "title")).select("book", "key")
    )
    sure = near.unionByName(known).distinct()
    whole = F.concat_ws("\x01", "book", "key").alias("digest")
    found = materialize(counted.join(sure, ["book", "key"]).select(whole, "n"), "headers")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return attach(titles.select(whole, "block_id", "line_no"), "digest", found.withColumn("header", F.lit(True)), "n", total).select("block_id", "line_no")


def find_noise(pages: DataFrame) -> DataFrame:
    """(block_id BIGINT, line_no BIGINT, noise_kind STRING): the noise of each line.

    Pages without block_id or text, or with blank text, give no row; a null book_key is a book of its own; null page numbers have no
    next page; a page that was scanned twice is judged twice; repeated rows of one block give their lines once.
    """
    return noise_lines(pages, fit_editor(pages))


def noise_lines(pages: DataFrame, editor: Editor) -> DataFrame:
    rows = materialize(scan_pages(pages, editor), "scan")
    numbers = rows.filter("kind = 'page_number'").select("block_id", "line_no", F.lit("page_number").alias("noise_kind"))
    headers = running_headers(rows).select("block_id", "line_no", F.lit("running_header").alias("noise_kind"))
    furniture = materialize(numbers.unionByName(headers).distinct(), "furniture")
    edges = furniture.groupBy("block_id").agg(F.collect_set("line_no").alias("gone"))  # at most four lines of a page
    left = lambda nexts: F.filter(nexts, lambda x: F.coalesce(~F.array_contains("gone", x["line_no"]), F.lit(True)))
    heads = rows.filter("kind = 'head' and page is not null").join(edges, "block_id", "left")
    heads = heads.select(F.coalesce("book", F.lit("")).alias("book"), (F.col("page") - 1).alias("page"), "block_id", F.try_element_at(left("nexts"), F.lit(1)).alias("first")).filter("first is not null")
    heads = heads.groupBy("book", "page").agg(F.min(F.struct("block_id", "first")).alias("next_page"))
    opened = rows.filter("kind = 'open'").join(edges, "block_id", "left").filter("gone is null or not array_contains(gone, line_no)")
    opened = opened.select("block_id", F.coalesce("book", F.lit("")).alias("book"), "page", "line_no", "text", "mark", F.try_element_at(left("nexts"), F.lit(1)).alias("here"))
    opened = opened.join(heads, ["book", "page"], "left").select(
        "block_id", "line_no", "text", "mark",
        F.coalesce("here.token", "next_page.first.token").alias("token"),
        F.when(F.col("here").isNotNull(), F.col("block_id")).otherwise(F.col("next_page.block_id")).alias("to_block"),
        F.coalesce("here.line_no", "next_page.first.line_no").alias("to_line"),
        F.coalesce("here.after", "next_page.first.after", F.lit("")).alias("after"),
    ).filter("token is not null")
    shared = pages.sparkSession.sparkContext.broadcast(editor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for block, line, text, mark, token, to_block, to_line, after in zip(*(batch.column(i).to_pylist() for i in range(8))):
                joined, spoilt = judge_break(text, mark, token, after, own)
                found = [(block, line, "split_word")] if joined else []
                found += [((block, line) if side == 0 else (to_block, to_line)) + ("misread",) for side in spoilt]
                for row in found:
                    for column, x in zip(out, row):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.string()))], names=["block_id", "line_no", "noise_kind"])

    crossing = opened.mapInArrow(run, "block_id bigint, line_no bigint, noise_kind string")
    inside = rows.filter("kind in ('misread', 'split_word')").select("block_id", "line_no", F.col("kind").alias("noise_kind"))
    body = inside.unionByName(crossing).distinct().join(furniture.select("block_id", "line_no"), ["block_id", "line_no"], "left_anti")
    both = furniture.groupBy("block_id", "line_no").agg(F.max("noise_kind").alias("noise_kind"))
    return body.unionByName(both)


def page_fragments(text: str, gone: set[int], divided: set[int]) -> list[tuple[str, str, str, bool, bool]]:
    """The pieces of a page without its furniture as (kind, text, mark, joined, opens).

    Kinds are prose, heading and row. `mark` is the division mark that ended the last line and `joined` whether it is no part
    of the word; `opens` tells that the piece goes on in the one before, as far as the page shows (of its first: may go on).
    """
    pieces: list[tuple[str, list[str], str, bool, bool]] = []
    gap = True
    for number, line in enumerate(text.split("\n"), 1):
        if number in gone:
            continue
        tokens = line.split()
        if not tokens:
            gap = True
            continue
        last = pieces[-1] if pieces else None
        unfinished = last is not None and last[0] == "prose" and (bool(last[2]) or not SENTENCE_END.search(last[1][-1]))
        if CHAPTER_HEADING.fullmatch(line.strip()) and gap:
            kind = "heading"
        elif ROW.fullmatch(line) and not (unfinished and not gap and "|" not in line):
            kind = "row"
        else:
            kind = "prose"
        found = line_break(line) if kind == "prose" else None
        mark, joined = (found[2], number in divided) if found else ("", False)
        if found:
            end = tokens[-1]
            tokens[-1] = end[: end.rfind(mark)]
        goes_on = kind == "prose" and last is not None and last[0] == "prose" and (not gap or unfinished and (bool(last[2]) or core(tokens[0])[:1].islower()))
        if goes_on:
            kept = last[1]
            if last[2]:
                kept[-1] += ("" if last[3] else "-") + tokens[0]
                tokens = tokens[1:]
            pieces[-1] = ("prose", kept + tokens, mark, joined, last[4])
        else:
            pieces.append((kind, tokens, mark, joined, last is None and kind == "prose"))
        gap = False
    out = []
    for kind, tokens, mark, joined, opens in pieces:
        whole = " ".join(tokens)
        out.append(("heading" if kind == "prose" and not mark and may_be_title(whole) and len(tokens) < 9 else kind, whole, mark, joined, opens))
    return out


def repair_pages(pages: DataFrame) -> DataFrame:
    """(book_key STRING, paragraph_no BIGINT, block_id BIGINT, text STRING): the readable paragraphs of each book in order.

    Furniture is left out, divided words are joined within and across pages, misread words are put right as far as the editor reads them; headings,
    list items and table rows are paragraphs of their own. A paragraph goes on over the end of a page if its sentence does and the next page is there;
    `block_id` is the page it begins on. Pages without block_id or with null or blank text have no paragraph; of a page scanned twice the smallest
    block_id counts; pages without number come first and stand alone; null and empty book keys are one book, null.
    """
    editor = fit_editor(pages)
    noise = materialize(noise_lines(pages, editor), "noise")
    lines = lambda kinds: F.collect_set(F.when(F.col("noise_kind").isin(kinds), F.col("line_no")))
    marks = noise.filter("noise_kind <> 'misread'").groupBy("block_id").agg(lines(["running_header", "page_number"]).alias("gone"), lines(["split_word"]).alias("divided"))
    named = pages.select(F.col("block_id").cast("bigint").alias("block_id"), F.coalesce("book_key", F.lit("")).alias("book"), F.col("page_no").cast("int").alias("page"), "text")
    named = named.filter("block_id is not null and trim(translate(text, '\n\t', '  ')) <> ''")
    alone = F.when(F.col("page").isNull(), F.col("block_id"))
    once = named.groupBy("book", "page", alone.alias("alone")).agg(F.min(F.struct("block_id", "text")).alias("first")).select("book", "page", "first.block_id", "first.text")
    marked = once.join(marks, "block_id", "left").select("book", "page", "block_id", "text", "gone", "divided")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        for batch in batches:
            rows = [
                (book, page, block, at, *piece)
                for book, page, block, text, gone, divided in zip(*(batch.column(i).to_pylist() for i in range(6)))
                for at, piece in enumerate(page_fragments(text, set(gone or ()), set(divided or ())))
            ]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["book", "page", "block_id", "at", "kind", "text", "mark", "joined", "opens"])

    cuts = marked.mapInArrow(cut, "book string, page int, block_id bigint, at bigint, kind string, text string, mark string, joined boolean, opens boolean")
    placed = materialize(with_row_ids(cuts, ["book", "page", "block_id", "at"], "pos"), "pieces")
    unfinished = F.col("kind").eqNullSafe("prose") & ((F.col("mark") != "") | ~F.col("text").rlike(r"[.!?…:]['\")\]”’]*$"))
    before = placed.filter(unfinished & F.col("page").isNotNull()).select((F.col("pos") + 1).alias("pos"), "book", (F.col("page") + 1).alias("page"), F.lit(True).alias("goes_on"))
    joined = placed.join(before, ["pos", "book", "page"], "left")
    stretch = F.floor((F.col("pos") - 1) / STRETCH)
    started = joined.withColumn("starts", (~(F.col("opens") & F.coalesce("goes_on", F.lit(False)))).cast("long")).withColumn("stretch", stretch)
    started = materialize(started, "starts")
    # One row for each STRETCH pieces.
    counted = started.groupBy("stretch").agg(F.sum("starts").alias("n")).withColumn("offset", F.sum("n").over(Window.orderBy("stretch")) - F.col("n")).drop("n")
    numbered = started.withColumn("running", F.sum("starts").over(Window.partitionBy("stretch").orderBy("pos"))).join(F.broadcast(counted), "stretch")
    numbered = numbered.withColumn("paragraph", F.col("running") + F.col("offset"))
    gathered = numbered.groupBy("paragraph").agg(
        F.min("book").alias("book"), F.min(F.struct("pos", "block_id")).alias("first"), F.sort_array(F.collect_list(F.struct("pos", "text", "mark", "joined", "kind"))).alias("pieces")
    ).select("paragraph", "book", F.col("first.block_id").alias("block_id"), F.col("pieces.text").alias("texts"), F.col("pieces.mark").alias("marks"), F.col("pieces.joined").alias("joins"))
    shared = pages.sparkSession.sparkContext.broadcast(editor)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out = []
            for texts, marks_, joins in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                raw = ""
                for i, (text, mark, joined_) in enumerate(zip(texts, marks_, joins)):
                    raw += text + (mark if i == len(texts) - 1 else "" if joined_ else "-" if mark else " ")
                words, opening = [], True
                for token in raw.split():
                    words.append(own.repaired(token, opening))
                    opening = bool(SENTENCE_END.search(token))
                out.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(out, pa.string())], names=["paragraph", "book", "block_id", "text"])

    mended = materialize(gathered.mapInArrow(mend, "paragraph bigint, book string, block_id bigint, text string"), "paragraphs")
    books = materialize(mended.groupBy("book").agg(F.min("paragraph").alias("least"), F.count(F.lit(1)).alias("n")), "books")
    total = books.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return attach(mended, "book", books, "n", total).select(
        F.when(F.col("book") != "", F.col("book")).alias("book_key"), (F.col("paragraph") - F.col("least") + 1).alias("paragraph_no"), "block_id", "text"
    )
