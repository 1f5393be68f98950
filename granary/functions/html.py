"""Articles and links of HTML pages, by the standard library's parser in Arrow functions."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is no article text, and elements without an end tag.
SKIPPED = frozenset({"script", "style", "noscript", "footer"})
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LISTS = ("ul", "ol")
LEAST = 20


class _Article(HTMLParser):
    """Texts of p and li inside the body, or inside the page's main form if it has one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[bool, list[str]]] = []
        self.open: list[list[str]] = []
        self.skip = self.form = self.body = 0
        self.has_form = False

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.body += 1
        elif tag == "form" and dict(attrs).get("name") == "aspnetForm":
            self.form, self.has_form = self.form + 1, True
        elif tag in SKIPPED:
            self.skip += 1
        elif tag in LISTS:
            self.open.append([tag])
        elif tag in ("p", "li"):
            if self.open and self.open[-1][0] == tag:  # its end tag was left out
                self.open.pop()
            block = [tag]
            self.blocks.append((self.form > 0, block))
            self.open.append(block)

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "form":
            self.form = max(0, self.form - 1)
        elif tag in ("p", "li", *LISTS):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    del self.open[i:]
                    break

    def handle_data(self, data):
        if not self.skip:
            for block in self.open:
                block.append(data)

    def text(self) -> str:
        kept = [b for inside, b in self.blocks if inside or not self.has_form]
        lines = (" ".join("".join(b[1:]).replace("\xa0", " ").split()) for b in kept)
        return "\n".join(line for line in lines if len(line) > LEAST)


def _articles(pages: pd.Series) -> pd.Series:
    def one(page: str | None) -> str | None:
        if page is None:
            return None
        parser = _Article()
        parser.feed(page)
        parser.close()
        return parser.text()

    return pages.map(one)


def article_text(page: Column) -> Column:
    """The paragraphs and list items of more than LEAST characters, one a line."""
    return F.pandas_udf(_articles, "string")(page)


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href")
        if tag == "a" and href is not None:
            self.found.append((href, []))
            self.inside = True

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.found[-1][1].append(data)


def release_links(page: Column, base: str) -> Column:
    """array<struct<heading, link>> of the first link to each press release of a page, with absolute addresses."""

    def run(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> list[dict] | None:
            if page is None:
                return None
            parser = _Links()
            parser.feed(page)
            parser.close()
            out: dict[str, str] = {}
            for href, words in parser.found:
                heading = " ".join("".join(words).replace("\xa0", " ").split())
                if heading and ("PRID=" in href or "PressRelease" in href):
                    out.setdefault(urljoin(base, href), heading)
            return [{"heading": h, "link": a} for a, h in out.items()]

        return pages.map(one)

    return F.pandas_udf(run, "array<struct<heading:string,link:string>>")(page)


class _Form(HTMLParser):
    """Fields of a page's inputs, and the options of its selects."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.fields: dict[str, str] = {}
        self.options: list[tuple[str, str, list[str]]] = []
        self.select: str | None = None
        self.open = False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "input" and a.get("name"):
            self.fields[a["name"]] = a.get("value", "")
        elif tag == "select":
            self.select = a.get("name", "")
        elif tag == "option" and self.select is not None:
            self.options.append((self.select, a.get("value", ""), []))
            self.open = True

    def handle_endtag(self, tag):
        if tag == "select":
            self.select, self.open = None, False
        elif tag == "option":
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.options[-1][2].append(data)


def form_state(page: Column) -> Column:
    """struct<fields, options>: a form's inputs by name, which are posted back with it, and (select, value, text) of its options; null for null."""

    def run(pages: pd.Series) -> pd.DataFrame:
        fields, options = [], []
        for page in pages:
            parser = _Form()
            parser.feed(page or "")
            parser.close()
            fields.append(parser.fields)
            options.append([{"select": s, "value": v, "text": "".join(t).strip()} for s, v, t in parser.options])
        return pd.DataFrame({"fields": fields, "options": options})

    made = F.pandas_udf(run, "fields map<string,string>, options array<struct<select:string,value:string,text:string>>")(page)
    return F.when(page.isNotNull(), made)


def select_named(options: Column, keyword: Column | str) -> Column:
    """The options of the first select whose name has the keyword in any letter case."""
    word = F.lower(F.lit(keyword) if isinstance(keyword, str) else keyword)
    fits = F.filter(options, lambda o: F.contains(F.lower(o["select"]), word))
    return F.filter(options, lambda o: o["select"] == F.get(fits, F.lit(0))["select"])


def form_post(fields: Column, target: Column, chosen: Column) -> Column:
    """What is posted: the page's own fields, the control that sends it, and the chosen values, which replace fields of their name."""
    event = F.create_map(F.lit("__EVENTTARGET"), target, F.lit("__EVENTARGUMENT"), F.lit(""))
    keep = lambda m, over: F.map_filter(m, lambda k, v: ~F.map_contains_key(over, k))
    return F.map_concat(keep(keep(fields, event), chosen), keep(event, chosen), chosen)
