"""Chapters of a book: bounds from a table of contents, and their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_offset(pdf_pages: Column, printed_pages: Column, given: Column | None = None) -> Column:
    """What is added to a printed page number to get the scanned one."""
    found = pdf_pages - printed_pages
    return F.coalesce(given, found) if given is not None else found


def chapter_bounds(toc: DataFrame, book: str, start: str, pages: Column, offset: Column) -> DataFrame:
    """`toc` with (first_page, last_page) in the scan: up to the page before the next chapter, the last to the book's end.

    A chapter has at least its first page.
    """
    following = F.lead(start).over(Window.partitionBy(book).orderBy(start))
    last = F.greatest(F.col(start), F.coalesce(following - 1, pages))
    return toc.withColumns({"first_page": F.col(start) + offset, "last_page": last + offset})


def topic_bounds(topics: Column, offset: Column) -> Column:
    """array<struct<title, first_page, last_page>>: each topic up to the page on which the next one begins."""
    n = F.size(topics)

    def bound(topic, i):
        following = F.when(i + 1 < n, F.get(topics, i + 1)["start_page"]).otherwise(topic["start_page"])
        last = F.greatest(topic["start_page"], following)
        return F.struct(topic["title"].alias("title"), (topic["start_page"] + offset).alias("first_page"), (last + offset).alias("last_page"))

    return F.transform(topics, bound)


def chapter_texts(chapters: DataFrame, pages: DataFrame, book: str, page: str, text: str) -> DataFrame:
    """(book, key, pages, text): the texts of each chapter's pages in order, a blank line between them.

    A range join as an equi-join: each chapter is laid out by its page numbers. Chapters without a page give no row.
    """
    laid = chapters.select(F.col(book).alias("book"), "key", F.explode(F.sequence("first_page", "last_page")).alias("page"))
    found = laid.join(pages.select(F.col(book).alias("book"), F.col(page).alias("page"), F.col(text).alias("text")), ["book", "page"])
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    grouped = found.groupBy("book", "key").agg(ordered.alias("__all"))
    return grouped.select("book", "key", F.size("__all").alias("pages"), F.array_join(F.transform("__all", lambda x: x["text"]), "\n\n").alias("text"))


def toc_rows(toc: DataFrame, column: str) -> DataFrame:
    """The rows of a table of contents given as a JSON map: (key, title, first_page, last_page)."""
    parsed = F.from_json(column, "map<string,struct<range:array<int>,title:string>>")
    each = toc.select(F.explode(parsed).alias("key", "entry"))
    return each.select("key", "entry.title", F.col("entry.range")[0].alias("first_page"), F.col("entry.range")[1].alias("last_page"))
