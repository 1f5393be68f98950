"""What the models are told: one builder for each task, Column to Column, so that prompts are made where the rows are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What each kind of representation asks for.
KIND_TASKS = {
    "encyclopedic_macro_synthesis": "Write a continuous reference article that covers every fact of the source in its order.",
    "quant_fact_ledger": "List every measured fact of the source as one line: subject, quantity, unit, condition.",
    "numeric_comparison_matrix": "Set the figures of the source that can be compared side by side in a table.",
    "causal_chemical_chain": "Write out each cause and effect of the source as a chain of steps, with the substances named.",
    "exam_bank_grounded": "Write questions of an examination with answers that the source supports word by word.",
    "technical_factsheet": "Write a factsheet with headings, each followed by the figures that belong to it.",
    "kvk_advisory_sop": "Write working instructions for an adviser in the field, step by step, with doses and dates.",
}
GROUNDED = "Use nothing that the source does not say. Copy numbers, units and names exactly."
JSON_ONLY = "Reply with JSON and nothing else."


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])


def qna_prompt(title: Column, text: Column, groups: int = 10) -> Column:
    """Facts of a chapter as groups of differently worded questions with one answer and a quote."""
    return _joined(
        f"Find up to {groups} separate facts in the chapter below. For each give exact_source_quote, three alternative_questions that do not mention the text, and authoritative_answer, "
        f"as objects in a list qna_groups. {GROUNDED} {JSON_ONLY}\n\nChapter: ", title, "\n", text,
    )


def cpt_prompt(kind: Column, title: Column, text: Column, anchors: Column) -> Column:
    """A representation of a chapter that keeps at least `anchors` of its numbers; unknown kinds ask for a faithful rewrite."""
    tasks = F.create_map(*[F.lit(x) for pair in KIND_TASKS.items() for x in pair])
    task = F.coalesce(F.element_at(tasks, kind), F.lit("Rewrite the source faithfully as continuous prose."))
    return _joined(task, f" {GROUNDED} Keep at least ", anchors.cast("string"), " of its numbers. If it has nothing of use, reply NO_USABLE_DATA.\n\nSource: ", title, "\n", text)


def judge_prompt(source: Column, output: Column) -> Column:
    """Whether a generated text agrees with the records that it was made of."""
    return _joined(
        f"Compare the generated text with its records. Give accuracy, completeness and fluency from 0 to 100, a list hallucinations of statements without support, and verdict PASS or FAIL. {JSON_ONLY}\n\nRecords:\n",
        source, "\n\nGenerated:\n", output,
    )


def noise_prompt(question: Column) -> Column:
    """Whether a recorded question is worth keeping; the question is the last line."""
    return _joined(
        "A caller's question is noise if it asks for nothing but weather, market prices or a person to call back, or if it is no question. Reply DISCARD for noise and KEEP otherwise, one word.\n",
        F.regexp_replace(F.coalesce(question, F.lit("")), r"\s+", " "),
    )


def rules_prompt(questions: Column) -> Column:
    """Openings and spellings that a sample of questions has in common; `questions` is an array, one line each."""
    return _joined(
        "Below are questions, one a line. List prefixes: courtesies and openings that carry no meaning; and canonical_replacements: a map from a spelling or local word to the usual term. "
        f"List only what occurs. {JSON_ONLY}\n\n", F.array_join(F.transform(questions, lambda q: F.concat(F.lit("- "), F.coalesce(q, F.lit("")))), "\n"),
    )


def toc_detect_prompt(pages: Column) -> Column:
    """Where a book's table of contents stands; `pages` are its first pages, each under a line with its number."""
    return _joined(
        "From the first pages of a scanned book give title, toc_pages: the numbers, as counted in the scan, of pages that list chapters with page numbers, and highest_printed_page: the greatest page number that "
        f"this list has. {JSON_ONLY}\n\n", pages,
    )


def toc_extract_prompt(toc: Column) -> Column:
    """The chapters and topics that a table of contents lists."""
    return _joined(
        "List the chapters of this table of contents in order as entries with unique_key (lower case, underscores), title, start_page as printed, and topics with title and start_page. "
        f"{JSON_ONLY}\n\n", toc,
    )


def caption_prompt(images: Column) -> Column:
    """Captions of several images in order; the images follow, one a line."""
    return _joined(
        "Describe the images below in their order: what each is, what it shows, and every legible number and label as it stands. Reply with a JSON array of ", F.size(images).cast("string"),
        " strings and nothing else.\n", F.array_join(images, "\n"),
    )
