"""Assembling the text of a document from its ordered parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docenrich.constants import PAGE_HEADING


def has_text(text: Column) -> Column:
    """Neither NULL nor empty. Text of blanks only counts as text."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def page_section(page_no: Column, text: Column) -> Column:
    """A page under its heading."""
    return F.concat(
        F.lit(PAGE_HEADING[0]),
        page_no.cast("string"),
        F.lit(PAGE_HEADING[1]),
        text,
        F.lit("\n\n"),
    )


def paragraph_line(text: Column) -> Column:
    """A paragraph and its line end; an empty paragraph is a bare line end."""
    return F.concat(F.coalesce(text, F.lit("")), F.lit("\n"))


def pages_text(parts: Column) -> Column:
    """Text of a paged document held as an array of its pages' texts."""
    sections = F.transform(
        parts, lambda page, index: F.when(has_text(page), page_section(index + 1, page))
    )
    # array_join leaves out the NULLs of pages without text
    return F.array_join(sections, "\n")


def paragraphs_text(parts: Column) -> Column:
    """Text of a flowing document held as an array of its paragraphs."""
    return F.array_join(F.transform(parts, paragraph_line), "")
