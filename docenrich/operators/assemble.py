"""Putting long tables of pages or paragraphs back together.

A document may have any number of parts, so they are joined block by block,
spread over all tasks, before the blocks of a file meet. Nearly all documents
are one block. The input is read once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.functions.text import has_text, page_section, paragraph_line

BLOCK_PARTS = 1000


def join_pages(
    pages: DataFrame, path_col: str = "file_path", no_col: str = "page_no", text_col: str = "text"
) -> DataFrame:
    """``file_path, text``: headed sections of the non-blank pages, in page order.

    A document without any text still has a row, with an empty text.
    """
    no, text = F.col(no_col), F.col(text_col)
    section = F.when(has_text(text), page_section(no, text))
    return _join_parts(pages, path_col, no, section, "\n")


def join_paragraphs(
    paragraphs: DataFrame, path_col: str = "file_path", no_col: str = "para_no",
    text_col: str = "text",
) -> DataFrame:
    """``file_path, text``: every paragraph, empty ones too, ended by a line end."""
    return _join_parts(paragraphs, path_col, F.col(no_col), paragraph_line(F.col(text_col)), "")


def _join_parts(
    df: DataFrame, path_col: str, no: Column, piece: Column, separator: str
) -> DataFrame:
    rows = df.select(F.col(path_col).alias("file_path"), no.alias("part_no"), piece.alias("piece"))
    block = F.coalesce(F.floor((F.col("part_no") - 1) / BLOCK_PARTS), F.lit(0))
    blocks = rows.groupBy("file_path", block.alias("block")).agg(
        _joined("part_no", separator).alias("piece")
    )
    return blocks.groupBy("file_path").agg(
        F.coalesce(_joined("block", separator), F.lit("")).alias("text")
    )


def _joined(order: str, separator: str) -> Column:
    literal = separator.replace("\n", "\\n")
    return F.expr(f"listagg(piece, '{literal}') WITHIN GROUP (ORDER BY {order})")
