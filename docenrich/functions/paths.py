"""Functions of a file path."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docenrich.constants import (
    DOCX_PLACEHOLDER,
    DOCX_SUFFIX,
    PDF_PLACEHOLDER,
    PDF_SUFFIX,
)


def is_supported(path: Column) -> Column:
    """Case-sensitive test for the two document suffixes."""
    return path.endswith(PDF_SUFFIX) | path.endswith(DOCX_SUFFIX)


def key_md5(path: Column) -> Column:
    """Result-file name from the whole path: never collides between folders."""
    return F.concat(F.md5(path), F.lit(".json"))


def key_stem(path: Column) -> Column:
    """Result-file name from the bare file name without its last suffix."""
    name = F.substring_index(path, "/", -1)
    return F.concat(F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1"), F.lit(".json"))


def path_join(folder: Column, name: Column) -> Column:
    """One slash between folder and name, whether or not the folder ends in one."""
    return F.concat(F.regexp_replace(folder, "/$", ""), F.lit("/"), name)


def plain_path(uri: Column) -> Column:
    """``file:/a/b`` and ``file:///a/b`` as ``/a/b``; other schemes as they are."""
    return F.regexp_replace(uri, "^file:/+", "/")


def placeholder_text(path: Column) -> Column:
    """A constant text by suffix; NULL for an unsupported one."""
    return F.when(path.endswith(PDF_SUFFIX), F.lit(PDF_PLACEHOLDER)).when(
        path.endswith(DOCX_SUFFIX), F.lit(DOCX_PLACEHOLDER)
    )
