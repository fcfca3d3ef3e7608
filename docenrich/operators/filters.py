"""Row filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.constants import EXTRACTION_FAILURE, SUCCESS
from docenrich.functions.paths import is_supported
from docenrich.functions.replies import is_empty_reply
from docenrich.functions.text import has_text


def filter_supported(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Keep ``.pdf`` and ``.docx``."""
    return df.where(is_supported(F.col(path_col)))


def guard_unsupported(
    df: DataFrame, text_col: str = "text", path_col: str = "file_path"
) -> DataFrame:
    """Keep every row: an unsupported file loses its text and has failed."""
    supported = is_supported(F.col(path_col))
    return df.withColumns(
        {
            text_col: F.when(supported, F.col(text_col)),
            "outcome": F.when(~supported, F.lit(EXTRACTION_FAILURE)),
        }
    )


def drop_failed(df: DataFrame) -> DataFrame:
    """Keep the files that went through."""
    return df.where(F.col("outcome") == SUCCESS)


def drop_empty_reply(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Drop replies that say nothing."""
    return df.where(~is_empty_reply(F.col(body_col)))


def skip_blank_pages(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop pages whose text is NULL or empty."""
    return df.where(has_text(F.col(text_col)))


def successful(ledger: DataFrame) -> DataFrame:
    """Ledger entries that count as processed."""
    return ledger.where(F.col("status") == SUCCESS)
