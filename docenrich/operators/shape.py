"""Result layouts, all projections of ``file_path, outcome, body, error``.

Files that did not go through keep the default texts. A body is read as JSON only
where ``outcome`` says that it is. Two layouts carry a
``status``; they spell failures differently and both are kept exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.constants import (
    API_FAILURE,
    API_MESSAGE,
    DEFAULT_JURISDICTION,
    DEFAULT_TYPE,
    ERROR,
    ERROR_MESSAGE,
    EXTRACTION_FAILURE,
    EXTRACTION_MESSAGE,
    NO_OBJECT,
    SUCCESS,
)
from docenrich.functions.replies import object_field
from docenrich.operators.filters import drop_empty_reply, drop_failed


def shape_raw(df: DataFrame) -> DataFrame:
    """``file_path, body`` of the replies that say something, as they came."""
    return drop_empty_reply(drop_failed(df)).select("file_path", "body")


def shape_minimal(df: DataFrame) -> DataFrame:
    """``filepath, type, Jurisdiction`` of the files that went through."""
    return drop_failed(df).select(
        _path(),
        object_field(F.col("body"), "type", DEFAULT_TYPE).alias("type"),
        object_field(F.col("body"), "jurisdiction", DEFAULT_JURISDICTION).alias("Jurisdiction"),
    )


def shape_flags(df: DataFrame) -> DataFrame:
    """Every file, with yes/no flags for the step that failed."""
    return df.select(
        _path(),
        _answer("type", DEFAULT_TYPE).alias("type"),
        _answer("jurisdiction", DEFAULT_JURISDICTION).alias("Jurisdiction"),
        _yes_no(EXTRACTION_FAILURE, ERROR).alias("extraction_failure"),
        _yes_no(API_FAILURE, ERROR).alias("api_failure"),
    )


def shape_status(df: DataFrame) -> DataFrame:
    """Every file, with the status handed back: a failed call is ``error``."""
    outcome = F.col("outcome")
    return df.select(
        _path(),
        _answer("type", DEFAULT_TYPE).alias("type"),
        _answer("jurisdiction", DEFAULT_JURISDICTION).alias("jurisdiction"),
        F.when(outcome == API_FAILURE, F.lit(ERROR)).otherwise(outcome).alias("status"),
    )


def shape_ledger_columns() -> list[Column]:
    """The persisted layout as columns: a failed extraction is ``error``."""
    outcome = F.col("outcome")
    return [
        _path(),
        _answer("type", DEFAULT_TYPE).alias("type"),
        _answer("jurisdiction", DEFAULT_JURISDICTION).alias("jurisdiction"),
        F.when(outcome == EXTRACTION_FAILURE, F.lit(ERROR)).otherwise(outcome).alias("status"),
    ]


def shape_ledger(df: DataFrame) -> DataFrame:
    """Every file, with the status persisted."""
    return df.select(*shape_ledger_columns())


def shape_ledger_table(df: DataFrame, run_seq: int, run_id: str | None = None) -> DataFrame:
    """The persisted layout with outcome, error and the run."""
    return df.select(
        *shape_ledger_columns(),
        "outcome",
        F.col("error") if "error" in df.columns else F.lit(None).cast("string").alias("error"),
        F.lit(run_seq).cast("long").alias("run_seq"),
        F.lit(run_id).cast("string").alias("run_id"),
    )


def status_of_ledger(entries: DataFrame) -> DataFrame:
    """The status layout of rows of the ledger table."""
    outcome = F.col("outcome")
    return entries.select(
        "filepath",
        "type",
        "jurisdiction",
        F.when(outcome == API_FAILURE, F.lit(ERROR)).otherwise(outcome).alias("status"),
    )


def failure_log(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    """``filepath, level, message``: one line for each file that failed, and why.

    Rows of the ledger table will do too, with ``path_col="filepath"``.
    """
    path, outcome = F.col(path_col), F.col("outcome")
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    known = F.coalesce(F.concat(F.lit(": "), error), F.lit(""))
    return df.where(outcome != SUCCESS).select(
        path.alias("filepath"),
        F.when(outcome == ERROR, F.lit("ERROR")).otherwise(F.lit("WARNING")).alias("level"),
        F.when(outcome == EXTRACTION_FAILURE, F.concat(F.lit(EXTRACTION_MESSAGE), path, known))
        .when(outcome == API_FAILURE, F.concat(F.lit(API_MESSAGE), path, known))
        .otherwise(F.concat(F.lit(ERROR_MESSAGE), path, F.lit(": "), F.coalesce(error, F.lit(NO_OBJECT))))
        .alias("message"),
    )


def _path() -> Column:
    return F.col("file_path").alias("filepath")


def _answer(key: str, default: str) -> Column:
    return F.when(
        F.col("outcome") == SUCCESS, object_field(F.col("body"), key, default)
    ).otherwise(F.lit(default))


def _yes_no(*outcomes: str) -> Column:
    return F.when(F.col("outcome").isin(*outcomes), F.lit("yes")).otherwise(F.lit("no"))
