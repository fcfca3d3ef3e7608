"""Results of earlier runs."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.constants import LEDGER_SCHEMA, LEDGER_TABLE_SCHEMA
from docenrich.functions.replies import OBJECT, reply_kind
from docenrich.operators.partitions import spread_files
from docenrich.sources.files import read_bytes, walk_files


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of a folder of ``*.json`` result files, one object per file.

    Corrupt files, other JSON values and objects without a ``filepath`` are
    left out (see ``read_corrupt``). A missing folder is an empty ledger.
    """
    files = _json_files(spark, folder)
    return files.where(_is_entry()).select(F.from_json("value", LEDGER_SCHEMA).alias("entry")).select("entry.*")


def entries_of(text: Column) -> Column:
    """The entry that a result file's text holds, or null."""
    return F.when(_is_entry(text), F.from_json(text, LEDGER_SCHEMA))


def read_corrupt(spark: SparkSession, folder: str) -> DataFrame:
    """The ``*.json`` files ``read_ledger`` leaves out, with their text."""
    files = _json_files(spark, folder)
    return files.where(~_is_entry())


def read_ledger_table(spark: SparkSession, folder: str) -> DataFrame:
    """The append-only ledger table, with the folders of its runs; a missing one is empty."""
    reader = spark.read.schema(LEDGER_TABLE_SCHEMA).option("recursiveFileLookup", "true")
    try:
        return reader.parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_TABLE_SCHEMA)


def _is_entry(text: Column | None = None) -> Column:
    text = F.col("value") if text is None else text
    named = F.array_contains(F.json_object_keys(text), "filepath")
    return F.coalesce((reply_kind(text) == OBJECT) & named, F.lit(False))


def _json_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, value``: the text of each file. One file is one row, so there can
    be very many; the executors list and read them."""
    listed = walk_files(spark, folder, recursive=False, include_hidden=True)
    return read_texts(spark, spread_files(listed.where(F.col("file_path").endswith(".json"))))


def read_texts(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """``file, value``: the text of each listed file, null where it is none."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return read_bytes(spark, paths).select(
        F.col("file_path").alias("file"), text.alias("value")
    )
