"""What earlier runs have settled, and what is left to do."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.constants import SUCCESS
from docenrich.functions.paths import key_md5
from docenrich.operators.filters import successful


def latest_by_key(
    ledger: DataFrame, key_col: str = "filepath", order_col: str = "run_seq"
) -> DataFrame:
    """One entry per key, that of the latest run.

    Entries of the same run are ordered by their other values, so the result
    never depends on the order of rows. Each task reduces its own rows first: a
    key repeated without end reaches the shuffle once per task.
    """
    others = [c for c in ledger.columns if c not in (key_col, order_col)]
    return (
        ledger.groupBy(key_col)
        .agg(F.max(F.struct(order_col, *others)).alias("entry"))
        .select(*(F.col(c) if c == key_col else F.col(f"entry.{c}") for c in ledger.columns))
    )


def processed_paths(ledger: DataFrame) -> DataFrame:
    """Distinct paths with a success entry."""
    return successful(ledger).select("filepath").where(F.col("filepath").isNotNull()).distinct()


def verdict(order_col: str = "run_seq") -> Column:
    """The number of an entry's run and whether it is a success, in one long: odd if it is."""
    success = F.when(F.col("status") == SUCCESS, 1).otherwise(0)
    return (F.col(order_col) * 2 + success).cast("long")


def currently_processed(ledger: DataFrame, order_col: str = "run_seq") -> DataFrame:
    """Distinct paths whose entry of the latest run is a success.

    Needs only the last run's number and its verdict: one long per path, which
    keeps the aggregation hashed and its shuffle to path and long.
    """
    return (
        ledger.where(F.col("filepath").isNotNull())
        .groupBy("filepath")
        .agg(F.max(verdict(order_col)).alias("last"))
        .where(F.col("last") % 2 == 1)
        .select("filepath")
    )


def skip_processed(files: DataFrame, processed: DataFrame, key: str = "path") -> DataFrame:
    """Files whose path is not among the processed ones.

    ``key="md5"`` compares result-file names: ``processed`` then holds them in
    ``key``. An anti join, so a NULL among the processed matches nothing.
    Run it on the bare listing, before any text is read or shuffled.
    """
    if key == "md5":
        return files.join(processed, key_md5(F.col("file_path")) == processed["key"], "left_anti")
    return files.join(processed, files["file_path"] == processed["filepath"], "left_anti")


def processed_keys(processed: DataFrame) -> DataFrame:
    """Result-file names of processed paths, for ``skip_processed(key="md5")``."""
    return processed.select(key_md5(F.col("filepath")).alias("key"))


def next_run(ledger: DataFrame, order_col: str = "run_seq") -> int:
    """The number of the run after the latest one in the ledger."""
    last = ledger.agg(F.max(order_col)).first()[0]
    return 1 if last is None else last + 1


def to_do(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct listed paths that no run has finished."""
    return skip_processed(files.select("file_path").distinct(), currently_processed(ledger))


def union_results(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of several runs, duplicates kept, columns matched by name."""
    result = first
    for other in more:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
