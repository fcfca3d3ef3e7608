"""CSV, the ledger table and previews."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docenrich.constants import PREVIEW_ROWS, PREVIEW_WIDTH
from docenrich.operators.shape import shape_ledger_table
from docenrich.sinks.runs_log import Run


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, replacing what was there.

    A failed write fails the job.
    """
    df.write.format("csv").mode("overwrite").option("header", "true").save(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back ``write_csv``; a line end inside a cell does not end the row."""
    return spark.read.schema(schema).option("header", "true").option("multiLine", "true").csv(path)


def append_ledger(df: DataFrame, folder: str, run: int | Run) -> None:
    """Add one run's settled files to the ledger table, in the order they finish.

    A single job: the rows, and the calls behind them, are made once and read
    back from the table for everything that follows. A claimed run writes to a
    folder of its own below the table's, so other runs may write meanwhile. With
    a bare number the caller sees to it that nobody else does.
    """
    if isinstance(run, Run):
        rows = shape_ledger_table(df, run.seq, run.id)
        rows.write.parquet(f"{folder.rstrip('/')}/run-{run.seq:09d}-{run.id}/{uuid.uuid4().hex}")
    else:
        shape_ledger_table(df, run).write.mode("append").parquet(folder)


def preview(
    df: DataFrame, n: int = PREVIEW_ROWS, width: int = PREVIEW_WIDTH, order_col: str = "filepath"
) -> DataFrame:
    """The first rows by path, long cells cut the way ``show`` cuts them."""
    cells = []
    for name in df.columns:
        text = F.col(name).cast("string")
        cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
        cells.append(F.when(F.length(text) > width, cut).otherwise(text).alias(name))
    return df.orderBy(order_col).limit(n).select(*cells)
