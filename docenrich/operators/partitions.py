"""How rows are spread over tasks, and custom code over whole partitions."""

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docenrich.cluster import ship_package, written_once
from docenrich.constants import FILES_PER_TASK, NUM_PARTITIONS


def map_partitions(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """Many rows in, many rows out, on the executors, as Arrow batches."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def repartitioned(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, whatever their values, over a number of tasks.

    Meant for bare listings: rows are moved whole. By default there are several
    tasks for each core of the cluster, and never fewer than the usual number.
    """
    return df.repartition(num_partitions or _usual_tasks(df))


def spread_files(listing: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Spread a listing over tasks that each get few enough files to lose.

    Without a given number the listing is written and counted first: a short
    one gets a task per file at most, a long one ever more tasks. So do short rows
    that each become a file, which Spark would leave in few tasks for their bytes.
    """
    if num_partitions is None:
        listing = written_once(listing, "listing")
        files = listing.count()
        num_partitions = max(
            min(files, _usual_tasks(listing)), math.ceil(files / FILES_PER_TASK), 1
        )
    return listing.repartition(num_partitions)


def _usual_tasks(df: DataFrame) -> int:
    return max(NUM_PARTITIONS, 4 * df.sparkSession.sparkContext.defaultParallelism)


def spread_scan(scan: DataFrame) -> DataFrame:
    """Give every core a share of a table that is read in fewer pieces than that.

    A table read in enough pieces stays as it is: its rows are not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)
