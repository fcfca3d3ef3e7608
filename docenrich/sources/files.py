"""Document listings and document bytes."""

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich import storage
from docenrich.cluster import scratch_path, ship_package
from docenrich.constants import BYTES_SCHEMA, PATH_SCHEMA
from docenrich.functions.paths import is_supported
from docenrich.operators.partitions import spread_files

# Entries one task lists below a folder before it hands the rest on: few at
# first, to have folders for every task soon.
_FIRST_ROUND_ENTRIES = 1000
_ROUND_ENTRIES = 20000
_ENTRY_SCHEMA = "path string, descend boolean"


def paths_df(spark: SparkSession, paths: Iterable[str] | DataFrame) -> DataFrame:
    """One column ``file_path``, never NULL, from a DataFrame or a short list.

    A DataFrame gives its ``file_path`` or else its first column and stays
    distributed. A Python list is for the handful of paths a caller names.
    """
    if isinstance(paths, DataFrame):
        name = "file_path" if "file_path" in paths.columns else paths.columns[0]
        return paths.select(F.col(name).cast("string").alias("file_path")).where(
            F.col("file_path").isNotNull()
        )
    return spark.createDataFrame([(p,) for p in paths], PATH_SCHEMA)


def list_files(
    spark: SparkSession,
    root: str,
    recursive: bool = True,
    include_hidden: bool = False,
) -> DataFrame:
    """Paths of the PDF and DOCX files of a folder (tree); empty if there is none.

    The executors walk the tree, so a listing of any length stays distributed.
    ``include_hidden`` adds files whose name, or a folder on the way to them,
    starts with ``_`` or ``.``. A byte of a name that is no text is spelled as
    NUL and two hexadecimal digits, which opening the file undoes.
    """
    listed = walk_files(spark, root, recursive, include_hidden)
    return listed.where(is_supported(F.col("file_path")))


def read_bytes(
    spark: SparkSession, source: str | DataFrame, recursive: bool = True
) -> DataFrame:
    """``file_path, content`` of a folder's documents, or of listed paths.

    Each file is opened by the task that handles its path, so files dropped
    from a listing are never read. ``content`` is NULL for one that is missing
    or forbidden; any other trouble with the storage fails the task, and is
    tried again.
    """
    if not isinstance(source, DataFrame):
        source = spread_files(list_files(spark, source, recursive))
    ship_package(spark)
    return source.select("file_path").mapInArrow(storage.released(_read_listed), BYTES_SCHEMA)


def walk_files(
    spark: SparkSession, root: str, recursive: bool, include_hidden: bool
) -> DataFrame:
    """``file_path`` of every file of a folder (tree); no rows for a missing one.

    The tree is listed now, in rounds. A task lists its folders and what lies
    below them up to a number of entries; folders it does not get to are spread
    over all tasks in the next round, so one big subtree does not stay with one.

    Each round is written to the shared folder: nothing is listed twice, and a
    lost executor costs only its own tasks. The driver learns a count.
    """
    ship_package(spark)
    rounds = scratch_path(spark, "listing")
    widest = spark.sparkContext.defaultParallelism * 4
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    budget = _FIRST_ROUND_ENTRIES if recursive else 0
    written = []
    while True:
        written.append(f"{rounds}/round={len(written)}")
        listed = folders.select("path").mapInArrow(
            lambda batches, budget=budget: _list_folders(batches, budget, include_hidden),
            _ENTRY_SCHEMA,
        )
        listed.write.parquet(written[-1])
        unlisted = spark.read.schema(_ENTRY_SCHEMA).parquet(written[-1]).where("descend")
        count = unlisted.count() if recursive else 0
        if count == 0:
            break
        folders, budget = unlisted.repartition(min(count, widest)), _ROUND_ENTRIES
    entries = spark.read.schema(_ENTRY_SCHEMA).parquet(*written)
    return entries.where(~F.col("descend")).select(F.col("path").alias("file_path"))


def _list_folders(
    batches: Iterator[pa.RecordBatch], budget: int, include_hidden: bool
) -> Iterator[pa.RecordBatch]:
    """Files below each folder, and the folders left when the budget is spent."""

    def rows() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for start in batch.column("path").to_pylist():
                folders, seen = deque([start]), 0
                while folders and (seen < budget or folders[0] is start):
                    for path, descend in storage.list_folder(folders.popleft()):
                        seen += 1
                        name = path.rsplit("/", 1)[1]
                        if not include_hidden and name.startswith(("_", ".")):
                            continue
                        if descend:
                            folders.append(path)
                        else:
                            yield {"path": storage.path_text(path), "descend": False}, len(path)
                for path in folders:
                    yield {"path": storage.path_text(path), "descend": True}, len(path)

    return storage.arrow_batches(
        rows(), pa.schema([("path", pa.string()), ("descend", pa.bool_())])
    )


def _read_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths = (path for batch in batches for path in batch.column("file_path").to_pylist())

    def rows() -> Iterator[tuple[dict, int]]:
        for path, coming in storage.read_ahead(paths):
            try:
                content = coming.result()
            except storage.UNREADABLE:
                content = None
            yield {"file_path": path, "content": content}, len(content or b"")

    return storage.arrow_batches(
        rows(), pa.schema([("file_path", pa.string()), ("content", pa.binary())])
    )
