"""One JSON file per document, named by a key of its path.

Kept for readers of that format: the ledger table holds the same entries in far
fewer files. Files are written as their rows arrive, so what a broken-off run
has settled stays settled, and a task that runs again replaces its own files.
"""

import hashlib
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docenrich import storage
from docenrich.cluster import modified_entries, ship_package, written_once
from docenrich.constants import WORKERS_PER_PARTITION
from docenrich.functions.paths import key_md5
from docenrich.operators.partitions import spread_files
from docenrich.sources.files import walk_files
from docenrich.sources.ledger import entries_of, read_texts

_KEY = "result_file"
#: Stands behind the name of the folder of result files, whose readers it is not for.
_LOG = ".log"
_ENTRY = "filepath string, type string, jurisdiction string, status string"
_FACTS = "name string, changed long, length long"
_FACTS_ARROW = pa.schema([("name", pa.string()), ("changed", pa.int64()), ("length", pa.int64())])
_LOGGED = f"{_FACTS}, entry struct<filepath:string,type:string,jurisdiction:string,status:string>, digest string, run_id string"


class KeyedJsonSource(DataSource):
    """``format("keyed_json")``: the column ``result_file`` names each row's file."""

    @classmethod
    def name(cls) -> str:
        return "keyed_json"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _KeyedJsonWriter(self.options["path"], int(self.options["workers"]))


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _KeyedJsonWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, workers: int):
        self.folder = folder.rstrip("/")
        self.workers = workers

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        def write_some(rows: list[dict]) -> int:
            for row in rows:
                name = row.pop(_KEY)
                storage.replace_file(f"{self.folder}/{name}", json.dumps(row).encode())
            return len(rows)

        files = 0
        with ThreadPoolExecutor(self.workers) as pool:
            for batch in iterator:
                rows = batch.to_pylist()
                shares = [rows[n :: self.workers] for n in range(self.workers)]
                files += sum(pool.map(write_some, shares))
        return _Written(files)


def _microseconds(facts: tuple[float, int]) -> tuple[int, int]:
    return round(facts[0] * 1e6), facts[1]


def write_logged_json(
    df: DataFrame, folder: str, run_id: str | None = None, workers: int | None = None
) -> None:
    """``write_keyed_json``, with a log of the files written, beside the folder.

    The log holds each file's name, time, length and digest, its entry and the run,
    so ``read_logged_json`` need not open it again.
    """
    if workers is None:
        workers = 1 if storage.local_path(folder) else WORKERS_PER_PARTITION
    folder = folder.rstrip("/")
    ship_package(df.sparkSession)
    entry = F.struct(*(F.col(n).cast("string").alias(n) for n in df.columns))
    rows = df.select(key_md5(F.col("filepath")).alias("name"), entry.alias("entry"))
    entries = f"entry {rows.schema['entry'].dataType.simpleString()}"
    written = rows.mapInArrow(
        lambda batches: _write_and_tell(batches, folder, workers), f"{_FACTS}, {entries}, digest string"
    )
    log = written.withColumn("run_id", F.lit(run_id).cast("string"))
    log.write.mode("append").parquet(f"{folder}{_LOG}/{uuid.uuid4().hex}")


def _write_and_tell(batches: Iterator[pa.RecordBatch], folder: str, workers: int) -> Iterator[pa.RecordBatch]:
    def write(name: str, entry: dict) -> tuple:
        data = json.dumps(entry).encode()
        storage.replace_file(f"{folder}/{name}", data)
        facts = storage.file_facts(f"{folder}/{name}")
        # a file that somebody took away at once is one to look for again
        return (*(_microseconds(facts) if facts else (0, -1)), hashlib.md5(data).hexdigest())

    with ThreadPoolExecutor(workers) as pool:
        for batch in batches:
            names, entries = batch.column("name"), batch.column("entry")
            told = list(pool.map(write, names.to_pylist(), entries.to_pylist()))
            changed, length, digest = zip(*told) if told else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(changed, pa.int64()), pa.array(length, pa.int64()), entries, pa.array(digest, pa.string())],
                names=["name", "changed", "length", "entry", "digest"],
            )


def _facts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for path in batch.column("file_path").to_pylist():
                facts = storage.file_facts(path)
                if facts is not None:
                    changed, length = _microseconds(facts)
                    yield {"name": path.rsplit("/", 1)[1], "changed": changed, "length": length}, len(path)

    return storage.arrow_batches(rows(), _FACTS_ARROW)


def read_logged_json(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of a folder of result files, as ``read_ledger`` has them.

    Only files whose time or length is not the one logged are opened, and then
    logged: a second reading opens what has changed since the first. A store that
    keeps times by the second hides a change of equal length within that second.
    """
    folder = folder.rstrip("/")
    listed = walk_files(spark, folder, recursive=False, include_hidden=True)
    names = spread_files(listed.where(F.col("file_path").endswith(".json")))
    facts = written_once(names.mapInArrow(_facts_of, _FACTS), "facts")
    log = _read_log(spark, folder)
    known = facts.join(log, ["name", "changed", "length"]).select("name", "told.entry")
    known = written_once(known, "known")
    fresh = facts.join(known.select("name"), "name", "left_anti")
    if not fresh.isEmpty():
        paths = fresh.select("name", F.concat(F.lit(f"{folder}/"), "name").alias("file_path"))
        texts = read_texts(spark, spread_files(paths.select("file_path")))
        opened = texts.select("file", entries_of(F.col("value")).alias("entry"), F.md5("value").alias("digest"))
        told = fresh.join(opened, F.concat(F.lit(f"{folder}/"), "name") == F.col("file")).select(
            "name", "changed", "length", "entry", "digest", F.lit(None).cast("string").alias("run_id")
        )
        told = told.where("digest IS NOT NULL")
        target = f"{folder}{_LOG}/{uuid.uuid4().hex}"
        told.write.parquet(target)
        known = known.union(spark.read.schema(_LOGGED).parquet(target).select("name", "entry"))
    return known.where("entry IS NOT NULL").select("entry.*")


def _read_log(spark: SparkSession, folder: str) -> DataFrame:
    """One line for each file and time, ``told`` of it: what a run wrote rather than what was read."""
    if not modified_entries(spark, f"{folder}{_LOG}"):
        lines = spark.createDataFrame([], _LOGGED)
    else:
        reader = spark.read.schema(_LOGGED).option("recursiveFileLookup", "true")
        lines = reader.parquet(f"{folder}{_LOG}")
    return lines.groupBy("name", "changed", "length").agg(F.max(F.struct("digest", "entry")).alias("told"))


def write_keyed_json(df: DataFrame, folder: str, workers: int | None = None) -> None:
    """Write each row of a ledger layout to ``folder/md5(filepath).json``.

    An entry already there is replaced. With several rows for one path, reduce
    them first (``latest_by_key``). A task writes to remote storage with several
    workers, which hides its latency, and to a plain path with one, which is
    faster on a disk; give ``workers`` for a mounted remote store. Spark merges short
    rows that come out of a shuffle into few tasks: deal them out first (``spread_files``).
    """
    if workers is None:
        workers = 1 if storage.local_path(folder) else WORKERS_PER_PARTITION
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(KeyedJsonSource)
    rows = df.select("*", key_md5(F.col("filepath")).alias(_KEY))
    writer = rows.write.format("keyed_json").mode("append")
    writer.option("path", folder).option("workers", str(workers)).save()
