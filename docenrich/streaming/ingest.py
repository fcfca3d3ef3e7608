"""Only the files that have arrived since the last run.

Increments come from the executors' own walk, compared with the table of files
seen, so empty and hidden files arrive and the driver holds no listing. A stream
over that table, which has few files, settles each increment once.
"""

import math
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich import storage
from docenrich.cluster import ship_package, written_once
from docenrich.constants import PATH_SCHEMA
from docenrich.operators.enrich import CallRules
from docenrich.operators.ledger import skip_processed, to_do
from docenrich.operators.partitions import spread_files
from docenrich.plans.runs import ClientFactory, Extractors, reuse_replies, settled_rows
from docenrich.sinks.journal import drop_journal, journal_folder
from docenrich.sinks.runs_log import claim_run
from docenrich.sinks.tables import append_ledger
from docenrich.sources.files import list_files
from docenrich.sources.ledger import read_ledger_table

_SEEN = "file_path string, modified timestamp, length long"
_SEEN_ARROW = pa.schema(
    [("file_path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64())]
)


def read_seen(spark: SparkSession, out: str) -> DataFrame:
    """The table of files seen; a missing one is empty."""
    try:
        return spark.read.schema(_SEEN).parquet(out)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SEEN)


def ingest_new(
    spark: SparkSession, root: str, out: str, files_per_batch: int | None = None
) -> DataFrame:
    """Append the files not seen before to a table, and return the table.

    ``file_path, modified, length``; the last two are NULL for a file that was
    gone again. The contents are never read. The table remembers files it has
    seen, whatever became of them; which of them have gone through is the
    ledger's business. A part file holds about ``files_per_batch`` of them.
    """
    seen = read_seen(spark, out).select(F.col("file_path").alias("filepath"))
    listed = list_files(spark, root, include_hidden=True).distinct()
    arrived = written_once(skip_processed(listed, seen), "arrived")
    parts = None
    if files_per_batch is not None:
        parts = max(1, math.ceil(arrived.count() / files_per_batch))
    ship_package(spark)
    facts = spread_files(arrived, parts).mapInArrow(_facts, _SEEN)
    facts.write.mode("append").parquet(out)
    return spark.read.schema(_SEEN).parquet(out)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for path in batch.column("file_path").to_pylist():
                changed, length = storage.file_facts(path) or (None, None)
                if changed is not None:
                    changed = datetime.fromtimestamp(changed, timezone.utc)
                yield {"file_path": path, "modified": changed, "length": length}, len(path)

    return storage.arrow_batches(rows(), _SEEN_ARROW)


def settle_new(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    ledger_dir: str,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    files_per_batch: int | None = None,
    num_partitions: int | None = None,
) -> None:
    """Ask about the files not seen before and add them to the ledger, then stop.

    Each batch is a run of its own. Should one be repeated after a crash, the
    files it had finished are already in the ledger and are skipped.
    ``checkpoint`` holds the table of files seen and the stream's place in it.
    """
    settle = _settle_batch(ledger_dir, client_factory, extractors, rules, num_partitions)
    ingest_new(spark, root, f"{checkpoint}/seen", files_per_batch)
    reader = spark.readStream.schema(_SEEN)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", 1)
    query = (
        reader.parquet(f"{checkpoint}/seen")
        .select(*PATH_SCHEMA.names)
        .writeStream.foreachBatch(settle)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _settle_batch(
    ledger_dir: str,
    client_factory: ClientFactory,
    extractors: Extractors | None,
    rules: CallRules,
    num_partitions: int | None,
) -> Callable[[DataFrame, int], None]:
    def settle(batch: DataFrame, batch_id: int) -> None:
        ledger = read_ledger_table(batch.sparkSession, ledger_dir)
        spark = batch.sparkSession
        run = claim_run(spark, ledger_dir)
        left = reuse_replies(written_once(to_do(batch, ledger), "left"), ledger_dir, run, rules)
        journal = journal_folder(ledger_dir, run.id, f"batch-{batch_id:06d}")
        settled = settled_rows(
            spread_files(left, num_partitions), client_factory, extractors, rules, journal=journal
        )
        append_ledger(settled, ledger_dir, run)
        drop_journal(spark, journal)

    return settle
