"""The four batch runs.

``*_rows`` are plans over documents at hand: DataFrame in, DataFrame out,
nothing executed. ``run_*`` start from a folder and execute: list, read and ask
once, write, and hand back a DataFrame over what was written.
"""

import math
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.cluster import written_once
from docenrich.constants import FILES_PER_TASK, LEDGER_SCHEMA, SUCCESS, WORKERS_PER_PARTITION
from docenrich.operators.enrich import CallRules, Client, enrich, settled_replies
from docenrich.operators.extract import Extractor, extract_text
from docenrich.operators.filters import filter_supported
from docenrich.operators.ledger import (
    currently_processed,
    latest_by_key,
    processed_paths,
    skip_processed,
    to_do,
)
from docenrich.operators.partitions import spread_files
from docenrich.operators.shape import (
    shape_flags,
    shape_minimal,
    shape_raw,
    shape_status,
    status_of_ledger,
)
from docenrich.sinks.compaction import open_compacted, to_do_compacted
from docenrich.sinks.journal import drop_journal, journal_folder, journalled_replies
from docenrich.sinks.keyed_json import read_logged_json, write_logged_json
from docenrich.sinks.runs_log import Run, claim_run
from docenrich.sinks.tables import append_ledger, write_csv
from docenrich.sources.files import list_files
from docenrich.sources.ledger import read_ledger_table

ClientFactory = Callable[[], Client]
Extractors = Mapping[str, Extractor]
# From ``file_path`` to ``file_path, content``.
Reader = Callable[[DataFrame], DataFrame]

# The raw run asks once, in another field, and takes any reply that is JSON.
RAW_RULES = CallRules(field="input", max_attempts=1, any_status=True)


def settled_rows(
    files: DataFrame,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    max_workers: int = WORKERS_PER_PARTITION,
    journal: str | None = None,
) -> DataFrame:
    """Extract and ask: ``file_path, http_status, body, attempts, waited_s, outcome, error``.

    ``files`` has ``file_path`` and may have ``content``. A document stays in
    the task that read it: there is no shuffle between reading and asking.
    """
    texts = extract_text(files, extractors)
    return enrich(texts, client_factory, "text", max_workers, rules, journal)


def reuse_replies(paths: DataFrame, ledger_dir: str, run: Run, rules: CallRules) -> DataFrame:
    """The paths to ask about, once those are in the ledger that a run had replies for
    when it broke off.

    Their documents are neither read nor asked about again.
    """
    replies = journalled_replies(paths.sparkSession, ledger_dir)
    if replies is None:
        return paths
    replies = written_once(replies.join(paths, "file_path", "left_semi"), "replies")
    if replies.isEmpty():
        return paths
    append_ledger(settled_replies(replies, rules.any_status), ledger_dir, run)
    return written_once(paths.join(replies, "file_path", "left_anti"), "left")


def raw_rows(
    files: DataFrame,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = RAW_RULES,
) -> DataFrame:
    """Replies as they came."""
    return shape_raw(settled_rows(filter_supported(files), client_factory, extractors, rules))


def minimal_rows(
    files: DataFrame,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
) -> DataFrame:
    """Type and jurisdiction of the files that went through."""
    return shape_minimal(settled_rows(filter_supported(files), client_factory, extractors, rules))


def flags_rows(
    files: DataFrame,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
) -> DataFrame:
    """Every file, with its failure flags."""
    return shape_flags(settled_rows(filter_supported(files), client_factory, extractors, rules))


def status_rows(
    files: DataFrame,
    ledger: DataFrame,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    reader: Reader | None = None,
) -> DataFrame:
    """Status of the files whose latest entry in the ledger is no success.

    Only paths are made distinct, compared and shuffled. The documents of those
    left are read afterwards, by ``reader`` or by opening the files. A table
    that holds ``content`` already is joined to the paths left, which moves its
    bytes if there are too many paths to broadcast.
    """
    files = filter_supported(files)
    left = skip_processed(files.select("file_path").distinct(), currently_processed(ledger))
    documents = _documents(files, left, reader)
    return shape_status(settled_rows(documents, client_factory, extractors, rules))


def _documents(files: DataFrame, left: DataFrame, reader: Reader | None) -> DataFrame:
    if reader is not None:
        return reader(left)
    if "content" not in files.columns:
        return left
    return files.join(left, "file_path", "left_semi").dropDuplicates(["file_path"])


def run_raw(
    spark: SparkSession,
    folder: str,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = RAW_RULES,
    num_partitions: int | None = None,
) -> DataFrame:
    """Raw replies for the files directly in a folder."""
    files = list_files(spark, folder, recursive=False, include_hidden=True)
    spread = spread_files(files, num_partitions)
    return shape_raw(written_once(settled_rows(spread, client_factory, extractors, rules)))


def run_minimal(
    spark: SparkSession,
    root: str,
    csv_path: str,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    num_partitions: int | None = None,
) -> DataFrame:
    """Write the minimal layout of a folder tree as CSV; returns the settled rows."""
    files = spread_files(list_files(spark, root, include_hidden=True), num_partitions)
    settled = written_once(settled_rows(files, client_factory, extractors, rules))
    write_csv(shape_minimal(settled), csv_path)
    return settled


def run_flags(
    spark: SparkSession,
    root: str,
    csv_path: str,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    num_partitions: int | None = None,
) -> DataFrame:
    """Write the flags layout of a folder tree as CSV; returns the settled rows."""
    files = spread_files(list_files(spark, root, include_hidden=True), num_partitions)
    settled = written_once(settled_rows(files, client_factory, extractors, rules))
    write_csv(shape_flags(settled), csv_path)
    return settled


def run_status(
    spark: SparkSession,
    root: str | DataFrame,
    ledger_dir: str,
    client_factory: ClientFactory,
    extractors: Extractors | None = None,
    rules: CallRules = CallRules(),
    num_partitions: int | None = None,
    json_dir: str | None = None,
    waves: int | None = None,
    reader: Reader | None = None,
    max_workers: int = WORKERS_PER_PARTITION,
) -> DataFrame:
    """Ask about the files no earlier run has finished; add them to the ledger.

    ``root`` is a folder tree or a DataFrame with ``file_path`` (and maybe
    ``content``); ``reader`` and ``content`` work as in ``status_rows``.
    With ``json_dir`` earlier successes are looked up in that folder of result
    files too, and the new results written there as well; files that an earlier
    run settled but did not write are made up first. A log beside that folder saves
    opening the files that have not changed since.
    The files are settled in ``waves``, each committed to the ledger before the
    next, and within a wave each reply is kept in a journal until then: neither a
    lost task nor a run that breaks off and is started again repeats calls that
    were settled. By default a wave has at most ``FILES_PER_TASK`` files per core,
    however many files there are.
    Runs may go on at once: each claims a number and an id of its own.
    A ledger that has been compacted (``compact_ledger``) is looked up there.
    Returns ``filepath, type, jurisdiction, status`` of this run's files.
    """
    ledger = read_ledger_table(spark, ledger_dir)
    compacted = open_compacted(spark, ledger_dir)
    run = claim_run(spark, ledger_dir)
    if isinstance(root, DataFrame):
        files = filter_supported(root)
    else:
        files = list_files(spark, root, include_hidden=True)
    if compacted is None:
        left = to_do(files, ledger)
    else:
        # a walk lists no path twice
        left = to_do_compacted(files, compacted, unique=not isinstance(root, DataFrame))
    if json_dir is not None:
        earlier = written_once(read_logged_json(spark, json_dir), "result-files")
        # what is left of a join arrives in few tasks, and each row becomes a file
        write_logged_json(spread_files(_not_in_files(ledger, earlier)), json_dir)
        left = skip_processed(left, processed_paths(earlier))
    left = written_once(left, "left")
    left = reuse_replies(left, ledger_dir, run, rules)
    if waves is None:
        wave_files = FILES_PER_TASK * spark.sparkContext.defaultParallelism
        waves = max(1, math.ceil(left.count() / wave_files))
    if waves > 1:
        left = left.withColumn("wave", F.pmod(F.xxhash64("file_path"), F.lit(waves)))
        left = written_once(left, "waves", partition_by="wave")
    for wave in range(waves):
        paths = left.where(F.col("wave") == wave).drop("wave") if waves > 1 else left
        documents = _documents(files, spread_files(paths, num_partitions), reader)
        journal = journal_folder(ledger_dir, run.id, f"wave-{wave:06d}")
        settled = settled_rows(documents, client_factory, extractors, rules, max_workers, journal)
        append_ledger(settled, ledger_dir, run)
        drop_journal(spark, journal)
    written = read_ledger_table(spark, ledger_dir).where(F.col("run_id") == run.id)
    if json_dir is not None:
        write_logged_json(written.select(*LEDGER_SCHEMA.names), json_dir, run.id)
    return status_of_ledger(written)


def _not_in_files(ledger: DataFrame, earlier: DataFrame) -> DataFrame:
    """The latest ledger entries that no result file tells of. A file that tells
    of a success stays, whatever the ledger says of a later failure."""
    entry, in_file = latest_by_key(ledger.where("filepath IS NOT NULL")), earlier.alias("in_file")
    entry = entry.select(*LEDGER_SCHEMA.names).alias("entry")
    others = [n for n in LEDGER_SCHEMA.names if n != "filepath"]
    same = F.lit(True)
    for name in others:
        same &= F.col(f"entry.{name}").eqNullSafe(F.col(f"in_file.{name}"))
    better = (F.col("in_file.status") == SUCCESS) & (F.col("entry.status") != SUCCESS)
    told = F.coalesce(same | better, F.lit(False))
    return entry.join(
        in_file, (F.col("entry.filepath") == F.col("in_file.filepath")) & told, "left_anti"
    )
