"""One registered query per operator, each over whole tables."""

import os
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.clients import OneShotClient, RuleClient, no_wait
from docenrich import storage
from docenrich.cluster import scratch_path, ship_package
from docenrich.constants import DOCX_SUFFIX, LEDGER_TABLE_SCHEMA, PDF_SUFFIX
from docenrich.functions import paths, replies, retry, text
from docenrich.operators import assemble, attempts, filters, ledger, shape
from docenrich.operators.enrich import CallRules, enrich, enrich_from_replies
from docenrich.operators.extract import explode_pages, extract_parts, extract_text
from docenrich.operators.partitions import map_partitions, repartitioned, spread_files, spread_scan
from docenrich.operators.replies import parse_reply
from docenrich.plans import runs
from docenrich.sinks.compaction import (
    compact_ledger,
    latest_entries,
    open_compacted,
    to_do_compacted,
)
from docenrich.sinks.journal import journal_folder
from docenrich.sinks.keyed_json import write_keyed_json
from docenrich.sinks.tables import append_ledger, preview, read_csv, write_csv
from docenrich.sources.files import list_files, paths_df, read_bytes
from docenrich.sources.paged import list_paged
from docenrich.sources.ledger import read_corrupt, read_ledger, read_ledger_table
from docenrich.streaming.ingest import ingest_new, settle_new

Query = Callable[[SparkSession, str], DataFrame]

RULES = CallRules(sleep=no_wait)
RAW_RULES = runs.RAW_RULES._replace(sleep=no_wait)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark, os.path.dirname(os.path.abspath(__file__)))
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.doc_files(spark, sf_dir).select("file_path")


# --- sources ---------------------------------------------------------------


@query
def list_files_(spark, sf_dir):
    root = inputs.file_tree(spark, sf_dir)
    listed = list_files(spark, root)
    return listed.select(inputs.below(root, F.col("file_path")).alias("file_path"))


@query
def list_files_index(spark, sf_dir):
    root = inputs.file_tree(spark, sf_dir)
    # the whole tree, hidden files too; this one has none
    listed = list_files(spark, root, include_hidden=True)
    return listed.select(inputs.below(root, F.col("file_path")).alias("file_path"))


@query
def list_files_flat(spark, sf_dir):
    root = inputs.file_tree(spark, sf_dir, flat=True)
    listed = list_files(spark, root, recursive=False)
    return listed.select(inputs.below(root, F.col("file_path")).alias("file_path"))


@query
def list_files_paged(spark, sf_dir):
    root = storage.local_path(inputs.file_tree(spark, sf_dir, flat=True))
    listed = list_paged(spark, root, inputs.indexed_pages(spark, root), page_names=100)
    listed = filters.filter_supported(listed)
    return listed.select(inputs.below(root, F.col("file_path")).alias("file_path"))


@query
def paths_df_(spark, sf_dir):
    return paths_df(spark, inputs.doc_files(spark, sf_dir))


@query
def read_bytes_(spark, sf_dir):
    root = inputs.file_tree(spark, sf_dir)
    return read_bytes(spark, root).select(
        inputs.below(root, F.col("file_path")).alias("file_path"),
        F.length("content").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


@query
def read_bytes_index(spark, sf_dir):
    root = inputs.file_tree(spark, sf_dir)
    # of paths that are listed already
    return read_bytes(spark, spread_scan(list_files(spark, root))).select(
        inputs.below(root, F.col("file_path")).alias("file_path"),
        F.length("content").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


def _mixed_ledger(spark, sf_dir):
    """A folder of result files. Those of failed documents hold the bare reply,
    or half an entry where there was none: no entries, and partly no JSON."""
    rows = inputs.answered(spark, sf_dir).select(
        "outcome", "body", F.struct(*shape.shape_ledger_columns()).alias("entry")
    )
    content = F.when(F.col("outcome") == "success", F.to_json("entry")).otherwise(
        F.coalesce("body", F.lit('{"filepath": "trunc'))
    )
    folder = scratch_path(spark, "ledger")
    files = rows.select(
        F.concat(F.lit("/"), paths.key_md5(F.col("entry.filepath"))).alias("file_path"),
        F.encode(content, "UTF-8").alias("content"),
    )
    # short rows of a join arrive in few tasks, and each becomes a file
    inputs.write_tree(spread_files(files), folder)
    return folder


@query
def read_ledger_(spark, sf_dir):
    return read_ledger(spark, _mixed_ledger(spark, sf_dir))


@query
def read_corrupt_(spark, sf_dir):
    corrupt = read_corrupt(spark, _mixed_ledger(spark, sf_dir))
    return corrupt.select(F.substring_index("file", "/", -1).alias("file"), "value")


# --- filters ---------------------------------------------------------------


@query
def filter_supported(spark, sf_dir):
    return filters.filter_supported(_paths(spark, sf_dir))


@query
def unsupported_guard(spark, sf_dir):
    files = inputs.doc_files(spark, sf_dir).select("file_path", "text")
    return filters.guard_unsupported(files)


@query
def drop_failed(spark, sf_dir):
    return filters.drop_failed(inputs.answered(spark, sf_dir)).select("file_path", "body")


@query
def drop_empty_reply(spark, sf_dir):
    return filters.drop_empty_reply(inputs.replies(spark, sf_dir))


@query
def skip_blank_pages(spark, sf_dir):
    return filters.skip_blank_pages(inputs.doc_pages(spark, sf_dir))


@query
def ledger_success(spark, sf_dir):
    return filters.successful(inputs.ledger(spark, sf_dir))


# --- text ------------------------------------------------------------------


@query
def extract_text_(spark, sf_dir):
    return extract_text(inputs.doc_bytes(spark, sf_dir), inputs.EXTRACTORS)


@query
def explode_pages_(spark, sf_dir):
    return explode_pages(inputs.doc_files(spark, sf_dir).select("file_path", "text"))


@query
def page_section(spark, sf_dir):
    pages = filters.skip_blank_pages(inputs.doc_pages(spark, sf_dir))
    section = text.page_section(F.col("page_no"), F.col("text"))
    return pages.select("file_path", "page_no", section.alias("section"))


@query
def join_pages(spark, sf_dir):
    return assemble.join_pages(inputs.doc_pages(spark, sf_dir))


@query
def docx_paragraphs(spark, sf_dir):
    files = inputs.doc_bytes(spark, sf_dir).where(F.col("file_path").endswith(DOCX_SUFFIX))
    parts = extract_parts(files, inputs.EXTRACTORS)
    return parts.select("file_path", F.col("part_no").alias("para_no"), "text")


@query
def join_paragraphs(spark, sf_dir):
    return assemble.join_paragraphs(inputs.doc_pages(spark, sf_dir), no_col="page_no")


@query
def placeholder_text(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "file_path", paths.placeholder_text(F.col("file_path")).alias("text")
    )


# --- enrichment ------------------------------------------------------------


@query
def enrich_(spark, sf_dir):
    texts = spread_scan(inputs.doc_files(spark, sf_dir).select("file_path", "text"))
    files = filters.guard_unsupported(texts)
    return enrich(files, RuleClient, rules=RULES).drop("error")


@query
def enrich_from_replies_(spark, sf_dir):
    return enrich_from_replies(_paths(spark, sf_dir), inputs.replies(spark, sf_dir))


@query
def enrich_hot_path(spark, sf_dir):
    """A third of all files, and of all stored replies, are of one path."""
    hot = F.when(F.col("doc_id") % 3 == 0, F.lit("/corpus/hot.pdf")).otherwise(F.col("file_path"))
    files = inputs.doc_files(spark, sf_dir).select("doc_id", hot.alias("file_path"))
    stored = inputs.replies(spark, sf_dir).select("body", "file_path").join(
        inputs.doc_files(spark, sf_dir).select("file_path", hot.alias("hot_path")), "file_path"
    )
    stored = stored.select(F.col("hot_path").alias("file_path"), "body")
    return enrich_from_replies(files, stored, spread_hot=True)


@query
def request_payload(spark, sf_dir):
    return inputs.doc_files(spark, sf_dir).select(
        "file_path",
        replies.request_payload(F.col("text")).alias("payload"),
        replies.request_payload(F.col("text"), "input").alias("raw_payload"),
    )


@query
def classify_status(spark, sf_dir):
    return inputs.attempts(spark, sf_dir).select(
        "event_id", "http_status", retry.classify_status(F.col("http_status")).alias("action")
    )


@query
def resolve_attempts(spark, sf_dir):
    return attempts.resolve_attempts(
        inputs.attempts(spark, sf_dir), inputs.CALL, inputs.CALL_ORDER
    )


def _waits(spark, sf_dir):
    log = inputs.attempts(spark, sf_dir)
    return attempts.with_waits(attempts.number_attempts(log, inputs.CALL, inputs.CALL_ORDER))


@query
def backoff_schedule(spark, sf_dir):
    numbered = attempts.number_attempts(
        inputs.attempts(spark, sf_dir), inputs.CALL, inputs.CALL_ORDER
    )
    schedule = retry.backoff_schedule()
    return numbered.select(
        "event_id",
        "attempt_no",
        F.element_at(schedule, F.col("attempt_no")).alias("wait_s"),
        F.aggregate(schedule, F.lit(0.0), lambda a, b: a + b).alias("total_s"),
    )


@query
def format_wait(spark, sf_dir):
    return _waits(spark, sf_dir).where(F.col("wait_s").isNotNull()).select(
        "event_id", retry.format_wait(F.col("wait_s")).alias("wait")
    )


@query
def retry_log(spark, sf_dir):
    return attempts.retry_log(_waits(spark, sf_dir)).select("event_id", "level", "message")


@query
def parse_reply_(spark, sf_dir):
    return parse_reply(inputs.replies(spark, sf_dir)).drop("body")


# --- row shaping -----------------------------------------------------------


@query
def get_or_default(spark, sf_dir):
    body = F.col("body")
    return inputs.replies(spark, sf_dir).select(
        "file_path",
        replies.get_or_default(body, "type", "Unknown Type").alias("type"),
        replies.get_or_default(body, "jurisdiction", "Unknown Jurisdiction").alias("jurisdiction"),
    )


@query
def shape_raw(spark, sf_dir):
    return shape.shape_raw(inputs.answered(spark, sf_dir))


@query
def shape_minimal(spark, sf_dir):
    return shape.shape_minimal(inputs.answered(spark, sf_dir))


@query
def shape_flags(spark, sf_dir):
    return shape.shape_flags(inputs.answered(spark, sf_dir))


@query
def shape_status(spark, sf_dir):
    return shape.shape_status(inputs.answered(spark, sf_dir))


@query
def shape_ledger(spark, sf_dir):
    return shape.shape_ledger(inputs.answered(spark, sf_dir))


@query
def failure_log(spark, sf_dir):
    return shape.failure_log(inputs.answered(spark, sf_dir))


# --- ledger ----------------------------------------------------------------


@query
def skip_processed(spark, sf_dir):
    listed = filters.filter_supported(_paths(spark, sf_dir))
    return ledger.to_do(listed, inputs.ledger(spark, sf_dir))


@query
def skip_processed_by_key(spark, sf_dir):
    done = ledger.currently_processed(inputs.ledger(spark, sf_dir))
    listed = filters.filter_supported(_paths(spark, sf_dir))
    return ledger.skip_processed(listed, ledger.processed_keys(done), key="md5")


@query
def processed_paths(spark, sf_dir):
    return ledger.processed_paths(inputs.ledger(spark, sf_dir))


@query
def latest_by_key(spark, sf_dir):
    return ledger.latest_by_key(inputs.ledger(spark, sf_dir))


@query
def union_results(spark, sf_dir):
    done = inputs.answered(spark, sf_dir)
    by_suffix = [done.where(F.col("file_path").endswith(s)) for s in (PDF_SUFFIX, DOCX_SUFFIX)]
    return ledger.union_results(*[shape.shape_minimal(part) for part in by_suffix])


@query
def preview_(spark, sf_dir):
    return preview(shape.shape_status(inputs.answered(spark, sf_dir)))


# --- scalars ---------------------------------------------------------------


@query
def key_md5(spark, sf_dir):
    return _paths(spark, sf_dir).select("file_path", paths.key_md5(F.col("file_path")).alias("key"))


@query
def key_stem(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "file_path", paths.key_stem(F.col("file_path")).alias("key")
    )


@query
def path_join(spark, sf_dir):
    slash = F.when(F.col("n_chars") > 1000, "/").otherwise("")
    folder = F.concat(F.lit("/out/"), "lang", slash)
    return inputs.doc_files(spark, sf_dir).select(
        "file_path",
        paths.path_join(folder, paths.key_stem(F.col("file_path"))).alias("target"),
    )


@query
def to_json_row(spark, sf_dir):
    rows = shape.shape_status(inputs.answered(spark, sf_dir))
    row = replies.to_json_row(*[F.col(c) for c in rows.columns])
    return rows.select("filepath", row.alias("json"))


# --- sinks -----------------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    rows = shape.shape_flags(inputs.answered(spark, sf_dir))
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query
def keyed_json_round_trip(spark, sf_dir):
    folder = scratch_path(spark, "keyed")
    # short rows of a join arrive in few tasks, and each becomes a file
    rows = spread_files(shape.shape_ledger(inputs.answered(spark, sf_dir)))
    write_keyed_json(rows.withColumn("status", F.lit("error")), folder)
    write_keyed_json(rows, folder)
    return read_ledger(spark, folder)


@query
def ledger_round_trip(spark, sf_dir):
    folder = scratch_path(spark, "ledger")
    append_ledger(inputs.answered(spark, sf_dir), folder, 1)
    files = filters.guard_unsupported(inputs.doc_files(spark, sf_dir).select("file_path", "text"))
    failed = ledger.skip_processed(
        files, ledger.currently_processed(read_ledger_table(spark, folder))
    )
    append_ledger(enrich(failed, RuleClient, rules=RULES), folder, 2)
    return ledger.latest_by_key(read_ledger_table(spark, folder)).drop("error", "run_id")


# --- partitions and streams ------------------------------------------------


@query
def repartitioned_(spark, sf_dir):
    return repartitioned(_paths(spark, sf_dir))


def _text_lengths(batches):
    for batch in batches:
        lengths = pc.utf8_length(batch.column("text")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("file_path"), lengths], names=["file_path", "text_length"]
        )


@query
def map_partitions_(spark, sf_dir):
    files = inputs.doc_files(spark, sf_dir).select("file_path", "text")
    return map_partitions(files, _text_lengths, "file_path string, text_length long")


@query
def ingest_new_(spark, sf_dir):
    root, state = inputs.file_tree(spark, sf_dir), scratch_path(spark, "ingest")
    table = ingest_new(spark, root, f"{state}/table")
    return table.select(inputs.below(root, F.col("file_path")).alias("file_path"), "length")


# --- end to end ------------------------------------------------------------


@query
def raw_run(spark, sf_dir):
    files = inputs.doc_bytes(spark, sf_dir)
    return runs.raw_rows(files, OneShotClient, inputs.EXTRACTORS, RAW_RULES)


@query
def minimal_run(spark, sf_dir):
    files = inputs.doc_bytes(spark, sf_dir)
    return runs.minimal_rows(files, RuleClient, inputs.EXTRACTORS, RULES)


@query
def flags_run(spark, sf_dir):
    files = inputs.doc_bytes(spark, sf_dir)
    return runs.flags_rows(files, RuleClient, inputs.EXTRACTORS, RULES)


@query
def status_run(spark, sf_dir):
    """Paths and ledger are compared; only the files left over are opened."""
    root = inputs.byte_tree(spark, sf_dir)
    root = storage.local_path(root) or root
    files = _paths(spark, sf_dir).select(F.concat(F.lit(root), "file_path").alias("file_path"))
    earlier = inputs.ledger(spark, sf_dir)
    earlier = earlier.withColumn("filepath", F.concat(F.lit(root), "filepath"))
    status = runs.status_rows(files, earlier, RuleClient, inputs.EXTRACTORS, RULES)
    return status.withColumn("filepath", inputs.below(root, F.col("filepath")))


def _few_tasks(spark):
    return 4 * spark.sparkContext.defaultParallelism


@query
def resumed_run(spark, sf_dir):
    """Two runs over a folder of files: the second asks about the failed ones again."""
    root, folder = inputs.file_tree(spark, sf_dir), scratch_path(spark, "ledger")
    for _ in range(2):
        runs.run_status(
            spark, root, folder, RuleClient, inputs.LINE_EXTRACTORS, RULES, _few_tasks(spark)
        )
    latest = ledger.latest_by_key(read_ledger_table(spark, folder)).drop("error", "run_id")
    return latest.withColumn("filepath", inputs.below(root, F.col("filepath")))


@query
def resumed_files_run(spark, sf_dir):
    """Two runs in waves, the second with a folder of result files: those of the
    first are made up."""
    root, state = inputs.file_tree(spark, sf_dir), scratch_path(spark, "files")
    for json_dir in (None, f"{state}/json"):
        runs.run_status(
            spark, root, f"{state}/ledger", RuleClient, inputs.LINE_EXTRACTORS, RULES,
            _few_tasks(spark), json_dir=json_dir, waves=2,
        )
    entries = read_ledger(spark, f"{state}/json")
    return entries.withColumn("filepath", inputs.below(root, F.col("filepath")))


@query
def compacted_run(spark, sf_dir):
    """Runs with a compaction after each of the first two; the third finds nothing new."""
    root, folder = inputs.file_tree(spark, sf_dir), scratch_path(spark, "ledger")
    for last in (False, False, True):
        runs.run_status(
            spark, root, folder, RuleClient, inputs.LINE_EXTRACTORS, RULES, _few_tasks(spark)
        )
        if not last:
            compact_ledger(spark, folder)
    # failed documents are asked about once more by the last run; they fail again
    latest = latest_entries(spark, folder).drop("error", "run_id", "run_seq")
    return latest.withColumn("filepath", inputs.below(root, F.col("filepath")))


@query
def skip_processed_compacted(spark, sf_dir):
    """The first run of the ledger is compacted, the second is its tail."""
    folder = scratch_path(spark, "ledger")
    for number, part in enumerate(inputs.ledger_runs(spark, sf_dir)):
        blank = [n for n in LEDGER_TABLE_SCHEMA.names if n not in part.columns]
        rows = part.withColumns({n: F.lit(None).cast("string") for n in blank})
        rows.select(LEDGER_TABLE_SCHEMA.names).write.parquet(f"{folder}/run-{number}/all")
        if number == 0:
            compact_ledger(spark, folder)
    listed = filters.filter_supported(_paths(spark, sf_dir))
    return to_do_compacted(listed, open_compacted(spark, folder), unique=True)


@query
def restarted_run(spark, sf_dir):
    """A run that broke off with all replies journalled, and the one after it."""
    root, folder = inputs.file_tree(spark, sf_dir), scratch_path(spark, "ledger")
    files = repartitioned(list_files(spark, root), _few_tasks(spark))
    broken_off = runs.settled_rows(
        files, RuleClient, inputs.LINE_EXTRACTORS, RULES, journal=journal_folder(folder, "lost", "wave")
    )
    broken_off.write.format("noop").mode("append").save()
    status = runs.run_status(
        spark, root, folder, RuleClient, inputs.LINE_EXTRACTORS, RULES, _few_tasks(spark)
    )
    return status.withColumn("filepath", inputs.below(root, F.col("filepath")))


@query
def raw_folder_run(spark, sf_dir):
    """From a flat listing, spread over tasks, to raw replies."""
    root = inputs.file_tree(spark, sf_dir, flat=True)
    replied = runs.run_raw(
        spark, root, OneShotClient, inputs.LINE_EXTRACTORS, RAW_RULES, _few_tasks(spark)
    )
    return replied.select(inputs.below(root, F.col("file_path")).alias("file_path"), "body")


def _written_and_read(spark, sf_dir, run, shape_rows):
    root, path = inputs.file_tree(spark, sf_dir), scratch_path(spark, "csv")
    settled = run(
        spark, root, path, RuleClient, inputs.LINE_EXTRACTORS, RULES, _few_tasks(spark)
    )
    rows = read_csv(spark, path, shape_rows(settled).schema)
    return rows.withColumn("filepath", inputs.below(root, F.col("filepath")))


@query
def minimal_folder_run(spark, sf_dir):
    return _written_and_read(spark, sf_dir, runs.run_minimal, shape.shape_minimal)


@query
def flags_folder_run(spark, sf_dir):
    return _written_and_read(spark, sf_dir, runs.run_flags, shape.shape_flags)


@query
def streamed_run(spark, sf_dir):
    """The same folder through a stream, in one go."""
    root, state = inputs.file_tree(spark, sf_dir), scratch_path(spark, "stream")
    settle_new(
        spark, root, f"{state}/checkpoint", f"{state}/ledger", RuleClient,
        inputs.LINE_EXTRACTORS, RULES, num_partitions=_few_tasks(spark),
    )
    settled = read_ledger_table(spark, f"{state}/ledger")
    return settled.select(
        inputs.below(root, F.col("filepath")).alias("filepath"),
        "type", "jurisdiction", "status", "outcome",
    )
