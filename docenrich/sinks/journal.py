"""Replies as they are settled, kept beside the ledger until the ledger has them.

A task that asks a model appends each reply to a journal of its own as soon as it
is settled. If the task is lost, the attempt that takes its place reads what the
earlier ones have settled and asks only about the rest; if the driver is lost, the
next run does (``journalled_replies``). A reply in flight when the worker dies is
the only one that is asked for again.

A journal is a file of JSON lines for each attempt, below a folder for each run,
wave and partition. A line that was cut off has no end mark and is not read. Lines
are flushed, not synced: they survive the process, not the storage. Object stores
cannot append; there a reply is an object of its own.
"""

import json
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich import storage
from docenrich.cluster import delete_folder, modified_entries

FOLDER = "_journal"
_END = "end"
REPLY_TYPES = (
    "http_status int, body string, attempts int, waited_s double, "
    "crashed boolean, call_error string"
)
_LINE_TYPES = f"file_path string, {REPLY_TYPES}, {_END} int"


class Journal:
    """What one task attempt settles, and what earlier attempts of it have settled."""

    def __init__(self, folder: str, partition: int):
        self._folder = f"{folder.rstrip('/')}/part-{partition:06d}"
        self._lock = threading.Lock()
        self._lines = None
        self.known: dict[str, dict] = {}
        for path, descend in storage.list_folder(self._folder):
            if not descend and path.endswith(".jsonl"):
                for line in storage.read_file(path).split(b"\n"):
                    entry = _entry(line)
                    if entry is not None:
                        self.known[entry.pop("file_path")] = entry

    def add(self, path: str, reply: dict) -> None:
        line = json.dumps({"file_path": path, **reply, _END: 1}).encode() + b"\n"
        with self._lock:
            if storage.local_path(self._folder) is None:
                storage.replace_file(f"{self._folder}/{uuid.uuid4().hex}.jsonl", line)
                return
            if self._lines is None:
                self._lines = storage.new_file(f"{self._folder}/{uuid.uuid4().hex}.jsonl")
            self._lines.write(line)
            self._lines.flush()

    def close(self) -> None:
        if self._lines is not None:
            self._lines.close()


def _entry(line: bytes) -> dict | None:
    try:
        entry = json.loads(line)
    except ValueError:
        return None
    return entry if isinstance(entry, dict) and entry.pop(_END, None) == 1 else None


def journal_folder(ledger_dir: str, run_id: str, part: str) -> str:
    return f"{ledger_dir.rstrip('/')}/{FOLDER}/{run_id}/{part}"


def journalled_replies(spark: SparkSession, ledger_dir: str) -> DataFrame | None:
    """``file_path`` and its reply, of every journal that is left; None if there is none.

    One row for each path, and only of replies with a body: calls that failed are
    made again by the next run, as they would be if the ledger told of them.
    """
    root = f"{ledger_dir.rstrip('/')}/{FOLDER}"
    if not modified_entries(spark, root):
        return None
    try:
        lines = (
            spark.read.schema(_LINE_TYPES)
            .option("recursiveFileLookup", "true")
            .option("ignoreMissingFiles", "true")
            .json(root)
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    names = [n for n in lines.columns if n not in ("file_path", _END)]
    return (
        lines.where((F.col(_END) == 1) & F.col("body").isNotNull())
        .groupBy("file_path")
        .agg(F.max(F.struct(*names)).alias("reply"))
        .select("file_path", "reply.*")
    )


def drop_journal(spark: SparkSession, folder: str) -> None:
    """Let go of a journal whose replies the ledger has."""
    delete_folder(spark, folder)


def drop_old_journals(spark: SparkSession, ledger_dir: str, before: float) -> None:
    """Let go of the journals of runs that wrote nothing since ``before`` (seconds since 1970)."""
    root = f"{ledger_dir.rstrip('/')}/{FOLDER}"
    for run_id, _ in modified_entries(spark, root):
        waves = modified_entries(spark, f"{root}/{run_id}")
        tasks = [entry for wave, _ in waves for entry in modified_entries(spark, f"{root}/{run_id}/{wave}")]
        if all(changed < before for _, changed in waves + tasks):
            delete_folder(spark, f"{root}/{run_id}")
