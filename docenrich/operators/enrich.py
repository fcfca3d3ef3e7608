"""Asking a model about each document, with bounded concurrency and retry.

A *client* is a callable ``payload -> (http_status, body)`` that raises
``OSError`` (as every common HTTP library does) when no answer came. A *client
factory* builds one per partition, on the executor, so that connections and
secrets never enter the plan. The factory must set a request timeout.
"""

import json
import time
import warnings
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.cluster import ship_package
from docenrich.constants import (
    API_FAILURE,
    BACKOFF_BASE,
    ERROR,
    EXTRACTION_FAILURE,
    MAX_ATTEMPTS,
    SUCCESS,
    WORKERS_PER_PARTITION,
)
from docenrich.functions.replies import OBJECT, OTHER, reply_kind
from docenrich.operators.skew import salted_left_join
from docenrich.sinks.journal import REPLY_TYPES, Journal
from docenrich.storage import describe, released, valid_text

Client = Callable[[dict], tuple[int, str]]

_REPLY_FIELDS = [
    ("http_status", pa.int32()),
    ("body", pa.string()),
    ("attempts", pa.int32()),
    ("waited_s", pa.float64()),
    ("crashed", pa.bool_()),
    ("call_error", pa.string()),
]


class CallRules(NamedTuple):
    """How one request is made, and made again."""

    field: str = "text"
    max_attempts: int = MAX_ATTEMPTS
    backoff: float = BACKOFF_BASE
    any_status: bool = False
    sleep: Callable[[float], None] = time.sleep


def enrich(
    df: DataFrame,
    client_factory: Callable[[], Client],
    text_col: str = "text",
    max_workers: int = WORKERS_PER_PARTITION,
    rules: CallRules = CallRules(),
    journal: str | None = None,
) -> DataFrame:
    """One request per row, ``max_workers`` at a time in each partition.

    Adds ``http_status, body, attempts, waited_s`` and settles ``outcome`` and
    ``error``; the text itself is not carried further. Rows without a text, and
    rows whose ``outcome`` is already settled, are kept but not asked about.

    Calls are made at least once: a lost task makes its calls again, so write
    the result before using it twice, and leave speculation off for that job.
    With ``journal``, a folder all executors share that is used for this one job,
    each reply is kept as soon as it is settled, by ``file_path``; a task that
    takes the place of a lost one repeats only what was in flight.
    Requests in flight are at most running tasks times ``max_workers``.
    """
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation repeats the calls of slow tasks", stacklevel=2)
    pending = F.col("outcome").isNull() if "outcome" in df.columns else F.lit(True)
    kept = [c for c in df.columns if c not in (text_col, "outcome", "error")]
    carried = df.select(
        *kept,
        F.when(pending, F.col(text_col)).alias("request_text"),
        _column_or_null(df, "outcome"),
        _column_or_null(df, "error"),
    )
    out_fields = [f for f in carried.schema.fields if f.name != "request_text"]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields)
    answered = carried.mapInArrow(
        released(lambda batches: _call_batches(batches, client_factory, max_workers, rules, journal)),
        f"{out_schema}, {REPLY_TYPES}",
    )
    return settled_replies(answered, rules.any_status)


def settled_replies(answered: DataFrame, any_status: bool = False) -> DataFrame:
    """Settle ``outcome`` and ``error`` of rows with the columns of a reply."""
    reply = [name for name, _ in _REPLY_FIELDS]
    kept = [c for c in answered.columns if c not in (*reply, "outcome", "error")]
    return answered.select(
        *kept,
        "http_status",
        "body",
        "attempts",
        "waited_s",
        F.coalesce(_column_or_null(answered, "outcome"), _outcome(any_status)).alias("outcome"),
        F.coalesce(_column_or_null(answered, "error"), F.col("call_error")).alias("error"),
    )


def enrich_from_replies(
    files: DataFrame, stored: DataFrame, order_col: str | None = None, spread_hot: bool = False
) -> DataFrame:
    """Answer from a table ``file_path, body`` of replies instead of a model.

    A file without a stored reply has failed like one the model never answered.
    Of several replies to a path the last by ``order_col`` counts, or else the
    greatest: each task reduces its own, so neither a path stored over and over
    nor a file listed over and over multiplies rows. With ``spread_hot`` the rows of
    paths that have very many are spread over tasks (``salted_left_join``), at the
    price of a look at all paths first.
    """
    latest = F.max(F.struct(order_col, "body"))["body"] if order_col else F.max("body")
    by_path = stored.where(F.col("file_path").isNotNull()).groupBy("file_path")
    replies = by_path.agg(latest.alias("body"))
    if spread_hot:
        joined = salted_left_join(files, replies, "file_path")
    else:
        joined = files.join(replies, "file_path", "left")
    settled = F.when(F.col("body").isNull(), F.lit(API_FAILURE)).otherwise(
        _outcome_of_body(F.col("body"))
    )
    return joined.withColumn(
        "outcome", F.coalesce("outcome", settled) if "outcome" in files.columns else settled
    )


def _column_or_null(df: DataFrame, name: str) -> Column:
    column = F.col(name) if name in df.columns else F.lit(None)
    return column.cast("string").alias(name)


def _outcome_of_body(body: Column) -> Column:
    kind = reply_kind(body)
    return (
        F.when(kind == OBJECT, F.lit(SUCCESS))
        .when(kind == OTHER, F.lit(ERROR))
        .otherwise(F.lit(API_FAILURE))
    )


def _outcome(any_status: bool) -> Column:
    body = F.col("body")
    by_reply = (
        F.when(body.isNotNull(), F.lit(SUCCESS)).otherwise(F.lit(API_FAILURE))
        if any_status
        else _outcome_of_body(body)
    )
    return (
        F.when(F.col("attempts") == 0, F.lit(EXTRACTION_FAILURE))
        .when(F.col("crashed"), F.lit(ERROR))
        .otherwise(by_reply)
    )


def _no_number(name: str) -> None:
    """``NaN`` and ``Infinity`` are not JSON."""
    raise json.JSONDecodeError("not a JSON value", name, 0)


def ask(client: Client, text: str | None, rules: CallRules) -> dict:
    """Every attempt for one text. ``body`` is set only by a decisive reply."""
    reply = {
        "http_status": None,
        "body": None,
        "attempts": 0,
        "waited_s": 0.0,
        "crashed": False,
        "call_error": None,
    }
    if text is None:
        return reply
    for attempt in range(1, rules.max_attempts + 1):
        reply["attempts"] = attempt
        try:
            status, body = client({rules.field: text})
            reply["http_status"] = status
            if status == 200 or rules.any_status:
                json.loads(body or "", parse_constant=_no_number)
                reply["body"], reply["call_error"] = valid_text(body), None
                return reply
            reply["call_error"] = valid_text(f"status {status}: {body}" if body else f"status {status}")
            if status != 429:
                return reply
        except OSError as problem:
            reply["http_status"] = None
            reply["call_error"] = describe(problem)
        except json.JSONDecodeError as problem:
            reply["call_error"] = f"malformed reply: {problem}"
        except Exception as problem:  # noqa: BLE001 - one bad file must not fail the job
            reply["crashed"] = True
            reply["call_error"] = describe(problem)
            return reply
        if attempt < rules.max_attempts:
            wait = rules.backoff**attempt
            reply["waited_s"] += wait
            rules.sleep(wait)
    return reply


def _ask_once(client: Client, path: str, text: str | None, rules: CallRules, kept: Journal) -> dict:
    """``ask``, unless an earlier attempt of the task has settled the path."""
    if text is None:
        return ask(client, text, rules)
    if path in kept.known:
        return kept.known[path]
    reply = ask(client, text, rules)
    kept.add(path, reply)
    return reply


def _call_batches(
    batches: Iterator[pa.RecordBatch],
    client_factory: Callable[[], Client],
    max_workers: int,
    rules: CallRules,
    journal: str | None,
) -> Iterator[pa.RecordBatch]:
    # A few slices are in flight at once, so a text that backs off for long
    # holds up neither the pool nor more than these slices in memory.
    slice_rows, slices_ahead = max_workers * 4, 8
    client = client_factory()
    kept = Journal(journal, TaskContext.get().partitionId()) if journal else None
    waiting: deque[tuple[pa.RecordBatch, list[Future]]] = deque()
    try:
        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            for batch in batches:
                texts_at = batch.schema.get_field_index("request_text")
                rest = [n for n in batch.schema.names if n != "request_text"]
                for start in range(0, batch.num_rows, slice_rows):
                    part = batch.slice(start, slice_rows)
                    texts = part.column(texts_at).to_pylist()
                    if kept is None:
                        calls = [pool.submit(ask, client, text, rules) for text in texts]
                    else:
                        paths = part.column(part.schema.get_field_index("file_path")).to_pylist()
                        calls = [
                            pool.submit(_ask_once, client, path, text, rules, kept)
                            for path, text in zip(paths, texts)
                        ]
                    waiting.append((part.select(rest), calls))
                    if len(waiting) >= slices_ahead:
                        yield _finish(*waiting.popleft())
            while waiting:
                yield _finish(*waiting.popleft())
    finally:
        if kept is not None:
            kept.close()
        close = getattr(client, "close", None)
        if close is not None:
            close()


def _finish(rows: pa.RecordBatch, calls: list[Future]) -> pa.RecordBatch:
    answers = [call.result() for call in calls]
    columns = [pa.array([a[name] for a in answers], kind) for name, kind in _REPLY_FIELDS]
    return pa.RecordBatch.from_arrays(
        [*rows.columns, *columns], names=[*rows.schema.names, *(n for n, _ in _REPLY_FIELDS)]
    )
