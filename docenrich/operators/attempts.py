"""Applying the retry rules to a log of attempts."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docenrich.constants import (
    API_FAILURE,
    BACKOFF_BASE,
    BUSY_MESSAGE,
    MAX_ATTEMPTS,
    OPEN,
    RETRY_MESSAGE,
    SUCCESS,
)
from docenrich.functions import retry


def number_attempts(
    attempts: DataFrame,
    call_cols: Sequence[str],
    order_cols: Sequence[str],
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """The attempts of each call that count, numbered from 1.

    Rank and limit together let Spark cut every task's share of a call to
    ``max_attempts`` rows before the shuffle, so an endless call stays small.
    """
    in_order = Window.partitionBy(*call_cols).orderBy(*order_cols)
    return attempts.withColumn("attempt_no", F.row_number().over(in_order)).where(
        F.col("attempt_no") <= max_attempts
    )


def with_waits(numbered: DataFrame, base: float = BACKOFF_BASE) -> DataFrame:
    """Seconds asked for after each attempt to be repeated, NULL after the rest."""
    repeated = retry.classify_status(F.col("http_status")) == retry.RETRY
    return numbered.withColumn(
        "wait_s", F.when(repeated, retry.wait_after(F.col("attempt_no"), base))
    )


def retry_log(waits: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Adds ``level, message`` to the attempts to be repeated, and keeps only those.

    Takes the result of ``with_waits``; what a column ``error`` says of a failed
    request ends its message.
    """
    error = F.col("error") if "error" in waits.columns else F.lit(None).cast("string")
    busy = F.col("http_status") == 429
    return waits.where(F.col("wait_s").isNotNull()).withColumns(
        {
            "level": F.when(busy, F.lit("WARNING")).otherwise(F.lit("ERROR")),
            "message": F.when(
                busy,
                F.concat(
                    F.lit(BUSY_MESSAGE[0]),
                    retry.format_wait(F.col("wait_s")),
                    F.lit(BUSY_MESSAGE[1]),
                ),
            ).otherwise(
                F.concat(
                    F.lit(RETRY_MESSAGE[0]),
                    F.col("attempt_no").cast("string"),
                    F.lit(f"/{max_attempts}{RETRY_MESSAGE[1]}"),
                    F.coalesce(F.concat(F.lit(" "), error), F.lit("")),
                )
            ),
        }
    )


def resolve_attempts(
    attempts: DataFrame,
    call_cols: Sequence[str],
    order_cols: Sequence[str],
    max_attempts: int = MAX_ATTEMPTS,
    base: float = BACKOFF_BASE,
) -> DataFrame:
    """One row per call: ``attempts, http_status, waited_s, outcome``.

    The first attempt that is not to be repeated decides. Five without one are
    a failure; fewer leave the call open. No wait follows the last attempt.
    """
    number = F.col("attempt_no")
    action = retry.classify_status(F.col("http_status"))
    decides = action != retry.RETRY
    numbered = number_attempts(
        attempts.select(*call_cols, *order_cols, "http_status"), call_cols, order_cols, max_attempts
    )
    calls = numbered.groupBy(*call_cols).agg(
        F.min(F.when(decides, number)).alias("decided_at"),
        F.min(F.when(decides, F.struct(number, "http_status"))).alias("decision"),
        F.max(number).alias("seen"),
    )
    used = F.coalesce("decided_at", "seen")
    # waits follow attempts 1 .. n-1 of n, and an unfinished call's latest one
    waits = F.when(
        F.col("decided_at").isNull() & (F.col("seen") < max_attempts), F.col("seen")
    ).otherwise(used - 1)
    return calls.select(
        *call_cols,
        used.alias("attempts"),
        F.col("decision.http_status").alias("http_status"),
        F.aggregate(
            F.slice(retry.backoff_schedule(base, max_attempts), F.lit(1), waits),
            F.lit(0.0),
            lambda total, wait: total + wait,
        ).alias("waited_s"),
        F.when(F.col("decision.http_status") == 200, F.lit(SUCCESS))
        .when(F.col("decided_at").isNotNull(), F.lit(API_FAILURE))
        .when(F.col("seen") >= max_attempts, F.lit(API_FAILURE))
        .otherwise(F.lit(OPEN))
        .alias("outcome"),
    )
