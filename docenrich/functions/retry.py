"""Retry rules as expressions, for logs of attempts already made."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docenrich.constants import BACKOFF_BASE, MAX_ATTEMPTS

DONE = "done"
RETRY = "retry"
FAIL = "fail"


def classify_status(http_status: Column) -> Column:
    """200 is done; 429 or no status at all is retried; anything else fails."""
    return (
        F.when(http_status.isNull() | (http_status == 429), F.lit(RETRY))
        .when(http_status == 200, F.lit(DONE))
        .otherwise(F.lit(FAIL))
    )


def backoff_schedule(base: float = BACKOFF_BASE, attempts: int = MAX_ATTEMPTS) -> Column:
    """Seconds to wait after attempt 1, 2, …: ``base ** k``."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(attempts)), lambda k: F.power(F.lit(float(base)), k)
    )


def wait_after(attempt_no: Column, base: float = BACKOFF_BASE) -> Column:
    """Seconds to wait after one failed attempt."""
    return F.power(F.lit(float(base)), attempt_no)


def format_wait(seconds: Column) -> Column:
    """One decimal, ties to the even digit (2.25 is ``2.2``)."""
    return F.format_string("%.1f", F.bround(seconds, 1))
