"""Joins in which a few keys have a large part of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are looked for at most.
HOT_KEYS = 64
#: Keys the sketch tracks: a count is off by a few ten-thousandths of all rows.
_TRACKED = 10_000
#: A hot key's rows are dealt to so many times as many shares as fit a task evenly.
_SPREAD = 4
_MOST_SHARES = 1024


def hot_keys(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """``(key, shares)`` of the keys that have more rows than an even task, ``HOT_KEYS`` at most.

    The counts come from a sketch that tasks build and merge. ``shares`` is the
    number of parts to cut the key's rows into.
    """
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {_TRACKED})").alias("top"), F.count("*").alias("rows"))
    share = F.ceil(F.col("count") * (_SPREAD * tasks) / F.col("rows"))
    return (
        top.select("rows", F.inline("top"))
        .select(F.col("item").alias(key), F.least(share, F.lit(_MOST_SHARES)).cast("int").alias("shares"))
        .where(F.col("shares") > _SPREAD)
    )


def salted_left_join(left: DataFrame, right: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """``left`` joined to the one row of ``right`` that has its key, if there is one.

    Rows of ``left`` with a hot key are dealt to shares, and the row of ``right`` is
    repeated for each of them, so the largest task has little more than its part.
    ``tasks`` is the number of shuffle partitions unless given. Null keys match nothing.
    """
    if tasks is None:
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, key, tasks))  # a few rows, whatever the tables hold
    dealt = left.join(hot, key, "left").withColumn(
        "_share", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("shares")), F.lit(0)).cast("int")
    )
    last = F.coalesce(F.col("shares") - 1, F.lit(0))
    copies = right.join(hot, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), last)))
    joined = dealt.drop("shares").join(copies.drop("shares"), [key, "_share"], "left")
    return joined.drop("_share")
