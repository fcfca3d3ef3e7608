"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A source's repetition rate is its target share of all characters over the
characters it has. How often a document occurs is drawn from the Poisson
distribution with that mean, by inverting it at a number that the document's id
and a seed give: the same on every run and wherever the row is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text

#: Targets are in proportion to a source's characters to this power.
FLATTEN = 0.7
#: Larger means are drawn as a sum of draws, so that exp(-mean) stays exact.
_PART_MEAN = 32


def hash_number(key: Column) -> Column:
    """A number above 0 and below 1 that depends on the key alone."""
    head = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")
    return (head + 0.5) / F.lit(float(1 << 48))


def poisson(mean: Column, u: Column) -> Column:
    """The smallest n for which a Poisson variable is at most n with a probability of ``u`` or more."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("below"), F.lit(0).alias("n"))
    end = F.aggregate(
        F.sequence(F.lit(1), most),
        start,
        lambda acc, k: F.when(acc["below"] >= u, acc).otherwise(
            F.struct(
                (acc["p"] * mean / k).alias("p"),
                (acc["below"] + acc["p"] * mean / k).alias("below"),
                k.alias("n"),
            )
        ),
    )
    return end["n"]


def repetition_rates(
    docs: DataFrame, source_col: str, text_col: str, weights: dict[str | None, float] | None, flatten: float, epochs: float
) -> DataFrame:
    """``source, rate``: target characters over the characters that the source has."""
    sizes = (
        docs.select(F.col(source_col).cast("string").alias("source"), clean_text(text_col).alias("text"))
        .groupBy("source")
        .agg(F.sum(F.char_length("text")).cast("double").alias("size"))
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(flatten)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(s, float(w)) for s, w in weights.items()], "named string, weight double"
        )
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").fillna(0.0, ["weight"])
    total = weighted.agg(F.sum("size"), F.sum(F.when(F.col("size") > 0, F.col("weight")))).first()
    size, weight = total[0] or 0.0, total[1] or 0.0
    rate = F.when(F.col("size") > 0, epochs * size * F.col("weight") / weight / F.col("size")).otherwise(0.0)
    return weighted.select("source", (rate if weight else F.lit(0.0)).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    flatten: float = FLATTEN,
    epochs: float = 1.0,
    seed: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every document as often as its draw says, in a random global order.

    ``weights`` gives each source's share (others: none at all); without it,
    shares follow the characters to the power ``flatten``. The mixture has
    ``epochs`` times the characters of ``docs``, on average. The null source is
    a source; a source without characters has no rows in the result. Rows that
    repeat an id are drawn alike. All columns stay; ``copy`` (from 0) and
    ``shuffle_key`` are added, with underscores where these names are taken.
    """
    # written, so that its size is known: a few sources are sent to the documents, many are joined
    rates = Workspace(docs.sparkSession, "mixing").save(
        repetition_rates(docs, source_col, text_col, weights, flatten, epochs), "rates"
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.col(source_col).cast("string").alias("source"),
    )
    rated = rows.alias("r").join(rates.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    parts = F.greatest(F.ceil(F.col("rate") / _PART_MEAN), F.lit(1)).cast("int")
    drawn = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), parts - 1),
            lambda i: poisson(
                F.col("rate") / parts,
                hash_number(F.concat_ws(":", F.lit(str(seed)), F.col("id"), i.cast("string"))),
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    copies = (
        rated.select("doc", "id", drawn.alias("n"))
        .where("n > 0")
        .select("doc", "id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(f"order {seed}"), "id", F.col("copy").cast("string"))))
    )
    names = {"copy": "copy", "key": "shuffle_key"}
    taken = {c.lower() for c in docs.columns}
    for own in names:
        while names[own] in taken:
            names[own] += "_"
    # a random place for a random key: partitions and the order in each are a permutation of all
    mixed = copies.repartition("key").sortWithinPartitions("key", "copy")
    return mixed.select("doc.*", *[F.col(own).alias(name) for own, name in names.items()])
