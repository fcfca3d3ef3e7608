"""What the operators of this subpackage share: scratch tables and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.cluster import scratch_path, ship_package
from docenrich.storage import released as released

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """A folder below the shared one, for the tables one run of an operator writes.

    A written table cuts the lineage: an executor lost later repeats only what
    reads the table. The shuffle files of a finished write are let go.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark = spark
        self.root = scratch_path(spark, label)

    def let_go(self, write: Callable[[], None]) -> None:
        """Write something, and let go of the shuffle files it took."""
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            write()
        finally:
            self.spark.conf.set(_CLEANUP, before)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        self.let_go(lambda: df.write.parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that no result reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def clean_text(column: Column | str) -> Column:
    """A text, or the empty one for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (``u``, ``v``: longs).

    ``component`` is the smallest node reachable. Alternates the large-star and
    the small-star step until no edge changes; each step is a few equi-joins of
    pre-aggregated minima, so no component is ever held in one place. Empty
    edges give an empty table; loops and repeated edges do no harm.
    """
    current = work.save(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    state = _fingerprint(current)
    while state[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = work.save(large, "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        small = work.save(small, "small")
        work.drop(current, large)
        current, last = small, state
        state = _fingerprint(current)
        if state == last:
            break
    star = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them that changes when one does."""
    return tuple(
        edges.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % (1 << 40)).cast("decimal(38,0)"))).first()
    )
