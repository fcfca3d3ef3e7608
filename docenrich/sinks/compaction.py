"""A ledger that grows: what has been settled, one row for each path, bucketed by path.

``compact_ledger`` reduces the parts of a ledger to the latest entry of each path
and writes them in buckets, beside a manifest that names the parts it covers. The
parts stay. A lookup then reads the buckets as they lie, without a shuffle, and
the few parts written since (the tail); what it shuffles grows with the listing
and the tail, not with the ledger.

A filter over the paths that have gone through goes with the compaction: paths
that are surely new need no lookup at all.
"""

import json
import math
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich.cluster import create_once, delete_folder, modified_entries, read_small
from docenrich.constants import LEDGER_TABLE_SCHEMA
from docenrich.operators.ledger import latest_by_key, verdict
from docenrich.operators.prefilter import MAX_BLOCKS, add_blocks, block_count, path_blocks, path_key
from docenrich.sources.ledger import read_ledger_table

FOLDER = "_compact"
ROWS_PER_BUCKET = 1_000_000
FEWEST_BUCKETS = 8
#: Number and verdict of the last run that has the path, in one long.
LAST = "last"
_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER_TABLE_SCHEMA) + f", {LAST} long"


class CompactedLedger(NamedTuple):
    """A ledger as a lookup sees it."""

    entries: DataFrame  # the compaction, with ``last``; bucketed by ``filepath``
    tail: DataFrame  # the ledger's rows that are not in it
    buckets: int
    blocks: DataFrame | None  # filter over paths that may have gone through
    n_blocks: int


def ledger_parts(spark: SparkSession, ledger_dir: str) -> list[str]:
    """The committed parts below a ledger's folder: files beside it, and writes of claimed runs."""
    parts = []
    for name, _ in modified_entries(spark, ledger_dir):
        if name.startswith("run-"):
            for write, _ in modified_entries(spark, f"{ledger_dir}/{name}"):
                if any(n == "_SUCCESS" for n, _ in modified_entries(spark, f"{ledger_dir}/{name}/{write}")):
                    parts.append(f"{name}/{write}")
        elif name.endswith(".parquet"):
            parts.append(name)
    return sorted(parts)


def _latest_version(spark: SparkSession, ledger_dir: str) -> int:
    names = [name for name, _ in modified_entries(spark, f"{ledger_dir}/{FOLDER}")]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)


def _read_parts(spark: SparkSession, ledger_dir: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], LEDGER_TABLE_SCHEMA)
    reader = spark.read.schema(LEDGER_TABLE_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(*[f"{ledger_dir}/{part}" for part in parts])


def _bucketed(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """The buckets of a folder. Spark knows of buckets by the catalog only, so the
    folder is named there for the moment it takes to look it up."""
    name = f"docenrich_{uuid.uuid4().hex}"
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({_SCHEMA}) USING parquet "
        f"CLUSTERED BY (filepath) SORTED BY (filepath) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def open_compacted(spark: SparkSession, ledger_dir: str) -> CompactedLedger | None:
    """The latest compaction of a ledger and the rows written since; None if there is none."""
    ledger_dir = ledger_dir.rstrip("/")
    version = _latest_version(spark, ledger_dir)
    if version == 0:
        return None
    told = json.loads(read_small(spark, f"{ledger_dir}/{FOLDER}/{version:09d}.json"))
    data = f"{ledger_dir}/{FOLDER}/{told['data']}"
    covered = set(told["parts"])
    tail = [part for part in ledger_parts(spark, ledger_dir) if part not in covered]
    blocks = None
    if told["blocks"]:
        blocks = spark.read.schema("block long, bits long").parquet(f"{data}-blocks")
    entries = _bucketed(spark, data, told["buckets"])
    return CompactedLedger(entries, _read_parts(spark, ledger_dir, tail), told["buckets"], blocks, told["blocks"])


def compact_ledger(
    spark: SparkSession, ledger_dir: str, buckets: int | None = None, max_blocks: int = MAX_BLOCKS
) -> bool:
    """Cover all parts of a ledger that are committed now; False if another was quicker.

    Runs may go on meanwhile: what they write later is in the tail. The buckets
    follow the number of paths, ``ROWS_PER_BUCKET`` at most on average.
    """
    ledger_dir = ledger_dir.rstrip("/")
    version = _latest_version(spark, ledger_dir)
    parts = ledger_parts(spark, ledger_dir)
    before = open_compacted(spark, ledger_dir)
    if before is None:
        rows = _read_parts(spark, ledger_dir, parts).withColumn(LAST, verdict())
    else:
        # its tail may hold parts that were committed a moment later
        covered = set(json.loads(read_small(spark, f"{ledger_dir}/{FOLDER}/{version:09d}.json"))["parts"])
        fresh = _read_parts(spark, ledger_dir, [p for p in parts if p not in covered])
        rows = before.entries.unionByName(fresh.withColumn(LAST, verdict()))
    others = [c for c in LEDGER_TABLE_SCHEMA.names if c not in ("filepath", "run_seq")]
    latest = (
        rows.groupBy("filepath")
        .agg(F.max(F.struct("run_seq", *others)).alias("entry"), F.max(LAST).alias(LAST))
        .select(*(F.col(c) if c == "filepath" else F.col(f"entry.{c}") for c in LEDGER_TABLE_SCHEMA.names), LAST)
    )
    if buckets is None:
        buckets = FEWEST_BUCKETS << max(0, math.ceil(math.log2(max(rows.count(), 1) / ROWS_PER_BUCKET / FEWEST_BUCKETS)))
    name, data = f"docenrich_{uuid.uuid4().hex}", uuid.uuid4().hex
    folder = f"{ledger_dir}/{FOLDER}/{data}"
    writer = latest.repartition(buckets, "filepath").write.bucketBy(buckets, "filepath").sortBy("filepath")
    writer.option("path", folder).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    done = spark.read.schema(_SCHEMA).parquet(folder).where(f"{LAST} % 2 = 1 AND filepath IS NOT NULL")
    n_blocks = block_count(done.count(), max_blocks)
    if n_blocks:
        path_blocks(done, n_blocks, "filepath").write.parquet(f"{folder}-blocks")
    manifest = {"data": data, "parts": parts, "buckets": buckets, "blocks": n_blocks}
    if create_once(spark, f"{ledger_dir}/{FOLDER}/{version + 1:09d}.json", json.dumps(manifest).encode()):
        return True
    delete_folder(spark, folder)
    delete_folder(spark, f"{folder}-blocks")
    return False


def latest_entries(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The latest entry of each path, of the compaction and what came since."""
    ledger = open_compacted(spark, ledger_dir)
    if ledger is None:
        return latest_by_key(read_ledger_table(spark, ledger_dir))
    return latest_by_key(ledger.entries.drop(LAST).unionByName(ledger.tail))


def to_do_compacted(files: DataFrame, ledger: CompactedLedger, unique: bool = False) -> DataFrame:
    """Distinct listed paths that no run has finished, as ``to_do`` finds them.

    ``unique`` says that no path is listed twice. Paths that are surely new then go
    past the lookup; the others are dealt to the buckets of the compaction.
    """
    listed = files.select("file_path")
    if ledger.blocks is None or not unique:
        return _looked_up(listed, ledger)
    tail_done = ledger.tail.where("status = 'success' AND filepath IS NOT NULL")
    blocks = add_blocks(ledger.blocks, path_blocks(tail_done, ledger.n_blocks, "filepath"))
    key, bits = path_key(F.col("file_path"), ledger.n_blocks)
    probed = listed.withColumn("block", key).join(F.broadcast(blocks), "block", "left")
    known = F.coalesce(F.col("bits").bitwiseAND(bits) == bits, F.lit(False))
    probed = probed.select("file_path", known.alias("known"))
    return probed.where("NOT known").select("file_path").union(
        _looked_up(probed.where("known").select("file_path"), ledger)
    )


def _looked_up(listed: DataFrame, ledger: CompactedLedger) -> DataFrame:
    dealt = listed.repartition(ledger.buckets, "file_path").distinct()
    last = F.max(verdict()).alias("tail_last")
    tail = ledger.tail.where("filepath IS NOT NULL").groupBy("filepath").agg(last)
    tail = tail.repartition(ledger.buckets, "filepath").withColumnRenamed("filepath", "tail_path")
    known = ledger.entries.select("filepath", LAST)
    return (
        dealt.join(known, dealt["file_path"] == known["filepath"], "left")
        .join(tail, F.col("file_path") == F.col("tail_path"), "left")
        .where(F.coalesce(F.greatest(LAST, "tail_last"), F.lit(0)) % 2 == 0)
        .select("file_path")
    )
