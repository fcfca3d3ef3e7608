"""What the library needs from the session it is handed."""

import os
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from docenrich import storage

#: What ``scratch_path`` gives: a label and 32 digits.
_SCRATCH = re.compile("[A-Za-z_-]+-[0-9a-f]{32}")
_PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only on a local master (tests, a laptop) may the session name none: a folder
    is then made for it, and set on the session so that later calls agree.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docenrich-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    # with its scheme, so that Spark and the Python workers mean the same place
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(named)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, before: float) -> int:
    """Delete what this library has left in the shared folder and not touched since
    ``before`` (seconds since 1970); returns how many folders.

    For when no result that reads them is in use any more: results are read from these.
    """
    root, dropped = shared_dir(spark), 0
    for name, changed in modified_entries(spark, root):
        if _SCRATCH.fullmatch(name) and max([changed, *_changes(spark, f"{root}/{name}")]) < before:
            delete_folder(spark, f"{root}/{name}")
            dropped += 1
    return dropped


def _changes(spark: SparkSession, folder: str) -> list[float]:
    return [changed for _, changed in modified_entries(spark, folder)]


def written_once(
    df: DataFrame, label: str = "settled", partition_by: str | None = None
) -> DataFrame:
    """Evaluate into the shared folder: later uses read, and nothing runs again."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def _path_of(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop has them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create_once(spark: SparkSession, path: str, data: bytes) -> bool:
    """Create a small file from the driver, whole; False if it is there already.

    Of callers that try at once, one gets True. A plain path is linked into place;
    other stores must create a file only if it is absent, as HDFS does.
    """
    local = storage.local_path(path)
    if local is not None:
        with storage.new_file(f"{path}.{uuid.uuid4().hex}.part") as partial:
            partial.write(data)
        try:
            os.link(partial.name, local)
        except FileExistsError:
            return False
        finally:
            os.remove(partial.name)
        return True
    filesystem, where = _path_of(spark, path)
    if filesystem.exists(where):
        return False
    try:
        out = filesystem.create(where, False)
    except Py4JJavaError as problem:
        if "AlreadyExists" not in str(problem.java_exception.getClass().getName()):
            raise
        return False
    out.write(bytearray(data))
    out.close()
    return True


def modified_entries(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names in a folder and when they changed, in seconds since 1970; for folders with few entries."""
    filesystem, where = _path_of(spark, folder)
    if not filesystem.exists(where):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in filesystem.listStatus(where)]


def read_small(spark: SparkSession, path: str) -> bytes:
    """A small file, read by the driver."""
    local = storage.local_path(path)
    if local is not None:
        with open(local, "rb") as handle:
            return handle.read()
    filesystem, where = _path_of(spark, path)
    stream = filesystem.open(where)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def delete_folder(spark: SparkSession, folder: str) -> None:
    filesystem, where = _path_of(spark, folder)
    filesystem.delete(where, True)


def ship_package(spark: SparkSession, *package_dirs: str) -> None:
    """Send this package (and others) to the Python workers, once per session."""
    for package_dir in (_PACKAGE_DIR, *package_dirs):
        name = os.path.basename(package_dir)
        sc = spark.sparkContext
        if any(os.path.basename(f) == f"{name}.zip" for f in sc.listFiles):
            continue
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="ship-"), name),
            "zip",
            root_dir=os.path.dirname(package_dir),
            base_dir=name,
        )
        sc.addPyFile(archive)
