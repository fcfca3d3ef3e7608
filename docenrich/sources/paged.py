"""One huge flat folder of a store that lists in pages, listed by many tasks.

Object stores hand out the names of a folder in order, a page at a time, from any
name on. The range of names is cut where the names differ: a few pages are looked
at, and a range that has more than one page is cut by the next character. Each task
then walks through its range and holds one page of it.
"""

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docenrich.cluster import ship_package
from docenrich.storage import path_text

#: ``(after, limit)`` to the next names in the order of their code points.
Pages = Callable[[str, int], list[str]]

PAGE_NAMES = 1000
#: Ranges for each task that is asked for, so that uneven ones even out.
_RANGES_PER_TASK = 4
#: No name with the same beginning is greater.
_LAST = "\U0010ffff"


@dataclass(frozen=True)
class NameRange(InputPartition):
    """Names greater than ``after``, up to ``upto`` (none: to the end); all in it that
    are greater than ``prefix`` begin with it."""

    after: str
    upto: str | None
    prefix: str = ""


def name_ranges(pages: Pages, wanted: int, page_names: int = PAGE_NAMES) -> list[NameRange]:
    """Ranges that cover all names, about ``wanted`` of them if the names allow it."""
    open_ranges, done = deque([NameRange("", None)]), []
    while open_ranges and len(open_ranges) + len(done) < wanted:
        one = open_ranges.popleft()
        names = [n for n in pages(one.after, page_names) if _within(n, one)]
        if len(names) < page_names:
            done.append(one)
            continue
        cut = _cut(pages, one)
        if len(cut) == 1 and cut[0].prefix == one.prefix:
            done.append(one)
        else:
            open_ranges += cut
    return sorted([*done, *open_ranges], key=lambda r: r.after)


def _within(name: str, one: NameRange) -> bool:
    return one.upto is None or name <= one.upto


def _cut(pages: Pages, one: NameRange) -> list[NameRange]:
    """A range cut by the character that follows what all its names begin with."""
    beginnings, at = [], max(one.after, one.prefix)
    while True:
        found = [n for n in pages(at, 1) if _within(n, one)]
        # what lies outside of the prefix goes with the last piece
        if not found or not found[0].startswith(one.prefix):
            break
        beginnings.append(found[0][: len(one.prefix) + 1])
        at = beginnings[-1] + _LAST
    if not beginnings:
        return [one]
    ends = [b + _LAST for b in beginnings[:-1]]
    return [NameRange(a, z, b) for a, z, b in zip([one.after, *ends], [*ends, one.upto], beginnings)]


def list_paged(
    spark: SparkSession,
    folder: str,
    pages: Pages,
    tasks: int | None = None,
    page_names: int = PAGE_NAMES,
) -> DataFrame:
    """``file_path`` of every name in a flat folder, by about ``tasks`` tasks or more.

    ``pages`` is called on the driver to cut the names into ranges, and by the tasks
    to list them; it is shipped to the executors, so it makes its own connection.
    """
    ship_package(spark)
    tasks = tasks or spark.sparkContext.defaultParallelism
    base = folder.rstrip("/") + "/"

    class PagedReader(DataSourceReader):
        def partitions(self) -> list[NameRange]:
            return name_ranges(pages, tasks * _RANGES_PER_TASK, page_names)

        def read(self, partition: NameRange) -> Iterator[pa.RecordBatch]:
            for names in pages_of(pages, partition, page_names):
                paths = [path_text(base + name) for name in names]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["file_path"])

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_folder"

        def schema(self) -> str:
            return "file_path string"

        def reader(self, schema) -> DataSourceReader:
            return PagedReader()

    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_folder").load()


def pages_of(pages: Pages, one: NameRange, page_names: int) -> Iterator[list[str]]:
    """The names of a range, a page at a time."""
    after = one.after
    while True:
        names = pages(after, page_names)
        inside = [n for n in names if _within(n, one)]
        if inside:
            yield inside
        if len(inside) < page_names:
            return
        after = inside[-1]
