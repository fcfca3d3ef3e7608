"""Document bytes to ordered parts and to text.

An extractor is a callable ``bytes -> iterable of texts`` together with the way
its parts are put together: ``PAGES`` (numbered sections, blank ones left out)
or ``PARAGRAPHS`` (one line each). A registry maps a suffix to an extractor.
"""

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import NamedTuple
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich import storage
from docenrich.cluster import ship_package
from docenrich.constants import DOCX_SUFFIX, EXTRACTION_FAILURE, PDF_SUFFIX, UNSUPPORTED
from docenrich.functions.text import pages_text, paragraphs_text

PAGES = "pages"
PARAGRAPHS = "paragraphs"


class Extractor(NamedTuple):
    read: Callable[[bytes], Iterable[str | None]]
    style: str


# Names in the word-processing XML vocabulary.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_MAIN_PART = "word/document.xml"
_RELATIONS_PART = "_rels/.rels"
_RUN_MARKS = {
    _W + "tab": "\t",
    _W + "ptab": "\t",
    _W + "cr": "\n",
    _W + "noBreakHyphen": "-",
}


def _run_text(run: ElementTree.Element) -> str:
    pieces = []
    for node in run:
        if node.tag == _W + "t":
            pieces.append(node.text or "")
        elif node.tag == _W + "br":
            # page and column breaks are layout, not text
            pieces.append("\n" if node.get(_W + "type", "textWrapping") == "textWrapping" else "")
        else:
            pieces.append(_RUN_MARKS.get(node.tag, ""))
    return "".join(pieces)


def _main_part(archive: zipfile.ZipFile) -> str:
    """Name of the part that holds the text; packages may call it anything."""
    if _RELATIONS_PART in archive.namelist():
        for relation in ElementTree.fromstring(archive.read(_RELATIONS_PART)):
            if relation.get("Type", "").endswith("/officeDocument"):
                return relation.get("Target").lstrip("/")
    return _MAIN_PART


def docx_paragraphs(content: bytes) -> Iterator[str]:
    """Body paragraphs in order; text inside tables is not part of the body."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read(_main_part(archive))).find(_W + "body")
    for paragraph in body.findall(_W + "p"):
        runs = []
        for node in paragraph:
            if node.tag == _W + "r":
                runs.append(node)
            elif node.tag == _W + "hyperlink":
                runs.extend(node.findall(_W + "r"))
        yield "".join(_run_text(run) for run in runs)


# PDF layout is a library's work: callers register the one their executors have.
DEFAULT_EXTRACTORS: dict[str, Extractor] = {
    DOCX_SUFFIX: Extractor(docx_paragraphs, PARAGRAPHS),
}

_PARTS_SCHEMA = "file_path string, style string, parts array<string>, error string"
_ARROW_SCHEMA = pa.schema(
    [
        ("file_path", pa.string()),
        ("style", pa.string()),
        ("parts", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)


def read_parts(
    files: DataFrame, extractors: Mapping[str, Extractor] | None = None
) -> DataFrame:
    """One row per file: ``file_path, style, parts, error``, the parts in order.

    ``files`` has ``file_path`` and, if the bytes are at hand, ``content``;
    otherwise each file is opened by the task that handles its path. Every
    problem with a file becomes its ``error``, never a failed task; trouble with
    the storage that may pass is no such problem, and Spark tries again.

    ``extractors`` are added to the default ones. Each supported suffix needs one.
    """
    ship_package(files.sparkSession)
    registry = DEFAULT_EXTRACTORS | dict(extractors or {})
    lacking = {PDF_SUFFIX, DOCX_SUFFIX} - set(registry)
    if lacking:
        raise ValueError(f"no extractor registered for {', '.join(sorted(lacking))}")
    columns = [c for c in ("file_path", "content") if c in files.columns]
    return files.select(*columns).mapInArrow(
        storage.released(lambda batches: _extract_batches(batches, registry)), _PARTS_SCHEMA
    )


def extract_parts(
    files: DataFrame, extractors: Mapping[str, Extractor] | None = None
) -> DataFrame:
    """One row per page or paragraph: ``file_path, part_no, text, error``.

    A file that could not be read is one row with an ``error`` only.
    """
    return explode_parts(read_parts(files, extractors))


def explode_parts(parts: DataFrame) -> DataFrame:
    """Long form of ``read_parts``, numbered from 1."""
    rows = parts.select("file_path", F.posexplode_outer("parts").alias("at", "text"), "error")
    return rows.where(F.col("at").isNotNull() | F.col("error").isNotNull()).select(
        "file_path", (F.col("at") + 1).alias("part_no"), "text", "error"
    )


def extract_text(
    files: DataFrame, extractors: Mapping[str, Extractor] | None = None
) -> DataFrame:
    """One row per file: ``file_path, text, outcome, error``.

    All parts of a file come out of one task, in order, so the text is put
    together in place: no shuffle. ``outcome`` is NULL unless extraction failed.
    """
    parts = F.col("parts")
    return read_parts(files, extractors).select(
        "file_path",
        F.when(F.col("error").isNull(),
            F.when(F.col("style") == PAGES, pages_text(parts)).otherwise(paragraphs_text(parts)),
        ).alias("text"),
        F.when(F.col("error").isNotNull(), F.lit(EXTRACTION_FAILURE)).alias("outcome"),
        "error",
    )


def explode_pages(
    df: DataFrame, text_col: str = "text", separator: str = "\n"
) -> DataFrame:
    """Split a text column into pages numbered from 1; other columns stay."""
    others = [c for c in df.columns if c != text_col]
    # split() takes a regular expression; \Q..\E makes the separator literal
    pieces = F.split(F.col(text_col), rf"\Q{separator}\E")
    return df.select(*others, F.posexplode(pieces).alias("page_index", text_col)).select(
        *others, (F.col("page_index") + 1).alias("page_no"), text_col
    )


def _extract_batches(
    batches: Iterator[pa.RecordBatch], registry: Mapping[str, Extractor]
) -> Iterator[pa.RecordBatch]:
    def extractor_of(path: str | None) -> Extractor | None:
        return next((x for suffix, x in registry.items() if (path or "").endswith(suffix)), None)

    def one(path: str | None, content: Callable[[], bytes]) -> tuple[dict, int]:
        row = {"file_path": path, "style": None, "parts": None, "error": None}
        extractor = extractor_of(path)
        if extractor is None:
            row["error"] = UNSUPPORTED
            return row, 0
        try:
            data = content()
        except storage.UNREADABLE as problem:
            row["error"] = storage.describe(problem)
            return row, 0
        try:
            texts = [storage.valid_text(text) for text in extractor.read(data)]
        except Exception as problem:  # noqa: BLE001 - one bad file must not fail the job
            row["error"] = storage.describe(problem)
            return row, 0
        row["style"] = extractor.style
        row["parts"] = texts
        return row, sum(len(t or "") for t in texts)

    def rows() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            paths = batch.column("file_path").to_pylist()
            if "content" in batch.schema.names:
                for path, content in zip(paths, batch.column("content")):
                    yield one(path, content.as_py)
            else:
                known = [path for path in paths if extractor_of(path) is not None]
                for path, coming in storage.read_ahead(known):
                    yield one(path, coming.result)
                for path in paths:
                    if extractor_of(path) is None:
                        yield one(path, bytes)

    return storage.arrow_batches(rows(), _ARROW_SCHEMA)
