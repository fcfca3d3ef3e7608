"""DataFrames derived from the given tables, whole tables and whole texts."""

import bisect
import functools
import io
import math
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docenrich import storage
from docenrich.cluster import scratch_path
from docenrich.constants import DOCX_SUFFIX, PDF_SUFFIX
from docenrich.operators.enrich import enrich_from_replies
from docenrich.operators.extract import PAGES, PARAGRAPHS, Extractor, docx_paragraphs
from docenrich.operators.filters import guard_unsupported
from docenrich.operators.partitions import spread_scan
from docenrich.sources.files import walk_files
from docenrich.sources.paged import Pages


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, file_path, text, lang, n_chars``: a path for each document, with
    suffixes of every kind and file names that repeat between folders."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = (F.col("doc_id") % 40).cast("string")
    folder = F.floor(F.col("doc_id") / 40).cast("string")
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in (".pdf", ".docx", ".pdf", ".docx", ".PDF", ".txt")]),
        (F.col("doc_id") % 6 + 1).cast("int"),
    )
    path = F.concat(
        F.lit("/corpus/"), "lang", F.lit("/"), "source", F.lit("/"), folder,
        F.lit("/contract_"), number, suffix,
    )
    return d.select("doc_id", path.alias("file_path"), "text", "lang", "n_chars")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, body``: stored replies of every kind."""
    kind = (
        F.when(F.col("n_chars") < 1000, "memo")
        .when(F.col("n_chars") < 2500, "letter")
        .otherwise("contract")
    )
    full = F.concat(
        F.lit('{"type":"'), kind, F.lit('","jurisdiction":"'), F.upper("lang"), F.lit('"}')
    )
    rule = F.col("doc_id") % 11
    body = (
        F.when(rule == 0, "{}")
        .when(rule == 1, '{"type": null, "jurisdiction": "XX"}')
        .when(rule == 2, F.lit(None).cast("string"))
        .when(rule == 3, "null")
        .when(rule == 4, "[1]")
        .otherwise(full)
    )
    return doc_files(spark, sf_dir).select("file_path", body.alias("body"))


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, outcome, body`` of every document, from stored replies."""
    files = guard_unsupported(
        doc_files(spark, sf_dir).select("file_path", "n_chars"), text_col="n_chars"
    ).drop("n_chars")
    return enrich_from_replies(files, replies(spark, sf_dir)).withColumn(
        "error", F.lit(None).cast("string")
    )


def ledger_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two earlier runs, ``filepath, status, run_seq``.

    The first handled the documents that have a label, and lost the path of the
    text files; the second handled those of low quality once more.
    """
    paths = doc_files(spark, sf_dir).select("doc_id", "file_path")
    labelled = paths.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    first = labelled.select(
        F.when(~F.col("file_path").endswith(".txt"), F.col("file_path")).alias("filepath"),
        F.when(toxic & good, "api_failure").when(toxic, "error").otherwise("success")
        .alias("status"),
        F.lit(1).cast("long").alias("run_seq"),
    )
    second = labelled.where(~good).select(
        F.col("file_path").alias("filepath"),
        F.when(toxic, "success").otherwise("error").alias("status"),
        F.lit(2).cast("long").alias("run_seq"),
    )
    return first, second


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = ledger_runs(spark, sf_dir)
    return first.unionByName(second)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of requests: one call per user and day, no status where none came."""
    kind = F.col("event_type")
    status = (
        F.when(kind.isin("click", "view"), 429)
        .when(kind == "error", F.lit(None).cast("int"))
        .when(kind == "purchase", 200)
        .otherwise(500)
    )
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("call_key"),
        F.col("ts").cast("date").alias("call_day"),
        "ts",
        "event_id",
        status.alias("http_status"),
    )


CALL = ["call_key", "call_day"]
CALL_ORDER = ["ts", "event_id"]


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, page_no, text``: a row per line, some blank, some NULL."""
    lines = doc_files(spark, sf_dir).select(
        "doc_id", "file_path", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    at = F.col("doc_id") + F.col("pos")
    return lines.select(
        "file_path",
        (F.col("pos") + 1).alias("page_no"),
        F.when(at % 9 == 0, "")
        .when(at % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("line"))
        .alias("text"),
    )


def docx_bytes(text: str) -> bytes:
    """A DOCX with one paragraph per line and a table, which is not body text."""
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"

    def paragraph(line: str) -> str:
        half = len(line) // 2
        runs = "".join(
            f'<w:r><w:t xml:space="preserve">{escape(piece)}</w:t></w:r>'
            for piece in (line[:half], line[half:])
            if piece
        )
        return f"<w:p>{runs}</w:p>"

    body = "".join(paragraph(line) for line in text.split("\n"))
    table = f"<w:tbl><w:tr><w:tc>{paragraph('cell')}</w:tc></w:tr></w:tbl>"
    xml = f'<w:document xmlns:w="{w}"><w:body>{body}{table}</w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("word/document.xml", xml)
    return out.getvalue()


def line_pages(content: bytes):
    """Stands in for a PDF library: each line of the bytes is a page."""
    return content.decode().split("\n")


# There is no PDF library to write or read real ones with.
EXTRACTORS = {
    PDF_SUFFIX: Extractor(line_pages, PAGES),
    DOCX_SUFFIX: Extractor(docx_paragraphs, PARAGRAPHS),
}
# For files that hold bare texts, whatever their suffix.
LINE_EXTRACTORS = {
    PDF_SUFFIX: Extractor(line_pages, PAGES),
    DOCX_SUFFIX: Extractor(line_pages, PAGES),
}


def _to_bytes(batches):
    schema = pa.schema([("file_path", pa.string()), ("content", pa.binary())])

    def rows():
        for batch in batches:
            for path, text in zip(
                batch.column("file_path").to_pylist(), batch.column("text").to_pylist()
            ):
                content = docx_bytes(text) if path.endswith(DOCX_SUFFIX) else text.encode()
                yield {"file_path": path, "content": content}, len(content)

    return storage.arrow_batches(rows(), schema)


def doc_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, content``: the documents as files, DOCX files as real ones."""
    texts = spread_scan(doc_files(spark, sf_dir).select("file_path", "text"))
    return texts.mapInArrow(storage.released(_to_bytes), "file_path string, content binary")


def write_tree(files: DataFrame, root: str) -> None:
    """Write each row's ``content`` to its path below ``root``, on the executors."""

    def write(batches):
        for batch in batches:
            written = 0
            # one content at a time beside the batch
            for path, content in zip(batch.column("file_path").to_pylist(), batch.column("content")):
                storage.replace_file(root + path, content.as_py())
                written += 1
            yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int32())})

    files.select("file_path", "content").mapInArrow(storage.released(write), "written int").agg(
        F.sum("written")
    ).collect()


_trees: dict[tuple, str] = {}


def file_tree(spark: SparkSession, sf_dir: str, flat: bool = False) -> str:
    """Root of the documents' texts as files, written once per session.

    Flat, they all lie in one folder, under the md5 of their path.
    """
    key = (spark.sparkContext.applicationId, sf_dir, flat)
    if key not in _trees:
        path = F.concat(F.lit("/"), flat_name(F.col("file_path"))) if flat else F.col("file_path")
        files = spread_scan(doc_files(spark, sf_dir)).select(
            path.alias("file_path"), F.encode("text", "UTF-8").alias("content")
        )
        root = scratch_path(spark, "tree")
        write_tree(files, root)
        _trees[key] = root
    return _trees[key]


# Names in one file of the index below.
INDEX_NAMES = 10_000


def indexed_pages(spark: SparkSession, folder: str) -> Pages:
    """Stands in for a store that lists in pages: as there, an index keeps the names
    of the folder in order, so a page costs the same however many there are.

    The index is made once, of the names in the folder, in files of few names each.
    """
    names = walk_files(spark, folder, recursive=False, include_hidden=True).select(
        F.substring_index("file_path", "/", -1).alias("value")
    )
    files = max(1, math.ceil(names.count() / INDEX_NAMES))
    index = scratch_path(spark, "index")
    names.repartitionByRange(files, "value").sortWithinPartitions("value").write.text(index)
    # numbered in the order of their names; the first of each tells where to look
    parts = sorted(p for p, _ in storage.list_folder(index) if p.rsplit("/", 1)[1].startswith("part-"))
    firsts = [(_index_names(part) or [""])[0] for part in parts]

    def pages(after, limit):
        found, at = [], max(bisect.bisect_right(firsts, after) - 1, 0)
        while at < len(parts) and len(found) < limit:
            part = _index_names(parts[at])
            first = bisect.bisect_right(part, after)
            found += part[first : first + limit - len(found)]
            at += 1
        return found

    return pages


@functools.lru_cache(maxsize=2)
def _index_names(part: str) -> list[str]:
    return storage.read_file(part).decode().split("\n")[:-1]


def byte_tree(spark: SparkSession, sf_dir: str) -> str:
    """Root of the documents as files, DOCX files as real ones; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "bytes")
    if key not in _trees:
        root = scratch_path(spark, "tree")
        write_tree(doc_bytes(spark, sf_dir), root)
        _trees[key] = root
    return _trees[key]


def flat_name(path):
    return F.concat(F.md5(path), F.lit("."), F.substring_index(path, ".", -1))


def below(root: str, path):
    """The part of a path below a root, given either as a path or as a URI."""
    return F.substr(path, F.lit(len(storage.local_path(root) or root) + 1))
