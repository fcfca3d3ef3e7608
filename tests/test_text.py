import io
import zipfile

import pytest

from docenrich.operators import assemble
from docenrich.operators.extract import (
    PAGES,
    PARAGRAPHS,
    Extractor,
    docx_paragraphs,
    explode_pages,
    extract_parts,
    extract_text,
)
from docenrich.sources.files import list_files

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
BODY = """
<w:p><w:r><w:t>Hello</w:t></w:r><w:r><w:t xml:space="preserve"> W</w:t></w:r></w:p>
<w:p/>
<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl>
<w:p><w:r><w:t>End</w:t></w:r></w:p>"""


def docx(body: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr(
            "word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>"
        )
    return out.getvalue()


def test_docx_paragraphs():
    assert list(docx_paragraphs(docx(BODY))) == ["Hello W", "", "End"]


def test_docx_marks_inside_runs():
    runs = (
        "<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t></w:r>"
        '<w:hyperlink><w:r><w:t>d</w:t><w:br w:type="page"/></w:r></w:hyperlink>'
        "<w:del><w:r><w:delText>gone</w:delText></w:r></w:del>"
        "<w:r><w:t>e</w:t><w:noBreakHyphen/><w:t>f</w:t><w:cr/></w:r></w:p>"
    )
    assert list(docx_paragraphs(docx(runs))) == ["a\tb\ncde-f\n"]


def test_docx_main_part_by_relationship():
    out = io.BytesIO()
    relation = (
        '<Relationships><Relationship Id="r1" Target="word/other.xml" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument"/>'
        "</Relationships>"
    )
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("_rels/.rels", relation)
        archive.writestr(
            "word/other.xml", f"<w:document {W}><w:body>{BODY}</w:body></w:document>"
        )
    assert list(docx_paragraphs(out.getvalue())) == ["Hello W", "", "End"]


def test_extract_from_files(spark, tmp_path):
    (tmp_path / "ok.docx").write_bytes(docx(BODY))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    (tmp_path / "a.pdf").write_bytes(b"one\n\nthree")
    extractors = {
        ".pdf": Extractor(lambda content: content.decode().split("\n"), PAGES),
        ".docx": Extractor(docx_paragraphs, PARAGRAPHS),
    }
    files = list_files(spark, str(tmp_path))
    rows = {
        r.file_path.rsplit("/", 1)[1]: r for r in extract_text(files, extractors).collect()
    }
    assert rows["ok.docx"].text == "Hello W\n\nEnd\n"
    assert rows["ok.docx"].outcome is None
    assert rows["bad.docx"].text is None
    assert rows["bad.docx"].outcome == "extraction_failure"
    assert "zip" in rows["bad.docx"].error
    assert rows["a.pdf"].text == (
        "Page 1 - Text Section:\n\none\n\n\nPage 3 - Text Section:\n\nthree\n\n"
    )
    parts = extract_parts(files, extractors).collect()
    assert sorted((r.part_no, r.text) for r in parts if r.file_path.endswith("ok.docx")) == [
        (1, "Hello W"), (2, ""), (3, "End"),
    ]
    assert [r.error for r in parts if r.file_path.endswith("bad.docx")] == [
        rows["bad.docx"].error
    ]


def test_missing_and_unsupported_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    (tmp_path / "x.pdf").write_text("x")
    paths = [(f"{tmp_path}/{n}",) for n in ("x.txt", "x.pdf", "gone.docx")]
    broken = {".pdf": Extractor(lambda content: 1 / 0, PAGES)}
    rows = extract_text(spark.createDataFrame(paths, "file_path string"), broken).collect()
    errors = {r.file_path.rsplit("/", 1)[1]: r.error for r in rows}
    assert errors["x.txt"] == "Unsupported file format"
    assert "gone.docx" in errors["gone.docx"]
    assert {r.outcome for r in rows} == {"extraction_failure"}


def test_half_characters_do_not_fail_the_job(spark):
    broken = {".pdf": Extractor(lambda content: ["a\ud800b", "é"], PARAGRAPHS)}
    files = spark.createDataFrame([("/a.pdf", bytearray(b"x"))], "file_path string, content binary")
    assert extract_text(files, broken).first().text == "a?b\né\n"


def test_file_without_parts_has_empty_text(spark):
    nothing = {".pdf": Extractor(lambda content: [], PAGES)}
    files = spark.createDataFrame([("/a.pdf", bytearray(b"x"))], "file_path string, content binary")
    row = extract_text(files, nothing).first()
    assert (row.text, row.outcome) == ("", None)
    assert extract_parts(files, nothing).count() == 0


def pages_by_hand(pages):
    sections = [f"Page {n} - Text Section:\n\n{t}\n\n" for n, t in sorted(pages) if t]
    return "\n".join(sections)


@pytest.fixture(scope="module")
def long_pages(spark):
    """One document holds nearly all rows and spans several blocks."""
    rows = [("hot", n, f"t{n}" if n % 7 else None) for n in range(1, 4321)]
    rows += [("short", n, t) for n, t in ((2, "b"), (1, "a"), (3, ""), (10, " "))]
    rows += [("blank", 1, ""), ("blank", 2, None)]
    rows += [("late", n, f"u{n}") for n in (1001, 2500, 1000)]
    rows += [("only_late", 1500, "v")]
    df = spark.createDataFrame(rows, "file_path string, page_no int, text string")
    return rows, df.repartition(7)


def test_join_pages_matches_brute_force(long_pages):
    rows, df = long_pages
    joined = {r.file_path: r.text for r in assemble.join_pages(df).collect()}
    for path in {r[0] for r in rows}:
        assert joined[path] == pages_by_hand([(n, t) for p, n, t in rows if p == path])
    assert joined["blank"] == ""


def test_join_paragraphs_matches_brute_force(long_pages):
    rows, df = long_pages
    joined = {
        r.file_path: r.text for r in assemble.join_paragraphs(df, no_col="page_no").collect()
    }
    for path in {r[0] for r in rows}:
        mine = sorted((n, t) for p, n, t in rows if p == path)
        assert joined[path] == "".join(f"{t or ''}\n" for _, t in mine)


def test_explode_pages_takes_any_separator(spark):
    df = spark.createDataFrame([("a|b|", 1)], "text string, id int")
    rows = explode_pages(df, separator="|").orderBy("page_no").collect()
    assert [(r.id, r.page_no, r.text) for r in rows] == [(1, 1, "a"), (1, 2, "b"), (1, 3, "")]


def test_join_of_joined_pages_shuffles_no_further(long_pages):
    from conftest import plan_of

    plan = plan_of(assemble.join_pages(long_pages[1].select("*")))
    # by block, then by file; the input is read once
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Scan ExistingRDD") == 1
