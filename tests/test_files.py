import os

import pytest

from docenrich.operators.filters import filter_supported
from docenrich.sources import files

TREE = ["us/a.pdf", "us/b.docx", "us/C.PDF", "fr/n.txt", "fr/x y.pdf", "fr/sub/d.pdf",
        "us/é%20.pdf", "top.pdf"]
HIDDEN = ["fr/_h.pdf", "fr/.h.pdf", "_hid/z.pdf"]


def make(root, names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    return str(root)


def listed(df, root):
    return sorted(os.path.relpath(r.file_path, root) for r in df.collect())


def test_recursive_listing(spark, tmp_path):
    root = make(tmp_path, TREE + HIDDEN)
    expected = sorted(set(TREE) - {"us/C.PDF", "fr/n.txt"})
    assert listed(files.list_files(spark, root), root) == expected


def test_hidden_files_on_request(spark, tmp_path):
    root = make(tmp_path, TREE + HIDDEN)
    walked = sorted(
        os.path.relpath(os.path.join(folder, name), root)
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith((".pdf", ".docx"))
    )
    assert listed(files.list_files(spark, root, include_hidden=True), root) == walked
    assert set(HIDDEN) < set(walked)


def test_flat_listing_ignores_subfolders(spark, tmp_path):
    root = make(tmp_path, ["a.pdf", "k=1/b.pdf", "n.txt"])
    assert listed(files.list_files(spark, root, False), root) == ["a.pdf"]


@pytest.mark.parametrize("recursive", [True, False])
def test_nothing_to_list(spark, tmp_path, recursive):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "missing"):
        found = files.list_files(
            spark, str(tmp_path / folder), recursive=recursive
        )
        assert found.columns == ["file_path"]
        assert found.count() == 0


def test_empty_files_are_files(spark, tmp_path):
    (tmp_path / "empty.pdf").touch()
    assert listed(files.list_files(spark, str(tmp_path)), tmp_path) == ["empty.pdf"]


def test_links_to_folders_are_not_followed(spark, tmp_path):
    root = make(tmp_path, ["a/x.pdf"])
    os.symlink(tmp_path / "a", tmp_path / "loop")
    os.symlink(tmp_path / "a" / "x.pdf", tmp_path / "link.pdf")
    assert listed(files.list_files(spark, root), root) == ["a/x.pdf", "link.pdf"]


def test_rounds_pass_on_what_one_task_does_not_finish(spark, tmp_path, monkeypatch):
    names = [f"d{i}/e{j}/f{k}.pdf" for i in range(6) for j in range(4) for k in range(3)]
    root = make(tmp_path, names)
    monkeypatch.setattr(files, "_FIRST_ROUND_ENTRIES", 2)
    monkeypatch.setattr(files, "_ROUND_ENTRIES", 3)
    assert listed(files.list_files(spark, root), root) == sorted(names)


def test_uri_roots(spark, tmp_path):
    root = make(tmp_path, ["a/x.pdf"])
    assert listed(files.list_files(spark, "file://" + root), root) == ["a/x.pdf"]


def test_bytes_of_a_folder_and_of_listed_paths(spark, tmp_path):
    root = make(tmp_path, TREE)
    by_walk = {r.file_path: bytes(r.content) for r in files.read_bytes(spark, root).collect()}
    assert by_walk[f"{root}/fr/x y.pdf"] == b"fr/x y.pdf"
    gone = files.paths_df(spark, [f"{root}/gone.pdf"])
    assert files.read_bytes(spark, gone).first().content is None


def test_paths_df(spark):
    few = files.paths_df(spark, ["/a.pdf", "/b.txt"])
    assert [(f.name, f.nullable) for f in few.schema] == [("file_path", False)]
    assert [r.file_path for r in filter_supported(few).collect()] == ["/a.pdf"]
    assert files.paths_df(spark, []).count() == 0
    table = spark.createDataFrame([("/a.pdf",), (None,)], "path string")
    assert [r.file_path for r in files.paths_df(spark, table).collect()] == ["/a.pdf"]


def test_remote_schemes_take_names_literally():
    from docenrich import storage

    root = "mock://store/a"
    for name in ("x y%20.pdf", "sub/é.docx"):
        storage._remote(root)[0].create_dir(f"a/{name}".rpartition("/")[0])
        storage.replace_file(f"{root}/{name}", name.encode())
        assert storage.read_file(f"{root}/{name}") == name.encode()
    assert sorted(storage.list_folder(root)) == [
        (f"{root}/sub", True), (f"{root}/x y%20.pdf", False),
    ]
    assert list(storage.list_folder(f"{root}/sub")) == [(f"{root}/sub/é.docx", False)]
    assert list(storage.list_folder(f"{root}/none")) == []


@pytest.mark.parametrize("budget", [1, None])
def test_names_that_are_no_text_are_kept_apart_and_opened(spark, tmp_path, monkeypatch, budget):
    if budget:
        monkeypatch.setattr(files, "_FIRST_ROUND_ENTRIES", budget)
        monkeypatch.setattr(files, "_ROUND_ENTRIES", budget)
    names = [b"\xff.pdf", b"\xfe.pdf", b"a.pdf", b"\xff_dir/sub/b.pdf", b"\xff_dir/\xc3.docx"]
    for name in names:
        path = os.path.join(os.fsencode(tmp_path), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as handle:
            handle.write(name)
    found = files.read_bytes(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.content) for r in found) == sorted(names)
    assert len({r.file_path for r in found}) == len(names)


def test_a_folder_that_cannot_be_read_is_an_error(monkeypatch):
    from docenrich import storage

    def refuse(path):
        raise PermissionError(path)

    monkeypatch.setattr(storage.os, "scandir", refuse)
    with pytest.raises(PermissionError):
        list(storage.list_folder("/a"))
