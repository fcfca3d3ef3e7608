"""What is bounded whatever the input: bytes ahead, hot keys, pages, files opened."""

import bisect
import json
import os
import tracemalloc

import pytest
from pyspark.sql import functions as F

from checks import inputs, queries
from docenrich import storage
from docenrich.operators import enrich as enrich_module
from docenrich.operators.enrich import enrich_from_replies
from docenrich.operators.extract import extract_text
from docenrich.operators.skew import hot_keys, salted_left_join
from docenrich.plans import runs
from docenrich.sinks import keyed_json
from docenrich.sinks.keyed_json import read_logged_json, write_keyed_json, write_logged_json
from docenrich.sources.files import read_bytes
from docenrich.sources.ledger import read_ledger
from docenrich.sources.paged import NameRange, list_paged, name_ranges, pages_of

MB = 1 << 20


# --- files read ahead ---------------------------------------------------------


def test_large_files_are_not_read_ahead_of_the_budget(tmp_path):
    paths = []
    for i in range(10):
        paths.append(str(tmp_path / f"{i}.pdf"))
        with open(paths[-1], "wb") as handle:
            handle.truncate(20 * MB)
    tracemalloc.start()
    try:
        total = sum(len(coming.result()) for _, coming in storage.read_ahead(paths, budget=30 * MB))
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert total == 200 * MB
    # the budget, and the file the caller is working on
    assert peak < 30 * MB + 25 * MB


def test_files_come_in_order_whatever_their_lengths(tmp_path):
    lengths = [0, 5, 100, 7, 3, 90, 1, 1, 1, 60, 2] * 4
    paths = []
    for i, n in enumerate(lengths):
        paths.append(str(tmp_path / f"{i}.pdf"))
        with open(paths[-1], "wb") as handle:
            handle.write(b"x" * n)
    paths.insert(5, str(tmp_path / "missing.pdf"))
    for budget in (1, 64, 10**9):
        seen = []
        for path, coming in storage.read_ahead(iter(paths), budget):
            try:
                seen.append((path, len(coming.result())))
            except FileNotFoundError:
                seen.append((path, None))
        assert [p for p, _ in seen] == paths
        assert [n for _, n in seen] == lengths[:5] + [None] + lengths[5:]
    assert list(storage.read_ahead([])) == []


def test_tasks_on_documents_give_their_memory_back(spark, monkeypatch):
    wrapped = []

    def released(task, real=storage.released):
        wrapped.append(task)
        return real(task)

    monkeypatch.setattr(storage, "released", released)
    monkeypatch.setattr(enrich_module, "released", released)
    paths = spark.createDataFrame([("/none.pdf",)], "file_path string")
    read_bytes(spark, paths)
    assert len(wrapped) == 1
    runs.settled_rows(paths, None, inputs.LINE_EXTRACTORS)
    assert len(wrapped) == 3
    assert extract_text(paths, inputs.LINE_EXTRACTORS).first().outcome == "extraction_failure"


# --- hot keys -----------------------------------------------------------------


@pytest.fixture
def plain_shuffles(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": 8}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_rows_of_a_hot_path_are_spread(spark, plain_shuffles):
    path = F.when(F.col("id") % 3 == 0, "/hot.pdf").otherwise(F.concat(F.lit("/p/"), "id"))
    files = spark.range(30_000).select("id", path.alias("file_path"))
    replies = files.select("file_path", F.concat(F.lit('{"type":"'), F.col("id") % 7, F.lit('"}')).alias("body"))
    replies = replies.where("file_path <> '/p/1'")
    hot = {r.file_path: r.shares for r in hot_keys(files, "file_path", 8).collect()}
    assert hot == {"/hot.pdf": 11}

    def largest(df):
        # with a value of the other side, or there would be no join to do
        parts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("body"))
        sizes = sorted(r.n for r in parts.collect())
        return sizes[-1] / sizes[len(sizes) // 2]

    spread, plain = (enrich_from_replies(files, replies, spread_hot=s) for s in (True, False))
    assert largest(plain) > 3 > largest(spread)
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))


def test_salted_join_without_hot_keys_and_with_nulls(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", 4)], "k string, n int")
    right = spark.createDataFrame([("b", "x"), (None, "y"), ("c", "z")], "k string, v string")
    joined = salted_left_join(left, right, "k")
    assert joined.columns == ["k", "n", "v"]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(
        [("a", 1, None), (None, 2, None), ("b", 3, "x"), ("b", 4, "x")], key=str
    )
    assert salted_left_join(left.limit(0), right, "k").collect() == []
    hot = left.union(spark.createDataFrame([("b", n) for n in range(500)], "k string, n int"))
    assert salted_left_join(hot, right, "k", tasks=16).where("v = 'x'").count() == 502


# --- paged listings -----------------------------------------------------------


def store(names):
    names = sorted(names)

    def pages(after, limit):
        assert limit <= 1000
        first = bisect.bisect_right(names, after)
        return names[first : first + limit]

    return pages


@pytest.mark.parametrize("names", [
    [], ["a"], [f"{i:05}.pdf" for i in range(20_000)], ["x" * n for n in range(1, 3000)],
    [f"contract_é😀{i % 7}_{i}.pdf" for i in range(5000)], ["\U0010fffe", "\U0010fffe1", "z"] + [f"{c}{i}" for c in "aZ~" for i in range(900)],
])
def test_ranges_cover_every_name_once(names):
    pages = store(names)
    ranges = name_ranges(pages, 16, 100)
    assert ranges[0].after == "" and ranges[-1].upto is None
    assert all(a.upto == b.after for a, b in zip(ranges, ranges[1:]))
    found = [n for r in ranges for page in pages_of(pages, r, 100) for n in page]
    assert found == sorted(names)
    if len(names) >= 5000:
        assert len(ranges) >= 16


def test_a_huge_folder_is_listed_by_many_tasks(spark):
    count = 100_000

    def pages(after, limit):
        # names of six digits; what comes next is known from the name
        start = 0 if after == "" else min((n for n in range(count) if f"{n:06d}.pdf" > after), default=count)
        assert limit <= 1000
        return [f"{n:06d}.pdf" for n in range(start, min(count, start + limit))]

    listed = list_paged(spark, "s3://bucket/huge/", pages, tasks=8)
    by_task = listed.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert listed.distinct().count() == count and sum(r.n for r in by_task) == count
    assert len(by_task) >= 8 and max(r.n for r in by_task) <= count / 8
    assert listed.agg(F.min("file_path")).first()[0] == "s3://bucket/huge/000000.pdf"


def test_a_page_of_the_stand_in_store_does_not_list_the_folder(spark, tmp_path, monkeypatch):
    names = sorted([f"{n:x}{n % 7}.pdf" for n in range(500)] + ["é.pdf", "z\U0001f600.docx", ".hidden"])
    for name in names:
        (tmp_path / name).touch()
    monkeypatch.setattr(inputs, "INDEX_NAMES", 60)
    pages = inputs.indexed_pages(spark, str(tmp_path))
    inputs._index_names.cache_clear()
    opened = []
    monkeypatch.setattr(storage, "read_file", lambda path, read=storage.read_file: opened.append(path) or read(path))
    monkeypatch.setattr(os, "listdir", None)
    monkeypatch.setattr(os, "scandir", None)
    monkeypatch.setattr(storage, "list_folder", None)
    found = [name for page in pages_of(pages, NameRange("", None), 7) for name in page]
    assert found == names
    # each file of the index once, whatever the number of pages
    assert len(opened) == len(set(opened)) > 5
    assert pages(names[-1], 3) == [] and pages(names[3], 2) == names[4:6] and pages("", 10**6) == names
    monkeypatch.undo()
    listed = list_paged(spark, str(tmp_path), pages, tasks=3, page_names=20)
    assert sorted(r.file_path for r in listed.collect()) == [f"{tmp_path}/{n}" for n in names]


def test_a_stand_in_store_of_an_empty_folder(spark, tmp_path):
    pages = inputs.indexed_pages(spark, str(tmp_path))
    assert pages("", 10) == [] and pages("a", 1) == []
    assert list_paged(spark, str(tmp_path), pages).collect() == []


# --- result files -------------------------------------------------------------


def entry_rows(spark, names, status):
    schema = "filepath string, type string, jurisdiction string, status string"
    return spark.createDataFrame([(n, None, "é", status) for n in names], schema)


def entries(df):
    return {r.filepath: r.status for r in df.collect()}


def test_the_log_knows_what_was_written(spark, tmp_path):
    folder = str(tmp_path / "json")
    assert read_logged_json(spark, folder).collect() == []
    write_logged_json(entry_rows(spark, ["/a.pdf", "/b.pdf"], "success"), folder, "run-1")
    write_keyed_json(entry_rows(spark, ["/c.pdf"], "error"), folder)
    (tmp_path / "json" / "cut.json").write_text('{"filepath": "/x')
    (tmp_path / "json" / "note.txt").write_text("{}")
    wanted = {"/a.pdf": "success", "/b.pdf": "success", "/c.pdf": "error"}
    assert entries(read_logged_json(spark, folder)) == wanted == entries(read_ledger(spark, folder))
    log = {r.name: r for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}.log").collect()}
    assert len(log) == 4 and sum(r.run_id == "run-1" for r in log.values()) == 2
    assert entries(read_logged_json(spark, folder)) == wanted


def test_only_changed_files_are_opened(spark, tmp_path):
    folder = tmp_path / "json"
    write_logged_json(entry_rows(spark, [f"/{i}.pdf" for i in range(6)], "success"), str(folder))
    read_logged_json(spark, str(folder)).collect()
    files = sorted(folder.glob("*.json"))
    told = [json.loads(f.read_text())["filepath"] for f in files]

    def put(file, status, keep_time):
        stat = file.stat()
        text = file.read_text().replace("success", status)
        file.write_text(text)
        if keep_time:
            os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))

    # equal length and time: who opened it would see the other status
    put(files[0], "SUCCESS", keep_time=True)
    put(files[1], "error", keep_time=False)
    os.remove(files[2])
    found = entries(read_logged_json(spark, str(folder)))
    assert found == {told[0]: "success", told[1]: "error", **{t: "success" for t in told[3:]}}
    # the change was logged: by now nothing is opened
    put(files[1], "ERROR", keep_time=True)
    assert entries(read_logged_json(spark, str(folder)))[told[1]] == "error"


def test_a_replaced_entry_is_logged_anew(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "json")
    for status in ("error", "success", "api_failure"):
        write_logged_json(entry_rows(spark, ["/a.pdf"], status), folder)
        assert entries(read_logged_json(spark, folder)) == {"/a.pdf": status}
    monkeypatch.setattr(keyed_json, "read_texts", None)  # nothing to open
    assert entries(read_logged_json(spark, folder)) == {"/a.pdf": "api_failure"}


def test_short_rows_of_a_join_become_files_in_many_tasks(spark, sf_dir, monkeypatch):
    tasks = []
    monkeypatch.setattr(inputs, "write_tree", lambda files, root: tasks.append(files.rdd.getNumPartitions()))
    queries._mixed_ledger(spark, sf_dir)
    monkeypatch.setattr(queries, "write_keyed_json", lambda rows, folder: tasks.append(rows.rdd.getNumPartitions()))
    queries.QUERIES["keyed_json_round_trip"](spark, sf_dir)
    assert len(tasks) == 3 and min(tasks) > 16


def test_result_files_are_made_up_by_many_tasks(spark, sf_dir, monkeypatch):
    tasks = []

    def write(rows, *args, real=runs.write_logged_json):
        tasks.append(rows.rdd.getNumPartitions())
        real(rows, *args)

    monkeypatch.setattr(runs, "write_logged_json", write)
    assert queries.QUERIES["resumed_files_run"](spark, sf_dir).count() > 100
    assert len(tasks) == 2 and tasks[0] > 16
