"""Whole runs over real folders: written once, asked once, resumable."""

import json
import os
import uuid

import pytest
from conftest import plan_of
from pyspark.sql import Row
from pyspark.sql import functions as F

from checks import inputs
from docenrich.operators import ledger as ledgers
from docenrich.operators.enrich import CallRules
from docenrich.operators.extract import PAGES, PARAGRAPHS, Extractor
from docenrich.operators import partitions
from docenrich.operators.partitions import repartitioned, spread_files, spread_scan
from docenrich.operators.shape import failure_log
from docenrich.plans import runs
from docenrich.sinks.keyed_json import write_keyed_json
from docenrich.sinks.tables import append_ledger, preview, read_csv, write_csv
from docenrich.sources.ledger import read_corrupt, read_ledger, read_ledger_table
from docenrich.streaming import ingest
from docenrich.streaming.ingest import ingest_new, settle_new

EXTRACTORS = {
    ".pdf": Extractor(lambda content: [content.decode()], PAGES),
    ".docx": Extractor(lambda content: [content.decode()], PARAGRAPHS),
}


def no_sleep(seconds):
    pass


RULES = CallRules(sleep=no_sleep)


class Model:
    """Refuses texts with ``bad`` in them while ``broken`` exists; marks each call."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, payload):
        text = next(iter(payload.values()))
        open(f"{self.folder}/call-{uuid.uuid4().hex}", "w").close()
        if "bad" in text and os.path.exists(f"{self.folder}/broken"):
            return 500, "refused"
        return 200, json.dumps({"type": "memo", "jurisdiction": text.strip()[-2:]})


@pytest.fixture
def job(tmp_path):
    root = tmp_path / "root"
    for name in ("us/a.pdf", "us/b.docx", "fr/bad.pdf", "fr/_h.pdf", "x.txt"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"{name.split('.')[0]} US")
    (tmp_path / "calls").mkdir()
    (tmp_path / "calls" / "broken").touch()
    return tmp_path


def calls(job):
    return len(list((job / "calls").glob("call-*")))


def factory(job):
    folder = str(job / "calls")
    return lambda: Model(folder)


def status_run(spark, job, **options):
    rows = runs.run_status(
        spark, str(job / "root"), str(job / "ledger"), factory(job), EXTRACTORS, RULES,
        num_partitions=3, **options,
    ).collect()
    return {os.path.relpath(r.filepath, job / "root"): r.status for r in rows}


@pytest.mark.parametrize("waves", [1, 3])
def test_second_run_asks_only_about_what_failed(spark, job, waves):
    first = status_run(spark, job, waves=waves)
    assert first == {"us/a.pdf": "success", "us/b.docx": "success", "fr/_h.pdf": "success",
                     "fr/bad.pdf": "error"}
    assert calls(job) == 4
    assert status_run(spark, job, waves=waves) == {"fr/bad.pdf": "error"}
    assert calls(job) == 5
    os.remove(job / "calls" / "broken")
    assert status_run(spark, job, waves=waves) == {"fr/bad.pdf": "success"}
    assert status_run(spark, job, waves=waves) == {}
    assert calls(job) == 6
    table = read_ledger_table(spark, str(job / "ledger"))
    assert table.count() == 6
    assert {r.run_seq for r in table.collect()} == {1, 2, 3}
    log = failure_log(table.where("run_seq = 1"), path_col="filepath").collect()
    assert [(r.level, r.message) for r in log] == [
        ("WARNING", f"API call failed for file: {job}/root/fr/bad.pdf: status 500: refused")
    ]


def test_ledger_lookup_reads_only_what_it_needs(spark, job):
    status_run(spark, job)
    done = ledgers.currently_processed(read_ledger_table(spark, str(job / "ledger")))
    assert "ReadSchema: struct<filepath:string,status:string,run_seq:bigint>" in plan_of(done)


def test_result_files_count_as_processed_too(spark, job):
    folder = str(job / "json")
    status_run(spark, job, json_dir=folder, waves=2)
    entries = {r.filepath: r for r in read_ledger(spark, folder).collect()}
    assert len(entries) == 4
    assert entries[f"{job}/root/fr/bad.pdf"].status == "api_failure"
    assert entries[f"{job}/root/us/a.pdf"].jurisdiction == "US"
    before = calls(job)
    again = runs.run_status(
        spark, str(job / "root"), str(job / "new_ledger"), factory(job), EXTRACTORS, RULES,
        num_partitions=2, json_dir=folder,
    )
    assert [r.status for r in again.collect()] == ["error"]
    assert calls(job) == before + 1


def test_documents_in_a_table(spark, job):
    files = spark.createDataFrame(
        [("/t/a.pdf", bytearray(b"one US")), ("/t/n.txt", bytearray(b"two"))],
        "file_path string, content binary",
    )
    rows = runs.run_status(
        spark, files, str(job / "ledger"), factory(job), EXTRACTORS, RULES
    ).collect()
    assert [(r.filepath, r.status) for r in rows] == [("/t/a.pdf", "success")]


def test_flags_and_minimal_runs_write_csv_and_ask_once(spark, job):
    settled = runs.run_flags(
        spark, str(job / "root"), str(job / "flags"), factory(job), EXTRACTORS, RULES, 2
    )
    assert calls(job) == 4
    schema = runs.shape_flags(settled).schema
    rows = {
        os.path.basename(r.filepath): r
        for r in read_csv(spark, str(job / "flags"), schema).collect()
    }
    assert set(rows) == {"a.pdf", "b.docx", "bad.pdf", "_h.pdf"}
    assert (rows["bad.pdf"].extraction_failure, rows["bad.pdf"].api_failure) == ("no", "yes")
    assert rows["bad.pdf"].type == "Unknown Type"
    assert [r.message for r in failure_log(settled).collect()] == [
        f"API call failed for file: {job}/root/fr/bad.pdf: status 500: refused"
    ]
    assert calls(job) == 4

    settled = runs.run_minimal(
        spark, str(job / "root"), str(job / "minimal"), factory(job), EXTRACTORS, RULES, 2
    )
    back = read_csv(spark, str(job / "minimal"), runs.shape_minimal(settled).schema)
    assert back.columns == ["filepath", "type", "Jurisdiction"]
    assert back.count() == 3


def test_raw_run_lists_one_folder(spark, job):
    rows = runs.run_raw(
        spark, str(job / "root" / "us"), factory(job), EXTRACTORS,
        runs.RAW_RULES._replace(sleep=no_sleep), 2,
    ).collect()
    assert {os.path.basename(r.file_path) for r in rows} == {"a.pdf", "b.docx"}
    assert json.loads(rows[0].body)["type"] == "memo"


def test_an_empty_folder_gives_empty_results(spark, job):
    (job / "nothing").mkdir()
    settled = runs.run_flags(
        spark, str(job / "nothing"), str(job / "csv"), factory(job), EXTRACTORS, RULES, 2
    )
    assert settled.count() == 0
    assert calls(job) == 0


def test_ledger_folder_with_bad_files(spark, tmp_path):
    folder = tmp_path / "ledger"
    assert read_ledger(spark, str(folder)).count() == 0
    assert read_corrupt(spark, str(folder)).count() == 0
    folder.mkdir()
    good = {"filepath": "/a.pdf", "type": None, "jurisdiction": "é", "status": "success"}
    contents = {
        "a.json": json.dumps(good),
        "b.json": json.dumps(good | {"filepath": "/b.pdf", "status": "api_failure"}, indent=2),
        "cut.json": json.dumps(good)[:25],
        "keyless.json": '{"status": "success"}',
        "list.json": json.dumps([good]),
        "junk.json": json.dumps(good) + " junk",
        "half.json": json.dumps(good) + json.dumps(good)[:30],
        "quotes.json": json.dumps(good).replace('"', "'"),
        "empty.json": "",
        "note.txt": json.dumps(good),
    }
    for name, content in contents.items():
        (folder / name).write_text(content)
    entries = read_ledger(spark, str(folder))
    assert sorted((r.filepath, r.type, r.jurisdiction, r.status) for r in entries.collect()) == [
        ("/a.pdf", None, "é", "success"), ("/b.pdf", None, "é", "api_failure"),
    ]
    assert [r.filepath for r in ledgers.processed_paths(entries).collect()] == ["/a.pdf"]
    corrupt = {os.path.basename(r.file) for r in read_corrupt(spark, str(folder)).collect()}
    # an empty file is no JSON either
    assert corrupt == {
        "cut.json", "empty.json", "keyless.json", "list.json", "junk.json", "half.json",
        "quotes.json",
    }


def test_keyed_files_are_replaced_in_place(spark, tmp_path):
    schema = "filepath string, type string, jurisdiction string, status string"
    folder = str(tmp_path / "out")
    for status, workers in (("error", None), ("success", 4)):
        rows = spark.createDataFrame(
            [("/a.pdf", None, "x\n", status), ("/b/a.pdf", "t", "é", status)], schema
        )
        write_keyed_json(rows, folder, workers)
    assert len(os.listdir(folder)) == 2
    back = sorted(tuple(r) for r in read_ledger(spark, folder).collect())
    assert back == [("/a.pdf", None, "x\n", "success"), ("/b/a.pdf", "t", "é", "success")]


LEDGER = "filepath string, status string, run_seq long"


def test_latest_entry_decides_and_nulls_match_nothing(spark):
    ledger = spark.createDataFrame(
        [("/a.pdf", "success", 1), ("/a.pdf", "error", 2), ("/b.pdf", "error", 1),
         ("/b.pdf", "success", 3), (None, "success", 1), ("/c.pdf", "success", 2),
         ("/c.pdf", "error", 2)],
        LEDGER,
    )
    latest = {r.filepath: (r.status, r.run_seq) for r in ledgers.latest_by_key(ledger).collect()}
    assert latest == {"/a.pdf": ("error", 2), "/b.pdf": ("success", 3), None: ("success", 1),
                      "/c.pdf": ("success", 2)}
    done = ledgers.currently_processed(ledger)
    assert {r.filepath for r in done.collect()} == {"/b.pdf", "/c.pdf"}
    files = spark.createDataFrame(
        [("/a.pdf",), ("/b.pdf",), ("/d.pdf",), ("/d.pdf",)], "file_path string"
    )
    left = sorted(r.file_path for r in ledgers.to_do(files, ledger).collect())
    assert left == ["/a.pdf", "/d.pdf"]
    by_key = ledgers.skip_processed(files, ledgers.processed_keys(done), key="md5")
    assert sorted(r.file_path for r in by_key.collect()) == ["/a.pdf", "/d.pdf", "/d.pdf"]


def test_csv_keeps_awkward_cells(spark, tmp_path):
    rows = spark.createDataFrame(
        [("/a,b.pdf", 'say "x"', "two\nlines"), ("/c.pdf", None, "plain")],
        "filepath string, type string, Jurisdiction string",
    )
    write_csv(rows, str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_preview_cuts_like_show(spark):
    rows = spark.createDataFrame([(f"/{i:03}.pdf", "x" * i) for i in range(40)],
                                 "filepath string, type string")
    shown = preview(rows).collect()
    assert [r.filepath for r in shown] == [f"/{i:03}.pdf" for i in range(20)]
    wide = preview(rows, n=30).collect()
    assert wide[20].type == "x" * 20
    assert wide[21].type == "x" * 17 + "..."
    assert "TakeOrderedAndProject" in plan_of(preview(rows))


def test_stream_takes_each_file_once(spark, job):
    args = (spark, str(job / "root"), str(job / "table"))
    (job / "root" / "empty.pdf").touch()
    assert ingest_new(*args).count() == 5
    assert ingest_new(*args).count() == 5
    (job / "root" / "us" / "new.pdf").write_text("new US")
    table = ingest_new(*args)
    assert table.count() == 6
    assert {os.path.basename(r.file_path): r.length for r in table.collect()}["empty.pdf"] == 0
    assert table.columns == ["file_path", "modified", "length"]


def test_stream_settles_into_the_ledger(spark, job):
    ledger_dir, state = str(job / "ledger"), str(job / "checkpoint")

    def go():
        settle_new(
            spark, str(job / "root"), state, ledger_dir, factory(job), EXTRACTORS, RULES,
            files_per_batch=2, num_partitions=2,
        )
        return read_ledger_table(spark, ledger_dir)

    assert go().count() == 4
    assert go().count() == 4
    assert calls(job) == 4
    (job / "root" / "us" / "new.pdf").write_text("new US")
    table = go()
    assert calls(job) == 5
    assert table.count() == 5
    # the stream does not look back at what failed; a batch run does
    assert status_run(spark, job) == {"fr/bad.pdf": "error"}


def factory_of_nothing():
    return None


def test_only_a_narrow_scan_is_spread(spark):
    assert spread_scan(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 4
    wide = spark.range(0, 100, 1, 16)
    assert spread_scan(wide) is wide
    assert repartitioned(wide.select(F.col("id"))).rdd.getNumPartitions() == 200


def test_tasks_follow_the_number_of_files(spark, monkeypatch):
    monkeypatch.setattr(partitions, "FILES_PER_TASK", 10)

    def tasks(n, given=None):
        spread = spread_files(spark.range(n).selectExpr("string(id) file_path"), given)
        assert spread.count() == n
        return spread.rdd.getNumPartitions()

    assert (tasks(0), tasks(3), tasks(300), tasks(5000)) == (1, 3, 200, 500)
    assert tasks(300, 7) == 7


def test_a_run_that_breaks_off_repeats_no_committed_wave(spark, job, monkeypatch):
    os.remove(job / "calls" / "broken")
    waves_done = []

    def breaks_after_two(df, folder, run_seq):
        if len(waves_done) == 2:
            raise RuntimeError("driver lost")
        append_ledger(df, folder, run_seq)
        waves_done.append(run_seq)

    monkeypatch.setattr(runs, "append_ledger", breaks_after_two)
    with pytest.raises(RuntimeError):
        status_run(spark, job, waves=4)
    committed = {r.filepath for r in read_ledger_table(spark, str(job / "ledger")).collect()}
    assert calls(job) == len(committed)
    monkeypatch.setattr(runs, "append_ledger", append_ledger)
    rest = status_run(spark, job, waves=4)
    assert len(rest) == 4 - len(committed)
    assert calls(job) == 4


def test_a_repeated_batch_asks_nobody_again(spark, job, monkeypatch):
    from pyspark.errors import StreamingQueryException

    os.remove(job / "calls" / "broken")
    args = (spark, str(job / "root"), str(job / "checkpoint"), str(job / "ledger"), factory(job),
            EXTRACTORS, RULES)

    def breaks_after_writing(df, folder, run_seq):
        append_ledger(df, folder, run_seq)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(ingest, "append_ledger", breaks_after_writing)
    with pytest.raises(StreamingQueryException):
        settle_new(*args, num_partitions=2)
    assert calls(job) == 4
    monkeypatch.setattr(ingest, "append_ledger", append_ledger)
    settle_new(*args, num_partitions=2)
    assert calls(job) == 4
    assert read_ledger_table(spark, str(job / "ledger")).count() == 4


def test_result_files_are_made_up(spark, job):
    folder = str(job / "json")
    status_run(spark, job)
    status_run(spark, job, json_dir=folder)
    assert read_ledger(spark, folder).count() == 4
    assert calls(job) == 5
    lost = next(r.file for r in read_corrupt_or_all(spark, folder) if "bad" not in r.value)
    os.remove(lost)
    os.remove(job / "calls" / "broken")
    status_run(spark, job, json_dir=folder)
    assert {r.status for r in read_ledger(spark, folder).collect()} == {"success"}
    assert calls(job) == 6


def read_corrupt_or_all(spark, folder):
    return [
        Row(file=os.path.join(folder, name), value=open(os.path.join(folder, name)).read())
        for name in os.listdir(folder)
    ]


def test_a_file_listed_twice_is_asked_about_once(spark, job):
    files = spark.createDataFrame(
        [("/t/a.pdf", bytearray(b"one US"))] * 3, "file_path string, content binary"
    )
    none = spark.createDataFrame([], LEDGER)
    rows = runs.status_rows(files, none, factory(job), EXTRACTORS, RULES).collect()
    assert [r.filepath for r in rows] == ["/t/a.pdf"]
    assert runs.run_status(
        spark, files, str(job / "ledger"), factory(job), EXTRACTORS, RULES
    ).count() == 1
    assert calls(job) == 2


def test_a_suffix_without_an_extractor_stops_the_plan(spark):
    files = spark.createDataFrame([("/a.pdf",)], "file_path string")
    with pytest.raises(ValueError, match="pdf"):
        runs.settled_rows(files, factory_of_nothing)


def test_no_shuffle_carries_documents(spark, sf_dir):
    from checks.queries import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(QUERIES["status_run"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan
    moved = [x for x in plan.splitlines() if "Exchange" in x or "Sort [" in x]
    assert moved and not [x for x in moved if "content" in x or "text" in x]
    above = plan[: plan.index("LeftAnti")]
    assert "Exchange" not in above and "ReadSchema: struct<doc_id:bigint,text" not in plan
