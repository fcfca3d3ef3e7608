"""A compacted ledger answers as the whole one, without shuffling what it holds."""

import json
import os
import random
import threading
import uuid

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from docenrich.constants import LEDGER_TABLE_SCHEMA
from docenrich.operators import prefilter
from docenrich.operators.enrich import CallRules
from docenrich.operators.extract import PAGES, Extractor
from docenrich.operators.ledger import latest_by_key, to_do
from docenrich.plans import runs
from docenrich.sinks import compaction
from docenrich.sinks.compaction import compact_ledger, latest_entries, open_compacted, to_do_compacted
from docenrich.sources.ledger import read_ledger_table


def write_rows(spark, ledger, rows, seq, claimed=True):
    rows = [(p, None, "é", s, s, None, q, f"r{seq}") for p, s, q in rows]
    df = spark.createDataFrame(rows, LEDGER_TABLE_SCHEMA)
    if claimed:
        df.write.parquet(f"{ledger}/run-{seq:09d}-x/{uuid.uuid4().hex}")
    else:
        df.write.mode("append").parquet(ledger)


def listing(spark, n=60):
    return spark.createDataFrame([(f"/d/{i}.pdf",) for i in range(n)], "file_path string")


def paths(df):
    return sorted(r.file_path for r in df.collect())


def same_answers(spark, ledger, files):
    whole = read_ledger_table(spark, ledger)
    compacted = open_compacted(spark, ledger)
    wanted = paths(to_do(files, whole))
    for unique in (False, True):
        assert paths(to_do_compacted(files, compacted, unique)) == wanted
    assert paths(to_do_compacted(files.union(files), compacted)) == wanted
    told = lambda df: sorted(map(str, df.collect()))
    assert told(latest_entries(spark, ledger)) == told(latest_by_key(whole))
    return wanted


def test_lookups_agree_whatever_the_history(spark, tmp_path):
    ledger, rng = str(tmp_path / "l"), random.Random(3)
    files = listing(spark)
    assert open_compacted(spark, ledger) is None
    seq = 0
    for step in range(4):
        for _ in range(2):
            seq += 1
            rows = [(f"/d/{rng.randrange(50)}.pdf", rng.choice(["success", "error", "api_failure"]), seq) for _ in range(25)]
            # an entry without a path, two entries of one run, and one that arrives late
            rows += [(None, "success", seq), ("/d/1.pdf", "success", seq), ("/d/1.pdf", "error", seq)]
            rows += [("/d/2.pdf", rng.choice(["success", "error"]), max(1, seq - 3))]
            write_rows(spark, ledger, rows, seq, claimed=step > 0)
        if step != 2:
            assert compact_ledger(spark, ledger, buckets=3 if step else None)
        same_answers(spark, ledger, files)
    assert open_compacted(spark, ledger).buckets == 3


def test_an_empty_ledger_and_one_without_successes(spark, tmp_path):
    ledger = str(tmp_path / "l")
    write_rows(spark, ledger, [], 1)
    assert compact_ledger(spark, ledger)
    assert len(same_answers(spark, ledger, listing(spark, 5))) == 5
    write_rows(spark, ledger, [("/d/1.pdf", "error", 2)], 2)
    assert compact_ledger(spark, ledger)
    assert open_compacted(spark, ledger).blocks is None
    assert len(same_answers(spark, ledger, listing(spark, 5))) == 5
    assert same_answers(spark, ledger, listing(spark, 0)) == []


def test_parts_that_are_being_written_are_left_to_the_tail(spark, tmp_path):
    ledger = str(tmp_path / "l")
    write_rows(spark, ledger, [("/d/1.pdf", "success", 1)], 1)
    write_rows(spark, ledger, [("/d/2.pdf", "success", 2)], 2)
    open_part = next((tmp_path / "l" / "run-000000002-x").iterdir())
    os.remove(open_part / "_SUCCESS")
    assert compact_ledger(spark, ledger)
    assert [r.filepath for r in open_compacted(spark, ledger).entries.collect()] == ["/d/1.pdf"]
    (open_part / "_SUCCESS").touch()
    assert [r.filepath for r in open_compacted(spark, ledger).tail.collect()] == ["/d/2.pdf"]
    same_answers(spark, ledger, listing(spark, 4))


def test_of_two_compactions_at_once_one_counts(spark, tmp_path):
    ledger = str(tmp_path / "l")
    write_rows(spark, ledger, [(f"/d/{i}.pdf", "success", 1) for i in range(30)], 1)
    made = []
    threads = [threading.Thread(target=lambda: made.append(compact_ledger(spark, ledger, buckets=2))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert True in made
    assert len(same_answers(spark, ledger, listing(spark))) == 30
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("docenrich_")]


def above(plan, line):
    """The operators above a line of a plan, nearest first."""
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    found, at = [], depth(lines[line])
    for x in reversed(lines[:line]):
        if depth(x) < at:
            found.append(x.strip(" :+-"))
            at = depth(x)
    return found


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_compacted_side_is_not_shuffled(spark, tmp_path, no_broadcast):
    ledger = str(tmp_path / "l")
    write_rows(spark, ledger, [(f"/d/{i}.pdf", "success", 1) for i in range(30)], 1)
    compact_ledger(spark, ledger, buckets=7)
    write_rows(spark, ledger, [("/d/3.pdf", "error", 2)], 2)
    plan = plan_of(to_do_compacted(listing(spark), open_compacted(spark, ledger)))
    scans = [i for i, x in enumerate(plan.splitlines()) if "FileScan" in x and "Bucketed: true" in x]
    assert len(scans) == 1 and "ReadSchema: struct<filepath:string,last:bigint>" in plan.splitlines()[scans[0]]
    ancestors = above(plan, scans[0])
    assert any("SortMergeJoin" in x for x in ancestors)
    assert not [x for x in ancestors if x.startswith("Exchange")]


def rows_shuffled(df):
    """Rows written by the shuffles of a plan that has run."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        while node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_new_paths_go_past_the_lookup(spark, tmp_path):
    ledger = str(tmp_path / "l")
    write_rows(spark, ledger, [(f"/old/{i}.pdf", "success", 1) for i in range(2000)], 1)
    compact_ledger(spark, ledger, buckets=4)
    write_rows(spark, ledger, [(f"/tail/{i}.pdf", "success", 2) for i in range(20)], 2)
    names = [f"/new/{i}.pdf" for i in range(5000)] + [f"/old/{i}.pdf" for i in range(50)] + [f"/tail/{i}.pdf" for i in range(20)]
    files = spark.createDataFrame([(n,) for n in names], "file_path string")
    compacted = open_compacted(spark, ledger)
    with_filter, without = (to_do_compacted(files, compacted, unique) for unique in (True, False))
    assert paths(with_filter) == paths(without) == sorted(names[:5000])
    assert rows_shuffled(without) >= 5070
    # blocks of the filter are shuffled too, but of 5,000 new paths few are
    assert rows_shuffled(with_filter) - compacted.blocks.count() < 1000


def test_the_filter_knows_its_size(spark):
    assert [prefilter.block_count(n, 1024) for n in (0, 1, 8 * 1024, 8 * 1024 + 1)] == [0, 1, 1024, 0]
    numbers = spark.range(4000).select(F.concat(F.lit("/é/"), "id").alias("file_path"))
    blocks = prefilter.path_blocks(numbers, 1024)
    assert blocks.count() <= 1024
    other = spark.range(20_000).select(F.concat(F.lit("/z/"), "id").alias("file_path"))

    def known(df):
        key, bits = prefilter.path_key(F.col("file_path"), 1024)
        found = df.withColumn("block", key).join(blocks, "block", "left")
        return found.where(F.col("bits").bitwiseAND(bits) == bits).count()

    assert known(numbers) == 4000
    assert known(other) < 2000


class Model:
    def __init__(self, folder):
        self.folder = folder

    def __call__(self, payload):
        open(f"{self.folder}/{uuid.uuid4().hex}", "w").close()
        return 200, json.dumps({"type": "memo", "jurisdiction": "US"})


def test_a_run_looks_up_a_compacted_ledger(spark, tmp_path):
    for name in ("root", "calls"):
        (tmp_path / name).mkdir()
    extractors = {".pdf": Extractor(lambda content: [content.decode()], PAGES)}
    folder, ledger = str(tmp_path / "calls"), str(tmp_path / "ledger")

    def run(n):
        for i in range(n):
            (tmp_path / "root" / f"{i}.pdf").write_text(f"doc{i}")
        rows = runs.run_status(spark, str(tmp_path / "root"), ledger, lambda: Model(folder), extractors,
                               CallRules(), num_partitions=2).collect()
        return sorted(os.path.basename(r.filepath) for r in rows)

    assert len(run(4)) == 4
    assert compaction.compact_ledger(spark, ledger)
    assert run(6) == ["4.pdf", "5.pdf"]
    assert run(7) == ["6.pdf"]
    assert len(os.listdir(folder)) == 7
    assert latest_entries(spark, ledger).count() == 7
