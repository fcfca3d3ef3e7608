"""A worker that dies in the middle of its task costs repeated calls, nothing else."""

import json
import os
import subprocess
import sys

from conftest import ROOT

JOB = """
import json, os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from docenrich.operators.extract import PAGES, Extractor
from docenrich.plans.runs import run_status
from docenrich.sources.ledger import read_ledger, read_ledger_table

folder = {folder!r}
spark = (
    SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", folder + "/shared").getOrCreate()
)

def build():
    def answer(payload):
        if payload["text"].endswith("7\\n\\n") and not os.path.exists(folder + "/died"):
            open(folder + "/died", "w").close()
            os._exit(1)
        return 200, json.dumps({{"type": "memo", "jurisdiction": "US"}})
    return answer

extractors = {{".pdf": Extractor(lambda content: [content.decode()], PAGES)}}
run_status(spark, folder + "/root", folder + "/ledger", build, extractors,
           num_partitions=4, json_dir=folder + "/json")
table = [r.filepath for r in read_ledger_table(spark, folder + "/ledger").collect()]
files = [r.filepath for r in read_ledger(spark, folder + "/json").collect()]
print("RESULT " + json.dumps([sorted(table), sorted(files)]))
"""


def test_run_survives_a_lost_worker(tmp_path):
    (tmp_path / "root").mkdir()
    names = [str(tmp_path / "root" / f"{i}.pdf") for i in range(40)]
    for i, name in enumerate(names):
        with open(name, "w") as handle:
            handle.write(f"document {i}")
    done = subprocess.run(
        [sys.executable, "-c", JOB.format(root=ROOT, folder=str(tmp_path))],
        capture_output=True, text=True, timeout=180, env=os.environ | {"PYTHONPATH": ""},
    )
    result = [x for x in done.stdout.splitlines() if x.startswith("RESULT ")]
    assert result, done.stderr[-3000:]
    table, files = json.loads(result[0].removeprefix("RESULT "))
    assert os.path.exists(tmp_path / "died")
    assert table == sorted(names)
    assert files == sorted(names)
