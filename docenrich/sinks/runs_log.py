"""Runs of a ledger: each claims a number of its own before it writes.

A run's manifest, ``_runs/<number>.json`` beside the ledger, is created only if it
is not there. Of two runs that want a number at once, one gets it and the other
takes the next. Every row of the ledger names its run, and each write of a run has
a folder of its own, so runs that write at once neither mix nor disturb each other.
"""

import json
import time
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

from docenrich.cluster import create_once, modified_entries
from docenrich.operators.ledger import next_run
from docenrich.sources.ledger import read_ledger_table

FOLDER = "_runs"


class Run(NamedTuple):
    """A claimed run: its number orders runs, its id is in all that it writes."""

    seq: int
    id: str


def claim_run(spark: SparkSession, ledger_dir: str) -> Run:
    """The next run of a ledger, claimed for the caller alone.

    The first claim looks at the ledger's rows too, which may be older than the
    manifests; after that the names of the manifests tell.
    """
    folder = f"{ledger_dir.rstrip('/')}/{FOLDER}"
    taken = claimed_runs(spark, ledger_dir)
    seq = max(taken) + 1 if taken else next_run(read_ledger_table(spark, ledger_dir))
    run_id = uuid.uuid4().hex
    manifest = json.dumps({"run_id": run_id, "started": time.time()}).encode()
    while not create_once(spark, f"{folder}/{seq:09d}.json", manifest):
        seq += 1
    return Run(seq, run_id)


def claimed_runs(spark: SparkSession, ledger_dir: str) -> list[int]:
    """The numbers that have been claimed, one for each run there ever was."""
    names = [name for name, _ in modified_entries(spark, f"{ledger_dir.rstrip('/')}/{FOLDER}")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())
