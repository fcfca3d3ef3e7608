import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docenrich.llm import spelling
from docenrich.llm.common import Workspace


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    forms, rows = {}, {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o.encode()), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        rows[w] = (n, len(others))
    result = []
    for w, form in forms.items():
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, form, root, *rows[w], counts[form] if form else None))
    return sorted(result, key=repr)


def words_of(spark, counts, parts=3):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return df.withColumn("path", F.lit(1)).withColumn("rank", F.lit("x")).repartition(parts)


def check(spark, counts, **options):
    found = spelling.group_variants(words_of(spark, counts), **options)
    mine = sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()), key=repr)
    assert mine == brute(counts, options.get("ratio", 5))
    pairs = {(r.word, r.near, r.near_n) for r in spelling.near_words(words_of(spark, counts)).collect()}
    assert pairs == {(a, b, counts[b]) for a in counts for b in counts if near(a, b)}


def test_against_all_pairs(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    words = set(base)
    for w in base:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + "ÿ" + w[i:], w[:i] + "z" + w[i + 1 :], w[:i] + w[i] + w[i:]}
    words.discard("")
    check(spark, {w: rng.choice([1, 5, 6, 30, 30, 200, 6000]) for w in words})


def test_runs_of_one_letter_and_chains(spark):
    counts = {"a" * k: 5**k for k in range(1, 12)} | {"b" * 5000: 3, "b" * 4999: 30, "b" * 4999 + "c": 30}
    check(spark, counts)
    check(spark, {"ab": 4, "ac": 4, "ad": 20, "ae": 20}, ratio=5)
    check(spark, {"abcdef": 9})


def test_empty_and_hot_groups(spark):
    assert spelling.group_variants(words_of(spark, {"x": 1}).where("n > 1")).collect() == []
    alphabet = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    counts = {f"word{c}tail": k + 5 for k, c in enumerate(alphabet)} | {"wordtail": 1000}
    check(spark, counts)
    groups = spelling.pair_groups(words_of(spark, counts), Workspace(spark, "test"))
    assert max(len(r.members) for r in groups.collect()) == len(alphabet) + 1


def test_trie_nodes_are_prefixes_over_all_partitions(spark):
    rng = random.Random(3)
    keys = sorted({"".join(rng.choice("ab😀") for _ in range(rng.randrange(0, 7))) for _ in range(300)})
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts in (1, 5, 40):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            number, prefix = {}, {}
            for row in spelling.trie_paths(df, Workspace(spark, "test"), "t").collect():
                assert len(row.nodes) == len(row.key) + 1
                for depth, node in enumerate(row.nodes):
                    assert number.setdefault(row.key[:depth], node) == node
                    assert prefix.setdefault(node, row.key[:depth]) == row.key[:depth]
            assert number[""] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("limits", [(250_000, 4 << 20), (50, 10)])
def test_frequent_words(spark, monkeypatch, limits):
    monkeypatch.setattr(spelling, "_HELD", limits[0])
    monkeypatch.setattr(spelling, "_LONG_TEXT", limits[1])
    rng = random.Random(9)
    vocabulary = ["Straße", "ÀÉÎõü×÷", "tension", "abcdef", "Tension", "x", "TENSIÓN", "naïveté"]
    rows = [(i, rng.choice([" ", "-", "1", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(None, "tension " * 3), (None, None), (7, ""), (7, "?!"), (301, "long " + "Wörterbuch, " * 20_000)]
    wanted = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 5 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            wanted[run] += 1
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, word int")
    found = {r.word: r.n for r in spelling.frequent_words(df, slip_one_in=5).collect()}
    assert found == {w: n for w, n in wanted.items() if len(w) >= 6 and n >= 5} and "tnsion" not in vocabulary
    assert spelling.frequent_words(df.limit(0)).collect() == []
