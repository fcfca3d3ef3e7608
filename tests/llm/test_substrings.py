import hashlib
import random
import re

import numpy as np

from docenrich.llm import substrings
from docenrich.llm.common import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")
W = substrings.WINDOW


def brute(rows):
    """doc_id and text to (doc_id, n_words, n_removed, kept), by comparing all windows."""
    words = [WORD.findall(t or "") for _, t in rows]
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    least = {}
    for own, ws in zip(order, words):
        for k in range(len(ws) - W + 1):
            window = tuple(ws[k : k + W])
            least[window] = min(own, least.get(window, own))
    result = []
    for (doc_id, _), own, ws in zip(rows, order, words):
        gone = set()
        for k in range(len(ws) - W + 1):
            if least[tuple(ws[k : k + W])] < own:
                gone.update(range(k, k + W))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        result.append((doc_id, len(ws), len(gone), kept))
    return result


def check(spark, rows, parts=None, **columns):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, owner int, key string")
    if parts:
        df = df.repartition(parts)
    found = substrings.remove_repeats(df).collect()
    mine = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=repr)
    assert mine == sorted(brute(rows), key=repr)
    for r in found:
        assert r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest()
        assert sum(x.words for x in r.repeats) == r.n_removed
        # stretches are maximal: they neither touch nor overlap
        assert all(a.first + a.words < b.first for a, b in zip(r.repeats, r.repeats[1:]))
    return {r.doc_id: r for r in found}


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def test_against_all_windows(spark):
    rng = random.Random(5)
    passages = [words(rng, n) for n in (49, 50, 51, 60, 80, 200)]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            cut = rng.randrange(0, 15)
            parts += [passage[cut:] if rng.random() < 0.3 else passage, words(rng, rng.randrange(30))]
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)))
    # near copies: a word changed here and there
    for k in range(12):
        copy = rows[0][1].split() + passages[5]
        for _ in range(k % 4):
            copy[rng.randrange(len(copy))] = f"edit{k}"
        rows.append((1000 + k, " ".join(copy)))
    check(spark, rows)
    check(spark, rows, parts=7)


def test_odd_texts_and_ids(spark):
    rng = random.Random(1)
    long = words(rng, 120)
    text = " ".join(long)
    rows = [
        (5, text), (5, text), (9, text), (None, text), (None, text), (7, None), (8, ""), (10, " \n\t "),
        (3, "a " * 300), (4, "a " * 120), (11, " ".join(long[:49])), (12, text.upper()), (13, " ".join(long[70:])),
        (14, " ".join(long)), (15, "ä😀 " * 60), (16, "ä😀 " * 50), (-4, "ä😀 " * 49),
    ]
    found = check(spark, rows)
    assert found[9].n_removed == 120 and found[13].n_removed == 50 and found[16].n_removed == 50
    assert found[16].repeats[0].first == 0
    assert check(spark, []) == {}


def test_many_copies_of_a_passage_and_one_very_long_text(spark):
    rng = random.Random(2)
    passage = " ".join(words(rng, 70))
    rows = [(i, f"{' '.join(words(rng, 8, 10**6))} {passage} {' '.join(words(rng, 8, 10**6))}") for i in range(400)]
    rows += [(1000 + i, passage) for i in range(200)]
    rows.append((5000, " ".join(words(rng, 60_000, 10**6)) + " " + passage))
    found = check(spark, rows, parts=5)
    assert found[0].n_removed == 0 and {found[i].n_removed for i in (1, 399, 1000, 5000)} == {70}


def test_documents_without_a_common_seed_ask_for_no_window(spark):
    rng = random.Random(4)
    rows = [(i, i, " ".join(words(rng, 300, 10**7))) for i in range(40)]
    docs = spark.createDataFrame(rows, "owner long, key long, text string")
    assert substrings.repeated_windows(docs, Workspace(spark, "test")).count() == 0


def test_equal_windows_have_equal_seeds():
    rng = np.random.default_rng(0)
    runs = rng.integers(0, 40, 5000).astype(np.uint64) << np.uint64(40)  # many ties
    n = W - substrings.SEED + 1
    seeds = substrings._seeds_of(runs)
    assert len(seeds) == len(runs) - n + 1
    assert all(seeds[i] == i + int(np.argmin(runs[i : i + n])) for i in range(len(seeds)))


def test_without_text(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = substrings.remove_repeats(df, with_text=False).first()
    assert row.kept_text is None and row.kept_sha256 == hashlib.sha256(b"a b").hexdigest()
