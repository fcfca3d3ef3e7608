import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docenrich.llm import jaccard
from docenrich.llm.common import Workspace, connected_components
from docenrich.llm.textbytes import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    """Component of each row by comparing all pairs."""
    sets = [plain_set(text) for _, text in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    ids = {c: min((r[0] for r, d in zip(rows, comp) if d == c and r[0] is not None), default=None) for c in comp}
    return sorted(((r[0], len(s), ids[c]) for r, s, c in zip(rows, sets, comp)), key=repr)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    out = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(3, 120))
        out += [" ".join(edited(base, rng, k)) for k in (0, 0, 1, 2, 3, 5)]
        out.append(" ".join(base) + "\n" + passage)
    big = rng.choices(vocabulary, k=150)
    out += [" ".join(edited(big, rng, rng.randrange(6))) for _ in range(40)]
    out += [passage, passage.upper(), "", None, " \t\n", "one two", "One  TWO", "a b c d e", "é É x y z", "x" * 5000]
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = texts(seed) + [(None, "one two"), (7, "a text that repeats an id of another row"), (7, None)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, node int")
    mine = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=repr)
    assert mine == plain_components(rows)


@pytest.mark.parametrize("seed", [3])
def test_links_are_those_of_all_pairs(spark, seed):
    rows = texts(seed) + [(None, "one two"), (7, None)]
    df = spark.createDataFrame([(k, t, 0) for k, (_, t) in enumerate(rows)], "doc_id long, text string, token int")
    members, links = jaccard.similar_sets(df)
    sets = [frozenset(plain_set(t)) for _, t in rows]
    node = {r.doc_id: r.node for r in members.collect()}
    names = {}
    for k, s in enumerate(sets):
        assert names.setdefault(s, node[k]) == node[k]
    assert names[frozenset()] is None and len(set(names.values())) == len(names)
    near = lambda x, y: bool(x) and 100 * len(x & y) >= 80 * len(x | y)
    wanted = {tuple(sorted((names[x], names[y]))) for x in names for y in names if x != y and near(x, y)}
    found = [tuple(r) for r in links.collect()]
    assert set(found) == wanted and len(found) == len(wanted) > 100
    counts = {r.doc_id: r.n_links for r in jaccard.link_counts(members, links).collect()}
    assert counts == {k: sum(near(s, o) for m, o in enumerate(sets) if m != k) for k, s in enumerate(sets)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(df).collect() == []


def test_sets_of_sliced_columns():
    column = pa.array(["a b c d e f", "", "A B", "x\x0by\x0cz  q w e"]).slice(1)
    assert [len(s) for s in shingle_sets(column)] == [0, 1, 2]
    one, other = shingle_sets(pa.array(["A b C d E", "a B c D e"]))
    assert (one == other).all()


def test_prefix_bounds_hold():
    """Sets at the similarity share the needed number of first tokens in any order."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        both = rng.permutation(1000)[:n]
        x, y = both.copy(), both.copy()
        extra = int(n * 0.25)
        y = np.r_[y, 2000 + np.arange(rng.integers(0, extra + 1))]
        if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
            continue
        order = rng.permutation(3000)
        first = []
        for s in (x, y):
            size = int(jaccard.missing(len(s), 80) + jaccard.spare(np.array(len(s))))
            first.append(set(s[np.argsort(order[s])][:size].tolist()))
        need = max(int(jaccard.needed(np.array(len(s)), 80)) for s in (x, y))
        assert len(first[0] & first[1]) >= need


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (2, 1)] + [(i, i + 1) for i in range(100, 140)]
    df = spark.createDataFrame(edges, "u long, v long")
    found = dict(map(tuple, connected_components(df, Workspace(spark, "test")).collect()))
    assert {found[i] for i in (1, 2, 3, 7, 8, 9)} == {1} and found[21] == 20
    assert {found[i] for i in range(100, 141)} == {100}
