import random
import re
from collections import Counter

import numpy as np
import pytest

from docenrich.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top_terms=200):
    rows = [(lang or "", source or "", text or "") for lang, source, text in rows]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    docs = [(lang, source, Counter(map(lower, TERM.findall(text)))) for lang, source, text in rows]
    result = []
    for lang in {d[0] for d in docs}:
        df, all_uses, by_source = Counter(), Counter(), {}
        for _, source, uses in (d for d in docs if d[0] == lang):
            df.update(uses.keys())
            all_uses.update(uses)
            by_source.setdefault(source, Counter()).update(uses)
        kept = [t for t, n in df.items() if n >= min_docs]
        share = lambda uses: {t: 1 + 10**9 * (uses[t] + 1) // (sum(uses[k] for k in kept) + len(kept)) for t in kept}
        q = share(all_uses)
        p = {s: share(uses) for s, uses in by_source.items()}
        for s in p:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in p if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if by_source[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", terms, top_terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                result += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:limit], 1)]
    return sorted(result)


def check(spark, rows, **options):
    df = spark.createDataFrame(
        [(*r, 1, "x", 2.0) for r in rows], "lang string, source string, text string, uses int, term string, p double"
    )
    found = divergence.divergence(df, **options).collect()
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in found) == brute(rows, **options)


def corpus(n, sources=7, seed=0, vocabulary=60):
    rng = random.Random(seed)
    words = [f"{'Äβx'[k % 3]}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(vocabulary)]
    for _ in range(n):
        source = rng.randrange(sources) if rng.random() < 0.6 else 0
        liked = words[source * 5 :] if rng.random() < 0.5 else words
        text = rng.choice([" ", "1", "_", "\n"]).join(rng.choice(liked) for _ in range(rng.randrange(30)))
        yield rng.choice(["en", "de"]), f"src{source}", text


def test_against_the_sums_term_by_term(spark):
    check(spark, list(corpus(400)))
    check(spark, list(corpus(400)), min_docs=20, top_terms=3)


def test_nulls_ties_and_groups_without_terms(spark):
    rows = list(corpus(40, seed=1))
    rows += [(None, None, "ab cd")] * 3 + [("", "", "ab"), (None, "s", None), ("en", None, ""), ("en", "numbers", "1 2 3")]
    rows += [("fr", "a", "un deux"), ("fr", "b", "trois"), ("xx", "only", "alpha beta"), ("xx", "only", "alpha beta"), ("xx", "only", "alpha")]
    # sources that are equal, and one very long text
    rows += [("tie", s, "kk ll mm") for s in ("é", "z", "a", "Z") for _ in range(3)] + [("tie", "long", "kk " * 50_000 + "ll")]
    check(spark, rows)
    assert divergence.divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


@pytest.mark.parametrize("limits", [(10, 10, 3)])
def test_tasks_that_hand_on_early(spark, monkeypatch, limits):
    for name, value in zip(("_HELD", "_LONG_TEXT", "_AT_ONCE"), limits):
        monkeypatch.setattr(divergence, name, value)
    check(spark, list(corpus(150, sources=5, seed=2)))


def test_one_source_has_a_term_almost_alone(spark):
    # shares near 1, against 1 in 10 ** 9: the largest values there can be
    rows = [("en", "big", "aa " * 200_000)] * 3 + [("en", s, "bb cc") for s in ("b", "c", "d") for _ in range(3)]
    check(spark, rows)


def test_common_beginnings_of_rows():
    lang = np.array([0, 0, 0, 0, 1])
    sizes = np.array([2, 3, 3, 2, 2])
    first = np.cumsum(sizes) - sizes
    source = np.array([0, 1, 0, 1, 2, 0, 1, 2, 0, 2, 0, 2])
    p = np.array([5, 6, 5, 6, 7, 5, 6, 8, 5, 7, 5, 7])
    assert divergence._shared(lang, first, sizes, source, p).tolist() == [0, 2, 2, 1, 0]
