"""How the sources of a language differ in their words, by a frequent-pattern tree of term rows.

Every term of a language is a row of the sources that use it, in the order of
their names, each with its share of the source. Rows are put into a
frequent-pattern tree: rows that begin alike share a path, and a node knows how
many rows pass through it. The divergence of two sources is a sum over all terms
of the language; it is split by inclusion and exclusion into

* what every term would give if neither source had it,
* what the terms of one source change to that (by the histogram of its shares),
* what terms of both change further. This last part is summed in the tree: once
  for each node and each of its ancestors, times the rows through the node, and
  not for each row.

The tree is never held: distinct rows are dealt to tasks by how they begin, and
sorted there, so that rows with a common path come together; a task builds the
part of the tree that a batch of them makes. Sums over parts of the tree are added up, so where
it is cut makes no difference. All numbers are integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text

#: A term is kept by a language that has it in so many documents.
MIN_DOCS = 3
SCALE = 1_000_000_000
#: So many terms of a group are told.
TOP_TERMS = 200
#: Counts a task holds before it hands them on.
_HELD = 300_000
#: Texts of more bytes are read term by term, not as one list of terms.
_LONG_TEXT = 4 << 20
#: Pairs of a node and an ancestor that are worked out at a time.
_AT_ONCE = 1 << 18
_LOW = (1 << 32) - 1

_term = re.compile(rb"[a-z\x80-\xff]+")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        columns = [batch.column(c) for c in ("lang", "source", "text")]
        for lang, source, text in zip(*columns):
            text = text.as_py().lower()  # bytes: A-Z only
            uses, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            if len(text) > _LONG_TEXT:
                own = Counter(m.group() for m in _term.finditer(text))
                uses.update(own)
                docs.update(own.keys())
            else:
                terms = _term.findall(text)
                uses.update(terms)
                docs.update(set(terms))
        if sum(len(uses) for uses, _ in held.values()) > _HELD:
            yield from _counted(held)
            held = {}
    yield from _counted(held)


def _counted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (uses, docs) in held.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(uses), pa.string()),
                pa.array([source] * len(uses), pa.string()),
                pa.array(uses.keys(), pa.binary()),
                pa.array(uses.values(), pa.int64()),
                pa.array([docs[t] for t in uses], pa.int64()),
            ],
            names=["lang", "source", "term", "uses", "docs"],
        )


def term_rows(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, total, of)`` of each kept term; ``of`` lists the ``(source, uses)`` that have it."""
    counts = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        _term_counts, "lang string, source string, term binary, uses long, docs long"
    )
    # both groupings are served by one shuffle
    return (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("uses").alias("total"),
            F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "uses")).alias("of"),
        )
        .where(F.col("docs") >= min_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "total", "of")
    )


def share(uses: Column, base: Column) -> Column:
    """``1 + floor(SCALE * (uses + 1) / base)``, exactly; null if ``base`` is 0."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (uses + 1).cast("decimal(19,0)")
    below = F.when(base > 0, base).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


def excess(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / q)``; both are at most ``SCALE + 1``, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), q)


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // q


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms of two sources add to what each source's terms add alone.

    A batch holds sorted distinct rows: ``path`` lists the row's ``(source, p, p0)``,
    ``rows`` says how many terms have it. A sum comes in two halves, for it may
    be too large for a long before all parts of the tree are added.
    """
    sums: dict[tuple, list[int]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column("lang").dictionary_encode()
        paths = batch.column("path")
        items = paths.flatten()
        names = items.field("source").dictionary_encode()
        source = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        p, p0 = (items.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("p", "p0"))
        sizes = np.array(paths.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        through = np.r_[0, np.cumsum(batch.column("rows").to_numpy(zero_copy_only=False))]
        shared = _shared(lang, first, sizes, source, p)
        for depth in range(1, int(sizes.max())):
            # a node at this depth begins at each row that shares less with the row before
            begins = np.flatnonzero(shared <= depth)
            rows = through[np.r_[begins[1:], len(sizes)]] - through[begins]
            deep = sizes[begins] > depth
            begins, rows = begins[deep], rows[deep]
            for at in range(0, len(begins), step := max(1, _AT_ONCE // depth)):
                node, weight = begins[at : at + step], rows[at : at + step]
                here = np.repeat((first[node] + depth)[:, None], depth, axis=1).ravel()
                over = (first[node][:, None] + np.arange(depth)).ravel()
                weight = np.repeat(weight, depth)
                whose = np.repeat(lang[node], depth)
                for x, y in ((here, over), (over, here)):
                    more = (
                        _excess(p[x], p[y]) - _excess(p[x], p0[y]) - _excess(p0[x], p[y]) + _excess(p0[x], p0[y])
                    )
                    key = (whose * len(names.dictionary) + source[x]) * len(names.dictionary) + source[y]
                    _add(sums, langs.dictionary, names.dictionary, key, (more >> 32) * weight, (more & _LOW) * weight)
        if len(sums) > _HELD:
            yield _summed(sums)
            sums = {}
    yield _summed(sums)


def _shared(lang, first, sizes, source, p) -> np.ndarray:
    """How many leading items each row has in common with the row before it."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - first[row]
    before = np.maximum(row - 1, 0)
    there = (row > 0) & (place < sizes[before]) & (lang[row] == lang[before])
    twin = np.where(there, first[before] + place, 0)
    same = there & (source[twin] == source) & (p[twin] == p)
    return np.minimum.reduceat(np.where(same, sizes[row], place), first)


def _add(sums, langs, names, key, high, low) -> None:
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    k = len(names)
    totals = zip(key[begins].tolist(), np.add.reduceat(high[order], begins).tolist(), np.add.reduceat(low[order], begins).tolist())
    for code, h, w in totals:
        who = (langs[code // k // k].as_py(), names[code // k % k].as_py(), names[code % k].as_py())
        kept = sums.setdefault(who, [0, 0])
        kept[0] += h
        kept[1] += w


def _summed(sums: dict) -> pa.RecordBatch:
    values = [(h << 32) + w for h, w in sums.values()]
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([who[i] for who in sums], pa.string()) for i in range(3)),
            pa.array([v >> 32 for v in values], pa.int64()),
            pa.array([v & _LOW for v in values], pa.int64()),
        ],
        names=["lang", "source", "item", "high", "low"],
    )


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: sources against each other, and terms against the language.

    Part ``pair`` has a row for every two sources of a language, part ``term`` the
    terms that a source uses more than its language does. Null text, lang and
    source are as empty ones. Documents without terms count as documents, and their
    groups are told; a language without kept terms has pairs of value 0. Repeated
    rows are documents of their own; an empty table gives an empty one; other
    columns are not looked at. A row of a term is as long as the number of sources
    that use it.
    """
    work = Workspace(docs.sparkSession, "divergence")
    docs = docs.select(
        clean_text(lang_col).alias("lang"), clean_text(source_col).alias("source"), clean_text(text_col).alias("text")
    )
    terms = work.save(term_rows(docs, min_docs), "terms")
    of_lang = terms.groupBy("lang").agg(
        F.count("*").alias("terms"), (F.sum("total") + F.count("*")).alias("lang_base")
    )
    of_source = terms.select("lang", F.inline("of")).groupBy("lang", "source").agg(F.sum("uses").alias("uses"))
    groups = work.save(
        docs.select("lang", "source")
        .distinct()
        .join(of_source, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("uses", F.lit(0)) + F.coalesce("terms", F.lit(0))).alias("base"),
            F.col("lang_base"),
        )
        .withColumn("p0", share(F.lit(0), F.col("base"))),
        "groups",
    )
    shares = work.save(
        terms.select("lang", "term", "total", F.inline("of"))
        .join(groups, ["lang", "source"])
        .select(
            "lang",
            "term",
            "source",
            "p0",
            share(F.col("uses"), F.col("base")).alias("p"),
            share(F.col("total"), F.col("lang_base")).alias("q"),
        ),
        "shares",
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank")]
    told = (
        shares.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
        .select(columns)
        .where(F.col("rank") <= top_terms)
    )
    return _pairs(groups, shares, work).select(columns).union(told)


def _pairs(groups: DataFrame, shares: DataFrame, work: Workspace) -> DataFrame:
    exact = lambda value: value.cast("decimal(38,0)").alias("value")
    mine = groups.select("lang", "source", "terms", "p0")
    pairs = mine.join(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang").where(
        "source <> item"
    )
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    nobody = pairs.select(
        "lang", "source", "item",
        exact(F.when(F.col("terms") > 0, F.col("terms").cast("decimal(19,0)") * excess(p0, q0)).otherwise(0)),
    )
    # p is one of few: how often it is used does not matter
    histogram = shares.groupBy("lang", "source", "p").agg(F.count("*").cast("decimal(19,0)").alias("rows"))
    one = histogram.join(pairs, ["lang", "source"])
    forth = exact(F.col("rows") * (excess(p, q0) - excess(p0, q0)))
    back = exact(F.col("rows") * (excess(q0, p) - excess(q0, p0)))
    # both ways at once
    alone = one.select(
        "lang",
        F.inline(
            F.array(
                F.struct("source", "item", forth),
                F.struct(F.col("item").alias("source"), F.col("source").alias("item"), back),
            )
        ),
    )
    paths = (
        shares.groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("source", "p", "p0"))).alias("path"))
        .where(F.size("path") > 1)
        .groupBy("lang", "path")
        .agg(F.count("*").alias("rows"))
    )
    together = (
        paths.repartition("lang", F.slice("path", 1, 3))
        .sortWithinPartitions("lang", "path")
        .mapInArrow(_both, "lang string, source string, item string, high long, low long")
        .select(
            "lang", "source", "item",
            exact(F.col("high").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("low")),
        )
    )
    return (
        nobody.union(alone.select("lang", "source", "item", "value"))
        .union(together)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").cast("long").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
