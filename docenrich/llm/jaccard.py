"""N-gram Jaccard join by filters in several global token orders.

Two sets of a similarity of 0.8 or more differ in few tokens, so under any
global order of all tokens the first ones of both must have tokens in common.
Three orders are used, and their filters intersected before a pair is verified:

1. by hash: of the first ``missing + spare`` tokens of each set, at least
   ``needed`` are shared. A set that has fewer in common with any others falls
   away; of all sets only these tokens are ever shuffled.
2. from rare to frequent, over the whole sets that are left: two sets must
   share one of their first tokens, which keeps passages that many texts have
   out of the candidates,
3. by magnitude of frequency, then by another hash: the same once more.

Equal sets are one node. Candidates are first verified against a few hubs of
their token, then only across the components that this has left: a group of
copies costs a multiple of its size, not its square, and no link between
components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text, connected_components, released
from docenrich.llm.textbytes import shingle_sets

WORDS = 5
#: Similarity in hundredths.
PERCENT = 80
#: Tokens beyond those that may be missing, as a share of the set, for the first order.
SPARE = 0.1
#: Hubs of a token group by hash, besides the most central one.
HUBS = 2
HUB_ROUNDS = 2


def missing(n, percent: int):
    """How many of ``n`` tokens a set at the similarity may lack."""
    return n - -(-percent * n // 100)


def spare(n):
    return np.maximum(1, np.floor(SPARE * n).astype(np.int64))


def needed(n, percent: int):
    """Shared tokens among the first ones that every partner of the size must reach."""
    return spare(-(-percent * n // 100))


def _prefixes(percent: int, words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, firsts = [], [], []
            for found in shingle_sets(batch.column("text"), words):
                tokens = np.sort(found.view(np.int64))
                n = len(tokens)
                sizes.append(n)
                nodes.append(node_of(tokens) if n else None)
                firsts.append(tokens[: int(missing(n, percent) + spare(np.array(n)))] if n else tokens)
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *firsts]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([int(needed(np.array(n), percent)) for n in sizes], pa.int64()),
                    pa.ListArray.from_arrays(ends, values),
                ],
                names=["doc_id", "n", "node", "need", "first"],
            )

    return task


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a sorted token set; equal sets share it."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _whole_sets(words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(s.view(np.int64)) for s in shingle_sets(batch.column("text"), words)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(ends, values),
                ],
                names=["node", "own", "tokens"],
            )

    return task


def _survivors(rows: DataFrame, work: Workspace) -> DataFrame:
    """The nodes that pass the first order's filter."""
    tokens = rows.where("n > 0").select("node", "need", F.explode("first").alias("token"))
    shared = (
        tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    )
    shared = work.save(shared.select("token"), "shared")
    met = tokens.join(shared, "token", "left_semi").distinct()
    found = met.groupBy("node", "need").count().where(F.col("count") >= F.col("need")).select("node")
    found = work.save(found, "survivors")
    work.drop(shared)
    return found


def _sets_of(nodes: DataFrame, rows: DataFrame, texts: DataFrame, words: int, work: Workspace) -> DataFrame:
    """``node, tokens``: the whole sets of the nodes, from one text of each."""
    wanted = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    chosen = texts.alias("t").join(
        wanted.hint("shuffle_hash").alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))
    )
    sets = chosen.select("w.node", "t.text").mapInArrow(released(_whole_sets(words)), "node long, own long, tokens array<long>")
    # rows that repeat an id may have another text, or the same one twice
    return work.save(sets.where("node = own").drop("own").dropDuplicates(["node"]), "whole")


def _ordered(whole: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """``node, n, met, second, third, tokens`` of every set that may have a partner.

    ``met`` counts the tokens that another survivor has: a partner can share no
    others. ``second`` and ``third`` are the first tokens in these orders.
    """
    tokens = whole.select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    shared = work.save(shared, "frequencies")
    found = tokens.join(shared, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "token"))).alias("by_often"),
        F.array_sort(
            F.collect_list(F.struct(F.floor(F.log2("often")).alias("a"), F.xxhash64("token").alias("b"), "token"))
        ).alias("by_magnitude"),
    )
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    met = F.size("by_often")
    keep = met - least + 1
    found = found.where(met >= least).select(
        "node",
        "n",
        met.alias("met"),
        F.slice("by_often", F.lit(1), keep)["token"].alias("second"),
        F.slice("by_magnitude", F.lit(1), keep)["token"].alias("third"),
    )
    sets = work.save(found.join(whole, "node"), "sets")
    work.drop(shared)
    return sets


def _groups(sets: DataFrame, work: Workspace) -> DataFrame:
    """``token, node, n, met, place``: who shares a token of the second order, and where it has it.

    Of tokens that exactly the same nodes share, as those of a common passage,
    one stands for all, with the first place that any of them has.
    """
    members = sets.select("node", "n", "met", F.posexplode("second").alias("place", "token"))
    who = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"who{salt}") for salt in (0, 1)]
    tokens = members.groupBy("token").agg(F.count("*").alias("size"), *who).where("size > 1")
    tokens = work.save(tokens, "tokens")
    one = tokens.groupBy("size", "who0", "who1").agg(F.min("token").alias("one"))
    alike = tokens.join(one, ["size", "who0", "who1"]).select("token", "one")
    return work.save(
        members.join(alike, "token")
        .groupBy(F.col("one").alias("token"), "node", "n", "met")
        .agg(F.min("place").alias("place")),
        "members",
    )


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether this token can be the first, in the second order, that a pair at the similarity shares.

    Of ``met`` tokens at least ``overlap`` are shared, so that one is among the
    first ``met - overlap + 1`` of both.
    """
    overlap = F.ceil((F.col(f"{a}n") + F.col(f"{b}n")) * percent / (100 + percent) - 1e-9)
    return (F.col(f"{a}place") <= F.col(f"{a}met") - overlap) & (F.col(f"{b}place") <= F.col(f"{b}met") - overlap)


def _hub_pairs(members: DataFrame, salt: int, percent: int, work: Workspace) -> DataFrame:
    """Pairs of the members of a token group with its hubs, where components differ."""
    orders = [-F.col("met") / F.col("n"), *[F.xxhash64("node", F.lit(salt * HUBS + j)).cast("double") for j in range(HUBS)]]
    hubs = [F.min(F.struct(o.alias("o"), F.struct("node", "comp", "n", "met", "place").alias("hub"))) for o in orders]
    found = (
        members.groupBy("token")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.array(*hubs).alias("hubs"))
        .where("low <> high")
        .select("token", F.explode(F.array_distinct(F.transform("hubs", lambda h: h["hub"]))).alias("hub"))
        .select("token", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "comp", "n", "met", "place")])
    )
    met = members.join(work.save(found, "hubs"), "token").where(
        (F.col("comp") != F.col("hub_comp")) & _may_link("", "hub_", percent)
    )
    return met.select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b")).distinct()


def _cross_pairs(members: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """All pairs in a token group that lie in different components."""
    shares = members.groupBy("token", "comp").agg(F.count("*").alias("size"))
    mixed = (
        shares.groupBy("token")
        .agg(F.max(F.struct("size", "comp")).alias("main"), F.count("*").alias("comps"))
        .where("comps > 1")
        .select("token", F.col("main.comp").alias("main"))
    )
    left = work.save(members.join(work.save(mixed, "mixed"), "token"), "left")
    few = left.where("comp <> main").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "comp", "n", "met", "place")])
    pairs = left.join(few, "token").where(
        ((F.col("comp") == F.col("main")) | (F.col("node") < F.col("x_node")))
        & (F.col("comp") != F.col("x_comp"))
        & _may_link("", "x_", percent)
    )
    return pairs.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the third order's filter and reach the similarity."""
    one = lambda s: sets.select(
        F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("third").alias(f"{s}_third"), F.col("tokens").alias(f"{s}_tokens")
    )
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    enough = both * 100 >= percent * (F.col("a_n") + F.col("b_n") - both)
    return (
        pairs.join(one("a"), "a")
        .join(one("b"), "b")
        .where(F.arrays_overlap("a_third", "b_third") & enough)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _prepared(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with the node of each, the sets that may have partners, and their token groups."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    rows = work.save(
        texts.mapInArrow(released(_prefixes(percent, words)), "doc_id long, n long, node long, need long, first array<long>"), "rows"
    )
    whole = _sets_of(_survivors(rows, work), rows, texts, words, work)
    sets = _ordered(whole, percent, work)
    work.drop(whole)
    return rows, sets, _groups(sets, work)


def similar_sets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """The join itself: ``(doc_id, n_shingles, node)`` of every row, and the links ``(node, other)``.

    Rows of equal sets have one ``node``, rows without words none. Every two
    different sets at the similarity are one link, ``node`` the smaller of both, also
    within a component: a group of many near copies has as many links as its texts
    have pairs. Texts, sets and odd rows are as in ``near_duplicates``.
    """
    work = Workspace(docs.sparkSession, "jaccard")
    rows, sets, groups = _prepared(docs, id_col, text_col, words, percent, work)
    others = groups.select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "met", "place")])
    pairs = groups.join(others, "token").where((F.col("node") < F.col("x_node")) & _may_link("", "x_", percent))
    pairs = work.save(pairs.select(F.col("node").alias("a"), F.col("x_node").alias("b")).distinct(), "pairs")
    links = work.save(_linked(pairs, sets, percent), "links")
    work.drop(pairs, sets, groups)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "node"), links.select(
        F.col("u").alias("node"), F.col("v").alias("other")
    )


def link_counts(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(doc_id, n_links)`` of every row: the other rows that its text links to, copies included."""
    sizes = members.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("rows"))
    both = links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    others = sizes.select(F.col("node").alias("other"), F.col("rows").alias("far"))
    far = both.join(others, "other").groupBy("node").agg(F.sum("far").alias("far"))
    counts = sizes.join(far, "node", "left").select("node", (F.col("rows") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    return members.join(counts, "node", "left").select("doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs of other characters than space and 0x09 to 0x0D, with A-Z
    lower-cased; a text's set are its distinct runs of ``words`` words, or its
    whole sequence if it has fewer. Texts link when the intersection of their
    sets is at least ``percent`` hundredths of the union. ``component_id`` is
    the smallest id reachable by links, the row's own included; without words
    or text (null) a row has no set and only itself. Rows that repeat an id are
    rows of their own; rows without id never lend theirs. Empty in, empty out;
    other columns are not looked at.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "jaccard")
    rows, sets, groups = _prepared(docs, id_col, text_col, words, percent, work)
    comps = spark.createDataFrame([], "node long, component long")
    for round_ in range(HUB_ROUNDS + 1):
        members = groups.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        last = round_ == HUB_ROUNDS
        pairs = _cross_pairs(members, percent, work) if last else _hub_pairs(members, round_, percent, work)
        links = work.save(_linked(work.save(pairs, "pairs"), sets, percent), "links")
        if not links.isEmpty():
            known = comps.select(F.col("node").alias("u"), F.col("component").alias("v"))
            comps = connected_components(links.union(known), work)
    work.drop(sets, groups)
    placed = (
        rows.select("doc_id", "n", "node")
        .join(comps, "node", "left")
        .select("doc_id", "n", F.coalesce("component", "node").alias("comp"))
    )
    placed = work.save(placed, "placed")
    # written, so that a large component can be split when it is joined
    firsts = work.save(placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id")), "firsts")
    return placed.join(firsts, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
