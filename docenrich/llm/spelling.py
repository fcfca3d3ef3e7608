"""Spelling variants: words one code point apart, found by a dictionary of trie-node pairs.

The distinct words are put into two tries, one of the words and one of the
reversed words, whose nodes are numbered. A word cut after ``i`` code points is
then a pair of integers, the node of what comes before and the node of what
comes after. Two words differ

* by one replaced code point if they have the same pair around a skipped
  position,
* by one inserted or deleted code point if the pair around a skipped position
  of one is the pair at a cut of the other.

So equal pairs give exact neighbours and nothing else. Words that share a pair
around a skipped position differ in one code point there, and at most one word
has a given pair at a cut: a group of equal pairs is never larger than the
alphabet and one, whatever the number of words.

The tries are never held anywhere. Words are range-partitioned and sorted, so
that a task meets the words below a node one after the other and numbers the
nodes as it goes; what the first word of a partition shares with the words
before it is settled from the first and last word of each partition.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is so many times as frequent as its variant.
RATIO = 5
#: Distinct words a task holds before it hands their counts on.
_HELD = 250_000
#: Texts of more bytes are read word by word, not as one list of words.
_LONG_TEXT = 4 << 20
#: Nodes of a partition are numbered below this, above it stands the partition.
_PART_BITS = 40


def _counts(min_length: int, slip_one_in: int):
    word = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text")):
                text = text.as_py().lower().decode("utf-8", "replace")  # bytes: A-Z only
                found = (m.group() for m in word.finditer(text)) if len(text) > _LONG_TEXT else word.findall(text)
                start = zlib.crc32(name)
                for run, n in Counter(found).items():
                    if slip_one_in:
                        mark = zlib.crc32(run.encode(), start)
                        if mark % slip_one_in == 0:
                            gap = mark % len(run)
                            run = run[:gap] + run[gap + 1 :]
                            if len(run) < min_length:
                                continue
                    held[run] += n
            if len(held) > _HELD:
                yield _batch(held)
                held = Counter()
        yield _batch(held)

    return task


def _batch(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
    )


def frequent_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip_one_in: int = 0,
) -> DataFrame:
    """``(word, n)``: words of ``min_length`` code points that occur ``min_count`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased.
    ``slip_one_in`` plants spelling slips: of the runs whose crc32, taken over
    ``<id>:<run>``, it divides, the code point at the crc32 modulo the length goes.
    Null texts have no words, a null id is spelled as nothing. Repeated rows count
    each; an empty table gives none; other columns are not looked at.
    """
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).cast("binary").alias("name"),
        F.col(text_col).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(_counts(min_length, slip_one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the nodes on the path of each word; the words come sorted."""
    part = TaskContext.get().partitionId()
    last, path, used = "", [0], 0
    for batch in batches:
        paths = []
        for key in batch.column("key").to_pylist():
            same = len(commonprefix((last, key)))
            fresh = len(key) - same
            path = path[: same + 1] + list(range(used + 1, used + 1 + fresh))
            last, used = key, used + fresh
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array([part] * len(paths), pa.int64()),
                pa.array(paths, pa.list_(pa.int64())),
            ],
            names=["key", "part", "path"],
        )


def trie_paths(keys: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``(key, nodes)``: for each distinct ``key`` the numbers of its prefixes' nodes, from the root (0) on.

    Two keys have the same number at a depth if and only if they share the prefix.
    """
    walked = work.save(
        keys.select("key")
        .repartitionByRange("key")
        .sortWithinPartitions("key")
        .mapInArrow(_walk, "key string, part long, path array<long>"),
        name,
    )
    # one row for each partition: what its first word has from the words before
    seams = walked.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("path", "key").alias("path")
    )
    inherited, carried, nodes = [], "", [0]
    for seam in sorted(seams.collect(), key=lambda r: r["first"].encode()):
        same = len(commonprefix((carried, seam["first"])))
        known = nodes[: same + 1]
        inherited.append((seam["part"], known))
        above = seam["part"] << _PART_BITS
        carried, nodes = seam["last"], [known[x] if x < len(known) else above | x for x in seam["path"]]
    known = work.save(work.spark.createDataFrame(inherited, "part long, known array<long>"), "known")
    number = lambda x: F.when(x < F.size("known"), F.get("known", x.cast("int"))).otherwise(
        F.shiftleft("part", _PART_BITS).bitwiseOR(x)
    )
    return walked.join(known, "part").select("key", F.transform("path", number).alias("nodes"))


def pair_groups(words: DataFrame, work: Workspace) -> DataFrame:
    """Groups of words with equal node pairs: ``members`` of ``(rank, word, kind)``.

    ``kind`` is 0 for the pair at a cut, 1 and 2 for a pair around a skipped
    position: 2 if the position before holds the same code point, where a deletion
    gives the same word once more. ``rank`` is minus the count.
    """
    heads = trie_paths(words.select(F.col("word").alias("key")), work, "heads")
    tails = trie_paths(words.select(F.reverse("word").alias("key")), work, "tails")
    cut = (
        words.join(heads.select(F.col("key").alias("word"), F.col("nodes").alias("head")), "word")
        .join(tails.select(F.reverse("key").alias("word"), F.col("nodes").alias("tail")), "word")
        .select((-F.col("n")).alias("rank"), "word", "head", "tail", F.posexplode("head").alias("i", "before"))
        .withColumn("rest", F.size("tail") - 1 - F.col("i"))
    )
    twin = F.substring("word", F.col("i") + 1, F.lit(1)) == F.substring("word", F.col("i"), F.lit(1))
    skipped = F.struct(
        F.get("tail", F.col("rest") - 1).alias("after"),
        F.when((F.col("i") > 0) & twin, 2).otherwise(1).cast("byte").alias("kind"),
    )
    whole = F.struct(F.get("tail", F.col("rest")).alias("after"), F.lit(0).cast("byte").alias("kind"))
    pairs = cut.select(
        "rank", "word", "before",
        F.inline(F.when(F.col("rest") > 0, F.array(whole, skipped)).otherwise(F.array(whole))),
    )
    return (
        pairs.groupBy("before", "after")
        .agg(F.collect_list(F.struct("rank", "word", "kind")).alias("members"))
        .where(F.size("members") > 1)
    )


def _neighbours(groups: DataFrame) -> DataFrame:
    """``(word, near)``: for each member of a group the members that are near to it there."""

    def near(one):
        both_skip = (one["kind"] > 0) & (F.col("me.kind") > 0)
        return (one["word"] != F.col("me.word")) & (both_skip | (one["kind"] + F.col("me.kind") == 1))

    return (
        groups.select("members", F.explode("members").alias("me"))
        .select("me.word", F.filter("members", near).alias("near"))
        .where(F.size("near") > 0)
    )


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: every pair of words one code point apart, both ways round.

    ``words`` holds distinct ``word`` and ``n``; words may be of any length. An
    empty table gives an empty one.
    """
    work = Workspace(words.sparkSession, "near_words")
    near = _neighbours(pair_groups(work.save(words.select("word", "n"), "words"), work))
    one = near.select("word", F.explode("near").alias("other"))
    return one.select("word", F.col("other.word").alias("near"), (-F.col("other.rank")).alias("near_n"))


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of distinct ``word`` and ``n``.

    ``form`` is the near word of largest count (ties: the smallest by code points)
    if it is ``ratio`` times as frequent, else null; ``root`` is where the forms
    lead in the end, the word itself if it has none. Counts grow by ``ratio`` (2 at
    least) from form to form, so chains are short and have no loops. An empty table
    gives an empty one.
    """
    work = Workspace(words.sparkSession, "spelling")
    words = work.save(words.select("word", "n"), "words")
    best = (
        _neighbours(pair_groups(words, work))
        .select("word", F.size("near").alias("k"), F.array_min("near").alias("best"))
        .groupBy("word")
        .agg(F.sum("k").alias("n_near"), F.min(F.struct("best.rank", "best.word")).alias("best"))
    )
    near_n = -F.col("best.rank")
    enough = near_n >= F.col("n") * max(ratio, 2)
    told = work.save(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.word")).alias("form"),
            F.when(enough, near_n).alias("form_n"),
        ),
        "told",
    )
    # each step doubles the length of the way that is known
    ways = work.save(told.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("on"))
        longer = work.save(ways.join(further, "root", "left").select("word", "root", "on"), "longer")
        if longer.where("on IS NOT NULL").isEmpty():
            break
        ways = longer.select("word", F.coalesce("on", "root").alias("root"))
    return told.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
