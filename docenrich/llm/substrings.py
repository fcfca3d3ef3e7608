"""Exact substring deduplication: winnowed seeds, extended both ways.

A window is ``WINDOW`` consecutive words of a document. Of the runs of ``SEED``
words inside a window the one with the smallest hash is its seed (the first of
equal ones), so equal windows have equal seeds at equal places. Neighbouring
windows mostly share their seed: one in about sixteen words begins one.

1. *Seeds* are joined by their hash. Those of one document alone fall away, which
   are most.
2. *Extension.* An occurrence of a seed is extended both ways over all windows that
   have it as their seed. If a smaller document has the same extent around the
   same seed, all these windows are repeats. This settles what lies inside of
   copies and passages, whatever their number.
3. Near the ends of a match extents differ. There one document of each extent
   extends the seed in every way that makes a window (from all of the rest to the
   left, to all of it to the right), and these windows are compared.
4. Windows that repeat are put together to maximal repeats.

Groups are only ever aggregated to their smallest document and joined back with
it, so a passage that a third of all documents have costs its number of
occurrences. Runs, extents and windows are compared by hashes of 64, 128 and 128
bits; the first only chooses what is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, clean_text
from docenrich.llm.textbytes import mix64, run_hashes, slices, word_bounds, word_hashes

WINDOW = 50
SEED = 20
_LAST_ID = (1 << 63) - 1
#: Place of a run below its hash in one number.
_PLACE_BITS = np.uint64(31)
_PLACE = np.uint64((1 << 31) - 1)
#: Bases (odd) for hashes of stretches of any length.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORDS_AT_ONCE = 1 << 18


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    parts = [
        word_hashes(data, starts[a : a + _WORDS_AT_ONCE], ends[a : a + _WORDS_AT_ONCE], fold=False)
        for a in range(0, len(starts), _WORDS_AT_ONCE)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class _Stretches:
    """Hashes of stretches of words, from sums over the words before each."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        self.back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, pow(base, -1, 1 << 64), np.uint64)])
        powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)])
        self.before = np.r_[np.uint64(0), np.cumsum(words * powers[:n])]

    def hashes(self, first: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        whole = (self.before[first + words] - self.before[first]) * self.back[first]
        return mix64(whole + np.asarray(words).astype(np.uint64)).view(np.int64)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All of ``first[k], first[k] + 1, ...``, ``n[k]`` of them, for every k."""
    before = np.cumsum(n) - n
    return np.arange(int(n.sum())) - np.repeat(before, n) + np.repeat(first, n)


def _seeds_of(runs: np.ndarray) -> np.ndarray:
    """Place of the first smallest run of each window."""
    least = (runs >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(runs), dtype=np.uint64)
    wanted, span = WINDOW - SEED + 1, 1
    while span * 2 <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: len(least) - (wanted - span)], least[wanted - span :])
    return (least & _PLACE).astype(np.int64)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "key"))
        for row, data, offsets in slices(batch.column("text")):
            starts, ends, first = word_bounds(data, offsets)
            windows = np.maximum(np.diff(first) - WINDOW + 1, 0)
            if not windows.sum():
                continue
            words = _hashed(data, starts, ends)
            runs = run_hashes(words, SEED)
            at = _ranges(first[:-1], windows)
            seed = _seeds_of(runs)[at]
            doc = np.repeat(np.arange(len(windows)), windows)
            begins = np.flatnonzero(np.r_[True, (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])])
            n = np.diff(np.r_[begins, len(at)])
            doc, at, seed = doc[begins], at[begins], seed[begins]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner[row + doc]),
                    pa.array(key[row + doc]),
                    pa.array(runs[seed].view(np.int64)),
                    pa.array(_Stretches(words, _BASES[0]).hashes(at, n + (WINDOW - 1))),
                    pa.array((at - first[doc]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                ],
                names=["owner", "key", "seed", "extent", "at", "windows"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "key"))
        of = batch.column("of")
        bounds = np.r_[0, np.cumsum(of.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        at, n = (of.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "windows"))
        for row, data, offsets in slices(batch.column("text")):
            starts, ends, first = word_bounds(data, offsets)
            words = _hashed(data, starts, ends)
            rows = len(first) - 1
            mine = slice(bounds[row], bounds[row + rows])
            doc = np.repeat(np.arange(rows), np.diff(bounds[row : row + rows + 1]))
            begins = _ranges(at[mine] + first[doc], n[mine])
            doc = np.repeat(doc, n[mine])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner[row + doc]),
                    pa.array(key[row + doc]),
                    pa.array((begins - first[doc]).astype(np.int32)),
                    *(pa.array(_Stretches(words, base).hashes(begins, WINDOW)) for base in _BASES),
                ],
                names=["owner", "key", "at", "one", "two"],
            )


def _without(with_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts, removed = [], [], [], [], []
            for text, of in zip(batch.column("text"), batch.column("of")):
                words = text.as_py().split()  # bytes: at white space of ASCII only
                repeats, kept, end = [], [], 0
                for at, n in sorted((x["at"], x["windows"]) for x in of.as_py() or ()):
                    past = at + n + WINDOW - 1
                    if repeats and at <= end:
                        repeats[-1][1] = max(past, end) - repeats[-1][0]
                    else:
                        kept += words[end:at]
                        repeats.append([at, past - at])
                    end = max(past, end)
                kept = b" ".join(kept + words[end:] if repeats else words)
                n_words.append(len(words))
                n_removed.append(sum(n for _, n in repeats))
                digests.append(hashlib.sha256(kept).hexdigest())
                removed.append([{"first": at, "words": n} for at, n in repeats])
                texts.append(kept if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(texts, pa.binary()),
                    pa.array(removed, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "repeats"],
            )

    return task


def repeated_windows(docs: DataFrame, work: Workspace) -> DataFrame:
    """``(owner, key, at, windows)``: stretches of windows that a smaller document has too.

    ``docs`` has ``owner``, ``key`` and ``text``; ``at`` is the place of the first window's first word.
    """
    seeds = work.save(
        docs.select("owner", "key", "text").mapInArrow(
            _seeds, "owner long, key long, seed long, extent long, at int, windows int"
        ),
        "seeds",
    )
    # seeds that several documents have; several extents, if these differ
    # what is joined back is written first: large groups of rows can then be split
    met = work.save(
        seeds.groupBy("seed")
        .agg(
            F.min("owner").alias("least"), F.max("owner").alias("most"),
            (F.min("extent") != F.max("extent")).alias("several"),
        )
        .where("least < most")
        .select("seed", "least", "several"),
        "met",
    )
    shared = work.save(seeds.join(met, "seed"), "shared")
    work.drop(seeds)
    parted = shared.where("several")
    least = work.save(parted.groupBy("seed", "extent").agg(F.min("owner").alias("its_least")), "least")
    parted = work.save(
        parted.join(least, ["seed", "extent"]).select("owner", "key", "at", "windows", "its_least"), "parted"
    )
    whole = shared.where("NOT several AND owner > least").select("owner", "key", "at", "windows")
    whole = whole.union(parted.where("owner > its_least").select("owner", "key", "at", "windows"))
    # the first document of each extent asks for its windows one by one
    heads = (
        parted.where("owner = its_least")
        .groupBy("owner", "key")
        .agg(F.collect_list(F.struct("at", "windows")).alias("of"))
    )
    windows = work.save(
        docs.join(heads, ["owner", "key"])
        .select("owner", "key", "text", "of")
        .mapInArrow(_windows, "owner long, key long, at int, one long, two long"),
        "windows",
    )
    met = work.save(
        windows.groupBy("one", "two")
        .agg(F.min("owner").alias("least"), F.max("owner").alias("most"))
        .where("least < most")
        .select("one", "two", "least"),
        "met",
    )
    single = windows.join(met, ["one", "two"]).where("owner > least")
    return whole.union(single.select("owner", "key", "at", F.lit(1).alias("windows")))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Documents without the words of windows that a document of smaller id has too.

    Returns ``doc_id, n_words, n_removed, kept_sha256, kept_text, repeats``:
    ``repeats`` lists the maximal stretches taken out as ``(first, words)``, and
    ``kept_text`` is the rest, joined by one space (null without ``with_text``).
    Words are parted by white space of ASCII and compared as they are. Windows are
    judged on the input, so the smallest id keeps a passage whole. A window
    repeated within one document alone stays; so do those of rows with equal ids,
    for neither is smaller. A null id is larger than all others. Null and empty texts
    have no words; a text of fewer words than a window is kept. An empty table gives
    an empty one; other columns are not looked at.
    """
    work = Workspace(docs.sparkSession, "substrings")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")
    ).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_LAST_ID)).alias("owner"),
        F.xxhash64("text").alias("key"),
        "text",
    )
    found = repeated_windows(rows, work)
    of = found.groupBy("owner", "key").agg(F.collect_set(F.struct("at", "windows")).alias("of"))
    return (
        rows.join(of, ["owner", "key"], "left")
        .select("doc_id", F.col("text").cast("binary").alias("text"), "of")
        .mapInArrow(
            _without(with_text),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary, "
            "repeats array<struct<first:long,words:long>>",
        )
        .select("doc_id", "n_words", "n_removed", "kept_sha256", F.col("kept").cast("string").alias("kept_text"), "repeats")
    )
