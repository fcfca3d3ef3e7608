"""Language identification by rank-order profiles.

A language's profile is its most frequent letter n-grams in order of
frequency. A text is given the language to whose profile its own has the
smallest out-of-place distance: the sum, over its most frequent n-grams, of how
far the ranks lie apart, with the profile's length for an n-gram that is
missing there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docenrich.cluster import ship_package
from docenrich.llm.common import clean_text, released

#: Ranks in a profile.
TOP = 300
#: Texts of each language (on average, chosen by hash) that profiles are learned from.
SAMPLE_TEXTS = 2_000
UNDETERMINED = "und"
_LETTER_BITS = 18

Profiles = dict[str, list[int]]


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters; all of them lie below 2 ** 18."""
    return np.array([chr(c).isalpha() for c in range(1 << _LETTER_BITS)])


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all letter n-grams of one to three; a word's ends count as a letter of their own."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(points < 1 << _LETTER_BITS, points, 0).astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    run = np.r_[0, points, 0]
    run = run[np.r_[True, (run[1:] != 0) | (run[:-1] != 0)]]
    if len(run) < 3:
        return np.zeros(0, dtype=np.int64)
    ones = run[run != 0]
    twos = (run[:-1] << _LETTER_BITS) | run[1:] | (1 << 54)
    threes = (run[:-2] << 2 * _LETTER_BITS) | (run[1:-1] << _LETTER_BITS) | run[2:] | (2 << 54)
    return np.concatenate([ones, twos, threes[run[1:-1] != 0]])


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    if len(values) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        some = counts >= least
        values, counts = values[some], counts[some]
    return values[np.lexsort((values, -counts))][:top]


def learn_profiles(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    sample_texts: int = SAMPLE_TEXTS,
) -> Profiles:
    """The profile of every language that a row names and a letter occurs in.

    Learns from about ``sample_texts`` texts of each language, chosen by the
    hash of the text. Rows without language or text are left out. What reaches
    the driver are a count and ``top`` numbers for each language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), clean_text(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    # one number for each language, so that no text has to move
    rates = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], sample_texts / r["count"])])
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.where(share < F.element_at(rates, F.col("lang"))) if counts else rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                codes.setdefault(lang, []).append(ngram_codes(text))
            for lang, found in codes.items():
                values, times = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(times.astype(np.int64))],
                    names=["lang", "code", "n"],
                )

    grams = chosen.mapInArrow(released(count), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = grams.withColumn("rank", rank).where(F.col("rank") <= top)
    profiles: dict[str, dict[int, int]] = {}
    for row in best.collect():
        profiles.setdefault(row["lang"], {})[row["rank"]] = row["code"]
    return {lang: [of[r] for r in sorted(of)] for lang, of in sorted(profiles.items())}


def identify(
    docs: DataFrame,
    profiles: Profiles,
    text_col: str = "text",
    top: int = TOP,
    lang_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """``docs`` and, for every text, the language of the closest profile and a score.

    The score is 1 less the distance as a share of the largest one. ``und``
    with score 0: null, texts without a letter, or no profile at all. Of equal
    distances the language first by name counts. The two new columns replace
    columns of their names, in upper or lower case. Repeated rows are judged each.
    """
    ship_package(docs.sparkSession)
    langs = sorted(profiles)
    known = np.unique(np.array([c for p in profiles.values() for c in p], dtype=np.int64))
    # what is missing in a profile, and what no profile has, lies `top` away
    places = np.full((len(known) + 1, max(1, len(langs))), -1, dtype=np.int32)
    for k, lang in enumerate(langs):
        places[np.searchsorted(known, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def closest(text: str | None) -> tuple[str, float]:
        mine = ranked(ngram_codes(text), top) if text and langs else ()
        if not len(mine):
            return UNDETERMINED, 0.0
        at = np.searchsorted(known, mine)
        at = np.where(known[np.minimum(at, len(known) - 1)] == mine, at, len(known))
        theirs = places[at]
        apart = np.where(theirs < 0, top, np.minimum(np.abs(theirs - np.arange(len(mine))[:, None]), top))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return langs[best], float(1 - total[best] / (top * len(mine)))

    names = [c for c in docs.columns if c.lower() not in (lang_col.lower(), score_col.lower())]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    text_at = docs.select(clean_text(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [closest(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names[1:], "lang", "score"],
            )

    inner = [f"c{i} {field.dataType.simpleString()}" for i, field in enumerate(kept.schema.fields)]
    out = text_at.mapInArrow(released(task), ", ".join([*inner, "lang string", "score double"]))
    return out.toDF(*names, lang_col, score_col)


def learned_from(id_col: Column) -> Column:
    """Whether a document belongs to the three quarters that languages are learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 != 2
