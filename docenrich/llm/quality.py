"""A quality classifier learned from positives and unlabelled texts.

The network minimises the non-negative unbiased risk: the loss of trusted
positives, weighted by the class prior, plus what the unlabelled texts' loss
as negatives leaves when the positives' share of it is taken out, never less
than zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docenrich.cluster import ship_package
from docenrich.llm.common import clean_text, released
from docenrich.llm.textbytes import slices, word_bounds, word_hashes

#: Documents (on average, chosen by hash) that the classifier is fitted on.
SAMPLE_ROWS = 40_000
#: From this score on a document counts as good.
GOOD = 0.3

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"\n\r",
    b".,;:",
    b"!?",
    b"#$%&*@^~=+_",
    b"|/\\<>{}[]()",
    b"'\"`-",
    bytes(range(0x80, 0x100)),
]
_class_of = np.full(256, len(_CLASSES), dtype=np.uint8)
for _i, _bytes in enumerate(_CLASSES):
    _class_of[list(_bytes)] = _i
N_FEATURES = len(_CLASSES) + 12


def text_features(column: pa.Array) -> np.ndarray:
    """A row of numbers for every text: what its characters, words and lines are like."""
    out = np.zeros((len(column), N_FEATURES), dtype=np.float32)
    for first, data, offsets in slices(column):
        kinds = _class_of[data]
        sizes = np.diff(offsets)
        rows = np.arange(first, first + len(sizes))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        width = len(_CLASSES) + 1
        counts = np.bincount(doc * width + kinds, minlength=len(sizes) * width).reshape(-1, width)
        ink = np.maximum(counts[:, :-1].sum(axis=1), 1)
        out[rows, : len(_CLASSES)] = counts[:, :-1] / ink[:, None]
        starts, ends, at = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        lengths = ends - starts
        # a word's first byte and the kinds of its last and last but one
        upper = kinds[starts] == 1
        marked = (kinds[ends - 1] >= 5) & (kinds[ends - 1] <= 7)
        bare = marked & (lengths == 1)
        for k, row in enumerate(rows.tolist()):
            a, b = int(at[k]), int(at[k + 1])
            n = b - a
            if not n:
                continue
            own = words[a:b]
            _, times = np.unique(own, return_counts=True)
            pairs = np.unique(own[:-1] * np.uint64(31) + own[1:]) if n > 1 else own
            size = lengths[a:b]
            out[row, len(_CLASSES) :] = (
                np.log1p(n),
                size.mean(),
                size.std(),
                len(times) / n,
                np.log(len(times)) / np.log(n + 1),
                times.max() / n,
                len(pairs) / max(1, n - 1),
                (own[1:] == own[:-1]).mean() if n > 1 else 0,
                upper[a:b].mean(),
                marked[a:b].mean(),
                bare[a:b].mean(),
                n / (1 + counts[k, 3]) / 100,
            )
    return out


@dataclass(frozen=True)
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        z = np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, where only positives are labelled.

    In every direction of the features, and for every threshold, unlabelled
    texts are beyond it at least as often as the prior times positives are.
    """
    best = 1.0
    for k in range(positive.shape[1]):
        for sign in (1, -1):
            p, u = np.sort(sign * positive[:, k]), np.sort(sign * unlabelled[:, k])
            for share in (0.5, 0.7, 0.9):
                cut = p[int((1 - share) * (len(p) - 1))]
                above = 1 - np.searchsorted(u, cut, side="left") / len(u)
                best = min(best, above / (1 - np.searchsorted(p, cut, side="left") / len(p)))
    return float(np.clip(best, 0.05, 0.95))


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, units: int = 24, steps: int = 400, seed: int = 7
) -> Model:
    """Minimise the non-negative unbiased risk by full gradient steps."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    xp, xu = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    x = np.concatenate([xp, xu])
    n_p, n_u = len(xp), len(xu)
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], units)), np.zeros(units),
              rng.normal(0, 1 / np.sqrt(units), units), np.zeros(1)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        w1, b1, w2, b2 = params
        pre = x @ w1 + b1
        h = np.maximum(pre, 0)
        s = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30)))
        sp, su = s[:n_p], s[n_p:]
        negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        # slopes of the loss by the output; where the negative part is below zero, it is raised instead
        g = np.zeros(n_p + n_u)
        if negative >= 0:
            g[:n_p] = prior * (sp - 1) / n_p - prior * sp / n_p
            g[n_p:] = su / n_u
        else:
            g[:n_p] = prior * sp / n_p
            g[n_p:] = -su / n_u
        back = np.outer(g, w2) * (pre > 0)
        grads = [x.T @ back + 1e-4 * w1, back.sum(axis=0), h.T @ g + 1e-4 * w2, g.sum(keepdims=True)]
        for k, grad in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            params[k] = params[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
            )
    return Model(mean, scale, params[0], params[1], params[2], float(params[3][0]), prior)


def _features_of(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """The columns ``keep`` and the features, as an array."""
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(clean_text("text").alias("text"), *[c.alias(n) for c, n in zip(keep, names)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_features(batch.column(0)).astype(np.float64)
            values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], names=[*names, "features"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(released(task), f"{kinds}, features array<double>")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on about ``sample_rows`` of ``docs``, chosen by the hash of the id: half of
    them labelled, half not, as far as there are so many of either.

    Rows labelled 1 are the trusted positives, rows without label the unlabelled
    ones. Rows labelled 0 serve the class prior alone: the share of 1 among the
    labelled; without any it is estimated from positives and unlabelled. An id
    with different labels counts as unlabelled. Without positives or unlabelled
    rows there is nothing to fit, and every text with a word scores 0.5.
    """
    ship_package(docs.sparkSession)

    def chosen(rows: int) -> Column:
        share = min(1.0, sample_rows / 2 / max(1, rows))
        return F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40)) < int(share * (1 << 40))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marks = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("least"), F.max("label").alias("label"))
        .where("least = label")
        .select("doc_id", "label")
    )
    # about half of sample_rows ids, whatever the number of labels
    trusted = F.broadcast(marks.where(chosen(marks.count())))
    rows = rows.join(trusted, "doc_id", "left").where(F.col("label").isNotNull() | chosen(docs.count()))
    sample = _features_of(rows, [F.col("doc_id"), F.col("label")]).withColumnsRenamed({"k0": "doc_id", "k1": "label"})
    any_mark = marks.select("doc_id", F.lit(True).alias("marked"))
    found = (
        sample.join(any_mark, "doc_id", "left")
        .where("label IS NOT NULL OR marked IS NULL")
        .select("doc_id", "label", "features")
        .toPandas()
    )
    found = found.sort_values("doc_id", kind="stable")
    features = np.array(found["features"].tolist(), dtype=np.float64).reshape(-1, N_FEATURES)
    label = found["label"].to_numpy(dtype=np.float64, na_value=np.nan)
    positive, unlabelled = features[label == 1], features[np.isnan(label)]
    if not len(positive) or not len(unlabelled):
        none = np.zeros(N_FEATURES)
        return Model(none, none + 1, np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), 0.0, 0.5)
    negatives = int((label == 0).sum())
    prior = len(positive) / (len(positive) + negatives) if negatives else estimated_prior(positive, unlabelled)
    return fit(positive, unlabelled, prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; texts without a word (null too) have 0.

    The new column replaces one of its name, in upper or lower case. Repeated rows are
    scored each.
    """
    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() != score_col.lower()]
    rows = docs.select(clean_text(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = text_features(batch.column(0))
            found = np.where(features[:, len(_CLASSES)] > 0, model.scores(features), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], names=[*batch.schema.names[1:], "score"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    return rows.mapInArrow(released(task), ", ".join([*kinds, "score double"])).toDF(*names, score_col)


def held_out(id_col: Column) -> Column:
    """Whether a document belongs to the fifth that labels are not learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0
