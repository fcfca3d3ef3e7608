"""Embedding near-duplicates by rotated binary codes with correction factors.

A unit vector, randomly rotated, is stored once as a code: the signs of its
components and one number, its inner product with the scaled signs; and, for
asking, the components rounded to four bits, as four planes of bits. Signs of one
vector and planes of another give, by counting common bits, an unbiased estimate of
their cosine, and the number bounds its error. Only vectors that have a partner
whose upper bound reaches the threshold, both ways, are fetched and computed exactly.

Signs of several rotations also deal the codes to buckets, a table for each
run of signs, so that vectors are compared with those of their buckets alone.
Large buckets are cut into blocks that are compared two by two. A task returns
a row for each vector, not for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.llm.common import Workspace, connected_components

THRESHOLD = 0.93
#: Two vectors at the threshold share one bucket at least with a probability of 0.9998.
TABLES = 20
BITS = 8
#: Vectors in a block of a bucket, on average at most.
BLOCK = 512
#: Bits of a rounded component.
_PLANES = 4
_LEVELS = (1 << _PLANES) - 1
_BATCH_ROWS = 8192
#: Cosines that differ by less are not told apart by a product of matrices.
_CLOSE = 1e-12
#: Half width of the confidence interval, in standard errors.
SIGMAS = 4.0
_SEED = 20


@lru_cache(64)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix; the same on every worker."""
    rng = np.random.default_rng([_SEED, dim, number])
    q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def bucket_numbers(units: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """For every vector its bucket in each table: runs of signs from as many rotations as it takes."""
    dim = units.shape[1]
    signs = [units @ rotation(dim, 1 + k) >= 0 for k in range(-(-tables * bits // dim))]
    runs = np.concatenate(signs, axis=1)[:, : tables * bits].reshape(len(units), tables, bits)
    return runs @ (1 << np.arange(bits))


def codes(units: np.ndarray) -> np.ndarray:
    """The code of each vector, as bytes: signs, four planes, and what estimates need."""
    n, dim = units.shape
    turned = units @ rotation(dim, 0)
    words = -(-dim // 64)
    factor = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / _LEVELS, 1e-300)
    # rounded up or down by the same random numbers everywhere, so that errors even out
    dither = np.random.default_rng([_SEED, dim]).random(dim)
    levels = np.floor((turned - low[:, None]) / step[:, None] + dither).clip(0, _LEVELS).astype(np.uint8)
    bits = np.zeros((n, 1 + _PLANES, words * 64), dtype=np.uint8)
    bits[:, 0, :dim] = turned >= 0
    for j in range(_PLANES):
        bits[:, 1 + j, :dim] = levels >> j & 1
    packed = np.packbits(bits, axis=2, bitorder="little").reshape(n, -1)
    facts = np.stack([low, step, turned.sum(axis=1), factor], axis=1)
    return np.concatenate([packed, np.ascontiguousarray(facts).view(np.uint8)], axis=1)


def code_bounds(asking: np.ndarray, asked: np.ndarray, dim: int) -> np.ndarray:
    """Upper confidence bounds of the cosines, from the planes of ``asking`` and the signs of ``asked``."""
    words = -(-dim // 64)
    split = lambda c: (
        np.ascontiguousarray(c[:, : -32]).view(np.uint64).reshape(len(c), 1 + _PLANES, words),
        np.ascontiguousarray(c[:, -32:]).view(np.float64),
    )
    (planes, mine), (signs, theirs) = split(asking), split(asked)
    common = np.zeros((len(asking), len(asked)), dtype=np.float32)
    for j in range(_PLANES):
        count = np.zeros(common.shape, dtype=np.uint16)
        for w in range(words):
            count += np.bitwise_count(planes[:, 1 + j, w, None] & signs[None, :, 0, w])
        common += count * np.float32(1 << j)
    low, step, total, _ = mine.T
    factor = theirs[:, 3]
    ones = np.bitwise_count(signs[:, 0]).sum(axis=1)
    inner = (2 * (low[:, None] * ones + step[:, None] * common) - total[:, None]) / np.sqrt(dim)
    # of the signs, and of the rounding
    error = np.maximum(1 - factor**2, 0) / max(1, dim - 1) + (step[:, None] / 2) ** 2
    return (inner + SIGMAS * np.sqrt(error)) / factor


def upper_bounds(units: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper confidence bounds of the cosines, from the codes alone."""
    return code_bounds(codes(units), codes(others), units.shape[1])


def candidates(left: np.ndarray, right: np.ndarray, dim: int, threshold: float) -> np.ndarray:
    """Which pairs of codes may be at the threshold; of a block with itself, each pair once."""
    near = (code_bounds(left, right, dim) >= threshold) & (code_bounds(right, left, dim).T >= threshold)
    return np.triu(near, 1) if left is right else near


def linked_pairs(units: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i in left, j in right, i < j if both are the same) with a cosine at the threshold or above."""
    cosines = units[left] @ units[right].T
    near = cosines >= threshold - _CLOSE
    if left is right:
        near = np.triu(near, 1)
    a, b = np.nonzero(near)
    i, j = left[a], right[b]
    exact = cosines[a, b] >= threshold + _CLOSE
    # so close to the threshold that the order of sums could matter: one by one
    close = np.flatnonzero(~exact)
    exact[close] = np.einsum("ij,ij->i", units[i[close]], units[j[close]]) >= threshold
    return i[exact], j[exact]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists that all have ``dim`` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _coded(tables: int, bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                units = unit(_matrix(some.column("vector"), dim))
                found = bucket_numbers(units, tables, bits)
                numbers = pa.FixedSizeListArray.from_arrays(pa.array(found.astype(np.int32).ravel()), tables)
                yield pa.RecordBatch.from_arrays(
                    [some.column("node"), some.column("label"), some.column("times"),
                     pa.array([dim] * len(units), pa.int32()), some.column("vector"), numbers.cast(pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes(units)], pa.binary())],
                    names=["node", "label", "times", "dim", "vector", "buckets", "code"],
                )

    return task


_KEY = ("label", "dim", "table", "bucket", "low", "high")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block or pair of blocks that has more than one, from sorted batches."""
    held: list[pa.RecordBatch] = []
    at = None

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in _KEY]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            here = tuple(c[a] for c in columns)
            if here != at:
                if sum(h.num_rows for h in held) > 1:
                    yield whole()
                held, at = [], here
            # most buckets have one vector: it is kept only if more may follow
            if b - a > 1 or held or b == batch.num_rows:
                held.append(batch.slice(a, b - a))
    if sum(h.num_rows for h in held) > 1:
        yield whole()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _BATCH_ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _sides(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the two blocks of a group; one array if it is one block."""
    of = group.column("block").to_numpy()
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    left = np.flatnonzero(of == low)
    return left, left if low == high else np.flatnonzero(of == high)


def _choose(threshold: float):
    """The rows whose code has another one in its group that may be at the threshold."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(rows(batches))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            left, right = _sides(group)
            if not len(left) or not len(right):
                continue
            code = np.frombuffer(b"".join(group.column("code").to_pylist()), dtype=np.uint8).reshape(group.num_rows, -1)
            mine = code[left]
            near = candidates(mine, mine if left is right else code[right], group.column("dim")[0].as_py(), threshold)
            chosen = np.union1d(left[near.any(axis=1)], right[near.any(axis=0)])
            if len(chosen):
                yield group.drop_columns(["code"]).take(pa.array(chosen))

    return task


_OUT = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _compare(threshold: float):
    """For the vectors of a group that link: vectors linked to, first seen in this table, and a common node."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(rows(batches))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            left, right = _sides(group)
            if not len(left) or not len(right):
                continue
            units = unit(_matrix(group.column("vector"), group.column("dim")[0].as_py()))
            i, j = linked_pairs(units, left, right, threshold)
            if not len(i):
                continue
            table = group.column("table")[0].as_py()
            buckets = _matrix(group.column("buckets"), len(group.column("buckets")[0]))
            # a pair counts in the first table that brings it together
            first = np.ones(len(i), dtype=bool)
            for earlier in range(table):
                first &= buckets[i, earlier] != buckets[j, earlier]
            times = group.column("times").to_numpy()
            links = np.zeros(group.num_rows, dtype=np.int64)
            np.add.at(links, i[first], times[j[first]])
            np.add.at(links, j[first], times[i[first]])
            nodes = group.column("node").to_numpy()
            root = nodes.copy()
            while True:
                before = root.copy()
                np.minimum.at(root, i, root[j])
                np.minimum.at(root, j, root[i])
                if (root == before).all():
                    break
            some = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (nodes, links, root)], schema=_OUT)

    return task


def near_vectors(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    bits: int = BITS,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows link when their labels are equal and not null and the cosine of their
    vectors, computed in doubles, is at least ``threshold``; vectors of
    different length, null or empty ones, zero vectors and those with a null or
    non-finite component link with nothing. ``n_links`` counts rows, so equal
    vectors count each other. ``component_id`` is the smallest id reachable.
    Rows that repeat an id are rows of their own. Empty in, empty out; other
    columns are not looked at.
    """
    work = Workspace(embeddings.sparkSession, "vectors")
    vector = F.col(vector_col).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        vector, lambda x: x != 0
    )
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.when(F.coalesce(sound, F.lit(False)) & F.col(label_col).isNotNull(), vector).alias("vector"),
    ).withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    places = work.save(rows.select("vec_id", "node"), "places")
    classes = (
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.count("*").alias("times"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    placed = work.save(
        classes.mapInArrow(
            _coded(tables, bits),
            "node long, label string, times long, dim int, vector array<double>, buckets array<int>, code binary",
        ),
        "classes",
    )
    where = ["label", "dim", "table", "bucket"]
    spots = placed.select("node", "label", "dim", "code", F.posexplode("buckets").alias("table", "bucket"))
    large = spots.groupBy(*where).agg(F.count("*").alias("size")).where(F.col("size") > block)
    large = work.save(large.select(*where, F.ceil(F.col("size") / block).cast("int").alias("blocks")), "large")
    dealt = spots.join(large, where, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *where, "node", "code", "block",
        F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
    )
    # codes alone go to the buckets, and vectors only where codes leave it open
    chosen = dealt.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        _choose(threshold), "label string, dim int, table int, bucket int, node long, block int, low int, high int"
    )
    chosen = work.save(chosen, "chosen")
    fetched = chosen.join(placed.select("node", "times", "vector", "buckets"), "node")
    found = fetched.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        _compare(threshold), "node long, links long, root long"
    )
    found = work.save(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), work)
    named = (
        placed.select("node", "times")
        .join(links, "node", "left")
        .join(comps, "node", "left")
        .select("node", F.coalesce("component", "node").alias("comp"),
                (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    joined = work.save(places.join(named, "node", "left"), "joined")
    work.drop(placed, large, chosen, found, places)
    # written, so that a large component can be split when it is joined
    firsts = work.save(joined.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("component_id")), "firsts")
    return (
        joined.join(firsts, "comp", "left")
        .withColumn("component_id", F.coalesce("component_id", "vec_id"))
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                (F.col("vec_id") == F.col("component_id")).alias("kept"))
    )
