"""A filter that tells which paths are surely not in a large set.

A Bloom filter in blocks of one long: a path has one block and four bits in it. It
is built by an aggregate (each task ors its own blocks first) and probed by a map
join with its blocks, whose number is bounded. A path whose bits are not all set is
not in the set; of the others a few per cent are not either.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter of so many blocks is about 32 MB on each executor.
MAX_BLOCKS = 1 << 20
#: Paths for each block at most; a fuller filter would tell too little.
PATHS_PER_BLOCK = 8
_BITS = 4


def block_count(paths: int, max_blocks: int = MAX_BLOCKS) -> int:
    """Blocks for a number of paths; 0 if these are too many (or none), and no filter is to be had."""
    if not 0 < paths <= max_blocks * PATHS_PER_BLOCK:
        return 0
    return min(max_blocks, 1 << math.ceil(math.log2(max(paths / PATHS_PER_BLOCK * 2, 1))))


def path_key(path: Column, n_blocks: int) -> tuple[Column, Column]:
    """The block of a path, and its bits there."""
    which = F.xxhash64(path, F.lit("bits"))
    bits = F.lit(0).cast("long")
    for k in range(_BITS):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(which, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(F.xxhash64(path), F.lit(n_blocks).cast("long")), bits


def path_blocks(df: DataFrame, n_blocks: int, path_col: str = "file_path") -> DataFrame:
    """``(block, bits)`` of the paths of a table: ``n_blocks`` rows at most."""
    block, bits = path_key(F.col(path_col), n_blocks)
    return df.select(block.alias("block"), bits.alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("bits"))


def add_blocks(blocks: DataFrame, more: DataFrame) -> DataFrame:
    """The filter over both sets, of filters with the same number of blocks."""
    return blocks.unionByName(more).groupBy("block").agg(F.bit_or("bits").alias("bits"))
