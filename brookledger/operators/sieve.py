"""A Bloom filter of a small side, applied to a large one before its shuffle."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block (what a bitmap aggregate holds), bits set for a key, keys of a block: about one wrong guess in 100.
BLOCK_BITS, BITS_PER_KEY, KEYS_PER_BLOCK = 32_768, 5, 3_000
#: Largest filter that is sent to every executor: keys of some 48 million rows.
MAX_BYTES = 64 << 20
_BLOCK, _WORDS = "_sieve_block", "_sieve_words"


def _place(key: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(f"place-{k}")), F.lit(BLOCK_BITS)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row a block: its number and its bits as 512 words of 64; null keys are left out.

    All bits of a key lie in one block, so a key is looked up by an equi-join.
    The bits are set in one aggregate, map side first.
    """
    value = F.col(key)
    bits = keys.where(value.isNotNull()).select(
        _block(value, blocks).alias(_BLOCK),
        F.explode(F.array(*[_place(value, k) for k in range(BITS_PER_KEY)])).alias("_place"),
    ).groupBy(_BLOCK).agg(F.bitmap_construct_agg("_place").alias("_bits"))
    word = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)),
        lambda i: F.conv(F.hex(F.substring(F.col("_bits"), i * 8 + 1, F.lit(8))), 16, -10).cast("long"),
    )
    return bits.select(_BLOCK, word.alias(_WORDS))


def _is_set(place: Column) -> Column:
    # Byte p / 8 of the bitmap holds place p as its bit p % 8; a word has eight bytes, the first one highest.
    bit = F.lit(56) - F.shiftright(place % 64, 3) * 8 + place % 8
    return F.getbit(F.get(F.col(_WORDS), F.shiftright(place, 6)), bit) == 1


def may_match(large: DataFrame, key: str, small: DataFrame, small_key: str, *, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``large`` whose key may occur in ``small``: all that do, and about one in 100 of the others.

    Rows with a null key go. For a join in which unmatched rows of ``large``
    have no part, such as an inner join or the right side of a left or anti
    join: it moves this instead of the whole. ``small`` is counted first and
    read again for its filter: pass a stored table. A filter above
    ``max_bytes`` is not made; ``large`` is then returned as it is.
    """
    blocks = max(1, math.ceil(small.count() / KEYS_PER_BLOCK))
    if blocks * BLOCK_BITS // 8 > max_bytes:
        return large
    value = F.col(key)
    held = [_is_set(_place(value, k)) for k in range(BITS_PER_KEY)]
    same_block = _block(value, blocks) == F.col(_BLOCK)
    # At most max_bytes, checked above.
    return large.join(
        F.broadcast(bloom_filter(small.select(F.col(small_key).alias("_sieve_key")), "_sieve_key", blocks)),
        reduce(and_, held, same_block), "left_semi")
