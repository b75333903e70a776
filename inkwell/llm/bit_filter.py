"""A filter of bounded size for the keys of another table, so that a large side need not be shuffled to be reduced."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least and most bits of the filter, as powers of two, and bits a key between these: 1 to 128 MB are broadcast.
LEAST_BITS, MOST_BITS, BITS_A_KEY = 23, 30, 16


def bits_for(n_keys: int) -> int:
    """The power of two of the filter's bits: up to 67 million keys one row in 16 passes without need."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, n_keys) * BITS_A_KEY - 1).bit_length()))


def bit_filter(keys: DataFrame, columns: list[str], n_keys: int) -> Callable[[DataFrame], DataFrame]:
    """A function that keeps the rows of a table whose key may be among ``keys``.

    ``n_keys`` is about their number. No row with a key in ``keys`` is dropped; others pass with the share of set bits as probability, so the result must be
    joined with the keys where that matters. Keys with nulls are hashed like others. No keys: no row passes.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << bits_for(n_keys)).cast("bigint"))
    table = (
        keys.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("_bucket_no"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))
    )

    def keep(df: DataFrame) -> DataFrame:
        placed = df.withColumn("_place_of_key", place)
        at = F.bitmap_bit_position("_place_of_key")
        byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.getbit(byte, (at % 8).cast("int")) == 1
        joined = placed.join(F.broadcast(table), F.bitmap_bucket_number("_place_of_key") == F.col("_bucket_no"))
        return joined.where(bit).select(*[df[c] for c in df.columns])

    return keep
