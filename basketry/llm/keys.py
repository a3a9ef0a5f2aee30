"""A bounded filter of rows by key, before a shuffle join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 25


def maybe_held(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` may be in ``wanted`` (one column ``key``), and few others.

    The broadcast is a bit map of hashed keys, 4 MB whatever the input. Null keys go.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1
    bits = (wanted.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_map")))
    placed = rows.filter(F.col(key).isNotNull()).withColumn("_slot", slot).withColumns(
        {"_bucket": F.bitmap_bucket_number("_slot"), "_bit": F.bitmap_bit_position("_slot")})
    held = F.expr("shiftright(cast(conv(hex(substring(_map, cast(_bit div 8 as int) + 1, 1)), 16, 10)"
                  " as int), cast(_bit % 8 as int)) % 2 = 1")
    return (placed.join(F.broadcast(bits), "_bucket").filter(held)
            .select(*[F.col(f"`{c}`") for c in rows.columns]))
