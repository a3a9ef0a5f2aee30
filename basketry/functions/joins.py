"""Join helpers with an explicit size check before broadcasting; a union that keeps its layout."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many rows a side is joined by shuffle instead of broadcast. Meant
# for rows of a few dozen bytes (integer ids, a double): about 64 MB.
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, n_rows: int | None = None,
                       max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    ``n_rows`` is the known row count or a proven bound of it; when absent the
    side is counted, so only pass cheap frames (a checkpointed table). Beyond
    ``max_rows`` the frame is returned unhinted and the planner shuffles (AQE
    may still switch to a broadcast at run time if it turns out small).
    """
    n = df.count() if n_rows is None else n_rows
    return F.broadcast(df) if n <= max_rows else df


def union_on(frames: list[DataFrame], key: str, name: str = "_key") -> DataFrame:
    """The frames' rows by column name, with ``key`` called ``name``.

    A union of frames that are all partitioned by their key stays partitioned
    by it only if the key columns are alike, which columns of different tables
    are not until they are renamed.
    """
    return reduce(DataFrame.unionByName, [f.withColumnRenamed(key, name) for f in frames])


def dealt(df: DataFrame, keys: str | list[str], n_rows: int, rows_per_part: int) -> DataFrame:
    """``df`` in partitions of whole keys and about ``rows_per_part`` rows.

    As it is while the session's shuffle partitions hold no more than that each.
    """
    parts = math.ceil(n_rows / rows_per_part)
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [keys] if isinstance(keys, str) else keys
    return df.repartition(parts, *keys) if parts > few else df
