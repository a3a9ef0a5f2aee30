"""Reusable column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_order_key(seed: int, *cols: str) -> Column:
    """Reproducible pseudo-random order: md5 of ``'<seed>:<c1>:<c2>...'``.

    Identical hex text in Spark and DuckDB, so the oracle can reproduce every
    random choice (hold-out, cohort sample).
    """
    parts = [F.lit(f"{seed}")]
    for c in cols:
        parts += [F.lit(":"), F.col(c).cast("string")]
    return F.md5(F.concat(*parts))


def n_holdout(n: Column, ratio: float) -> Column:
    """Test-fold size per user: ``max(1, int(n * ratio))``."""
    return F.greatest(F.lit(1).cast("bigint"),
                      F.floor(n.cast("double") * F.lit(float(ratio))).cast("bigint"))


def confidence(count: Column, alpha: float) -> Column:
    """Implicit-feedback confidence ``1 + alpha * count``."""
    return F.lit(1.0) + F.lit(float(alpha)) * count.cast("double")


def discount(rank: Column) -> Column:
    """DCG gain of a hit at 1-based ``rank``: ``1 / log2(rank + 1)``."""
    return F.lit(1.0) / F.log2(rank.cast("double") + F.lit(1.0))


def r6(c: Column | str) -> Column:
    """Round a published double to six places."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6)


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of ``x`` among ``bins`` equal bins over [lo, hi].

    The right edge falls into the last bin. A constant sample (``lo == hi``)
    spans [lo - 0.5, hi + 0.5] like the usual histogram convention.
    """
    lo2 = F.when(lo == hi, lo - F.lit(0.5)).otherwise(lo)
    hi2 = F.when(lo == hi, hi + F.lit(0.5)).otherwise(hi)
    width = (hi2 - lo2) / F.lit(float(bins))
    raw = F.floor((x - lo2) / width).cast("bigint")
    return F.least(F.greatest(raw, F.lit(0).cast("bigint")), F.lit(bins - 1).cast("bigint"))


def round_half_up(c: Column | str, places: int) -> Column:
    """``floor(x · 10^p + 0.5) / 10^p`` — the same IEEE steps in every engine,
    unlike ``round``, which may round the decimal text or the binary value."""
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** places)
    return F.floor(col.cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
