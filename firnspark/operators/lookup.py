"""Join of a large frame with a small one on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``small`` has few enough rows of at most ``row_bytes`` bytes.

    Counts the frame, so call it on a stored or materialised one.
    """
    return small.count() * row_bytes <= limit


def lookup_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    row_bytes: int = 256,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join on ``keys``, unique in ``small``, without gathering a hot key in one task.

    A stored or materialised small side of checked size is broadcast.  Beyond that both sides
    are shuffled as they are, so AQE splits the partition of a hot key into as many tasks as
    its size asks for.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    return large.join(F.broadcast(small) if fits_broadcast(small, row_bytes, limit) else small, keys, how)


def within(df: DataFrame, wanted: DataFrame, keys: list[str], row_bytes: int = 96) -> DataFrame:
    """Rows of ``df`` whose keys are among the materialised ``wanted`` ones.

    One plan for requests of any size: the range of the wanted values is a constant that prunes
    folders and row groups, and the semi join prunes the folders in between at run time.
    """
    ends = [f(k) for k in keys for f in (F.min, F.max)]
    bounds = list(wanted.agg(*ends).first())
    if None in bounds:
        return df.where(F.lit(False))
    inside = F.lit(True)
    for i, key in enumerate(keys):
        inside = inside & F.col(key).between(F.lit(bounds[2 * i]), F.lit(bounds[2 * i + 1]))
    return lookup_join(df.where(inside), wanted.where(inside).select(*keys), keys, "left_semi", row_bytes)
