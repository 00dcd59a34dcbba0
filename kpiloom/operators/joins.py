"""Join helpers that keep hot or null keys from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           row_id: Column | str | None = None, how: str = "left") -> DataFrame:
    """``left LEFT [ANTI] JOIN right ON left_key = right_key``, null keys spread out.

    Null join keys all hash to one shuffle partition, yet never match. Rows
    whose key is null get as salt a 64-bit hash of ``row_id`` (default: of the
    whole row), never 0, so they spread without bound; matchable rows get 0, which is also the right
    side's only salt. The join is still a plain equi-join (on key and salt),
    so Spark picks broadcast or shuffle by measured size; the right side's
    ``right_key`` column is dropped. ``how`` is ``"left"`` or ``"left_anti"``.
    """
    if row_id is None:
        rid = F.xxhash64(*[F.col(c) for c in left.columns])
    else:
        rid = F.col(row_id) if isinstance(row_id, str) else row_id
    salt = F.when(F.col(left_key).isNull(), F.xxhash64(rid).bitwiseOR(F.lit(1))) \
        .otherwise(F.lit(0).cast("long"))
    lk, rk = "__jk", "__js"
    l2 = left.withColumns({rk: salt, lk: F.col(left_key)})
    r2 = right.withColumn(rk, F.lit(0).cast("long")).withColumnRenamed(right_key, lk)
    return l2.join(r2, [lk, rk], how).drop(lk, rk)
