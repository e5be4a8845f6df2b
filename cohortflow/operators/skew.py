"""Joins whose hot keys are known beforehand.

A frequent-items sketch over the large side finds the keys that own more than a share of
its rows; only those keys are salted.  The result is the plain equi-join's, so a key that
the sketch misses or names wrongly costs time, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on; at most 2 / SHARE keys can be named.
SHARE = 0.01
_SALT = "_join_salt"


def _key(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: list[str], share: float = SHARE) -> list[int]:
    """Hashes of the keys that own about ``share`` of the rows or more.

    One pass, one sketch a task (Spark's ``approx_top_k``); at most ``2 / share`` numbers
    reach the driver.  Null keys match nothing in a join and are left out.
    """
    most = max(1, int(2 / share))
    rows = df.filter(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()).select(_key(keys).alias("k"))
    tracked = 1 << max(4, (8 * most - 1).bit_length())  # the sketch takes a power of two
    top = F.expr(f"approx_top_k(k, {most}, {tracked})")
    found = rows.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"])


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: list[int], salts: int | None = None, how: str = "inner") -> DataFrame:
    """``left.join(right, keys)``, where the rows of heavy keys are dealt to ``salts`` tasks.

    ``left`` is the large side.  Its heavy rows get a running salt; the right rows of heavy
    keys are copied once per salt, all others stay as they are.  ``how``: inner, left,
    left_semi or left_anti (kinds that keep or drop left rows one by one).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how!r}")
    if not heavy:
        return left.join(right, keys, how)
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _key(keys).isin(heavy)
    zero = F.lit(0).cast("bigint")
    dealt = left.withColumn(_SALT, F.when(hot, F.monotonically_increasing_id() % F.lit(salts)).otherwise(zero))
    copies = F.when(hot, F.sequence(zero, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(zero))
    copied = right.withColumn(_SALT, F.explode(copies))
    return dealt.join(copied, [*keys, _SALT], how).drop(_SALT)
