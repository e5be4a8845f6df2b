"""Global order operations without a single-partition window.

A window with no PARTITION BY (running sum over all rows, row_number over a
global order) moves every row into one task.  Here the rows are range
partitioned on the order key instead, each partition computes its local
running sum, and a table of per-partition totals (one row per partition, so
bounded by the partition count, not by the data) supplies the offset of each
partition.  The result is exact.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.session import materialize


def _range_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def prefix_sums(
    df: DataFrame,
    order_cols: list,
    value_cols: list[str],
    out_suffix: str = "_cum",
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_cols``.

    ``order_cols`` must give a total order (ties would make the running sum
    depend on the row order inside a tie).  Columns ``<v><out_suffix>`` are
    added.  The input is checkpointed once so the partition tag stays fixed
    between the totals pass and the running pass, also after an executor loss.
    """
    return _running(df, order_cols, value_cols, out_suffix, num_partitions)[0]


def _running(df: DataFrame, order_cols: list, value_cols: list[str], out_suffix: str, num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Running sums, and the stage table they read (the input, range-partitioned)."""
    n = _range_parts(df, num_partitions)
    # The range partitioner samples its input first: hold the input so the
    # sample and the shuffle read it once.
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tagged = materialize(held.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()))
    finally:
        held.unpersist()
    totals = tagged.groupBy("_pid").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    # Bounded by the number of partitions: safe to order in one task and broadcast.
    w_off = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in value_cols]
    )
    w_local = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select(
        "*", *[F.sum(v).over(w_local).alias(f"_l_{v}") for v in value_cols]
    )
    out = local.join(F.broadcast(offsets), "_pid")
    for v in value_cols:
        out = out.withColumn(f"{v}{out_suffix}", F.col(f"_l_{v}") + F.col(f"_o_{v}"))
    drop = ["_pid"] + [f"_l_{v}" for v in value_cols] + [f"_o_{v}" for v in value_cols]
    return out.drop(*drop), tagged


def grouped_prefix_sums(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list,
    value_cols: list[str],
    out_suffix: str = "_cum",
    num_partitions: int | None = None,
) -> DataFrame:
    """Running sums that restart for every group (e.g. per split)."""
    return grouped_running(df, group_cols, order_cols, value_cols, out_suffix, num_partitions)[0]


def grouped_running(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list,
    value_cols: list[str],
    out_suffix: str = "_cum",
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Running sums per group, and each group's totals (``<v>_total``).

    One global pass over (group, order); the totals of the groups before a
    group are subtracted.  Totals come from the pass's own stage table, so the
    input is evaluated once.  One row per group: callers use few groups (splits).
    """
    order = [F.col(g) for g in group_cols] + list(order_cols)
    out, tagged = _running(df, order, value_cols, out_suffix, num_partitions)
    totals = tagged.groupBy(*group_cols).agg(*[F.sum(v).alias(f"{v}_total") for v in value_cols])
    if not group_cols:
        return out, totals
    totals = materialize(totals)
    before = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*group_cols, *[F.coalesce(F.sum(f"{v}_total").over(before), F.lit(0)).alias(f"_b_{v}") for v in value_cols])
    out = out.join(F.broadcast(base), group_cols)
    for v in value_cols:
        out = out.withColumn(f"{v}{out_suffix}", F.col(f"{v}{out_suffix}") - F.col(f"_b_{v}"))
    return out.drop(*[f"_b_{v}" for v in value_cols]), totals


def global_index(df: DataFrame, order_cols: list, name: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``."""
    one = "_one_for_index"
    out = prefix_sums(df.withColumn(one, F.lit(1).cast("bigint")), order_cols, [one], num_partitions=num_partitions)
    return out.withColumn(name, (F.col(f"{one}_cum") - 1).cast("bigint")).drop(one, f"{one}_cum")
