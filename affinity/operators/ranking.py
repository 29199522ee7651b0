"""Row numbers, positions and running sums that never gather one group or the whole table.

A plain ``row_number`` puts each group, or with no partition the whole table, into one task.
Here a large group is split in buckets that agree with the sort order; rows are numbered
inside a bucket and the sizes of the earlier buckets are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import materialize

ROWS_PER_TASK = 500_000
MAX_HOT_GROUPS = 100_000


def hot_groups(
    df: DataFrame,
    keys: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    max_hot: int = MAX_HOT_GROUPS,
) -> DataFrame:
    """Groups too large for one task, with ``_rows`` and the number of ``_buckets`` to use.

    A group counts as hot above ``max(rows_per_task, rows / max_hot)`` rows, so there can be
    no more than ``max_hot`` of them and no more than ``2 * max_hot`` buckets: the result may
    be broadcast however large ``df`` is.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    cut = sizes.agg(
        F.greatest(
            F.lit(float(rows_per_task)),
            F.coalesce(F.sum("_rows"), F.lit(0)) / F.lit(float(max_hot)),
        ).alias("cut")
    ).scalar()
    return sizes.where(F.col("_rows") > cut).withColumn(
        "_buckets", F.ceil(F.col("_rows") / cut).cast("bigint")
    )


def number_in_groups(
    df: DataFrame,
    keys: list[str],
    position: Column,
    order: list[Column | str],
    number: str,
    total: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    max_hot: int = MAX_HOT_GROUPS,
    derived: dict[str, Column] | None = None,
) -> DataFrame:
    """1-based row number per group, and with ``total`` the group size.

    ``position`` is a double in [0, 1) that never falls along ``order`` (the leading digits
    of the sort hash, say): it places the rows of a hot group in buckets. ``derived`` columns,
    which ``order`` may use, are made where the rows of a group meet, so no shuffle carries them.
    """
    hot = materialize(hot_groups(df, keys, rows_per_task, max_hot), "hot")
    if hot.isEmpty():
        dealt = df.repartition(*keys).withColumns(derived) if derived else df
        return _number_plain(dealt, keys, order, number, total)
    df = df.withColumns(derived or {})
    tagged = df.join(F.broadcast(hot), keys, "left").withColumn(
        "_bucket",
        F.coalesce(F.floor(position * F.col("_buckets")), F.lit(0)).cast("bigint"),
    )
    slot = [*keys, "_bucket"]
    numbered = _number_plain(tagged.repartition(*slot), slot, order, "_nth", "_slot_rows")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        tagged.where(F.col("_buckets").isNotNull())
        .groupBy(*slot)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .drop("_n")
    )
    out = numbered.join(F.broadcast(offsets), slot, "left").withColumn(
        number, F.col("_nth") + F.coalesce("_before", F.lit(0))
    )
    if total:
        out = out.withColumn(total, F.coalesce("_rows", "_slot_rows"))
    return out.drop("_rows", "_buckets", "_bucket", "_nth", "_slot_rows", "_before")


def _number_plain(df, keys, order, number, total=None) -> DataFrame:
    group = Window.partitionBy(*keys)
    out = df.withColumn(number, F.row_number().over(group.orderBy(*order)).cast("bigint"))
    return out.withColumn(total, F.count("*").over(group)) if total else out


def _placed(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` range-partitioned and sorted, frozen with its partition and row position."""
    return materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright("_at", 33))


def _before_parts(sums: DataFrame, cols: list[str]) -> DataFrame:
    # one row per range partition: the window and the broadcast are bounded by their number
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "_part",
        *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_before_{c}") for c in cols],
    )


def dense_index(df: DataFrame, order: list, index: str) -> DataFrame:
    """0-based position of every row in a total order (``order`` must have no ties).

    ``monotonically_increasing_id`` carries the partition in the bits above 33 and the row
    within it below; the frozen table makes both repeatable.
    """
    placed = _placed(df, order, index)
    sums = placed.groupBy("_part").agg(F.count("*").alias("n"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(_before_parts(sums, ["n"])), "_part")
        .withColumn(index, (F.col("_before_n") + local).cast("bigint"))
        .drop("_part", "_at", "_before_n")
    )


def running_sums(df: DataFrame, order: list, cols: dict[str, str]) -> DataFrame:
    """Sum of ``column`` over all rows earlier in a total order, for each column -> output."""
    placed = _placed(df, order, "running")
    sums = placed.groupBy("_part").agg(*[F.sum(c).alias(c) for c in cols])
    w = (
        Window.partitionBy("_part")
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    out = placed.join(F.broadcast(_before_parts(sums, list(cols))), "_part")
    for column, output in cols.items():
        out = out.withColumn(
            output, F.col(f"_before_{column}") + F.coalesce(F.sum(column).over(w), F.lit(0))
        )
    return out.drop("_part", "_at", *[f"_before_{c}" for c in cols])


def best_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of each group, ranked from 1.

    Catalyst limits every group to ``k`` rows before the shuffle (``WindowGroupLimit``), so a
    hot group sends at most ``k`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
