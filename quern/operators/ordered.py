"""What depends on the order of rows within a key, without ever gathering a whole key in one task.

A window partitioned by a key alone gives all rows of a hot key to one task. Here the rows are first range-partitioned by
key and order, and each partition is a range: so ranges hold about as many rows as a task should have, however the
order column is spread. Windows run within (key, range), and what earlier or later ranges contribute comes from a table
with one row for each key in each range; only that table is windowed by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import stored


def ranged(df: DataFrame, key: list[str], order: str, name: str = "ranged") -> DataFrame:
    """The frame with `_range`, the number of the partition of each row when partitioned by ranges of (key, order).

    It is written, as the boundaries are sampled and must not change between two uses. A frame that has `_range` already
    stays as it is: ranges by (key, order) also serve any finer key whose rows lie together.
    """
    if "_range" in df.columns:
        return df
    return stored(df.repartitionByRange(*key, order).withColumn("_range", F.spark_partition_id()), name)


def _joined(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Rows with their range's row of the table; keys may be null."""
    names = [*key, "_range"]
    renamed = table.select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)], *[c for c in table.columns if c not in names])
    condition = [F.col(n).eqNullSafe(F.col(f"_k{i}")) for i, n in enumerate(names)]
    return rows.join(renamed, condition).drop(*[f"_k{i}" for i in range(len(names))])


def along(df: DataFrame, key: list[str], order: str, sums: dict[str, Column] | None = None, carry: dict[str, Column] | None = None, forward: bool = True, current: bool = True) -> DataFrame:
    """Adds running sums and carried values in one pass. `order` is unique within the key.

    sums: the sum of the value over the rows of the key up to and including this one. carry: the latest value that is not
    null before this row (forward) or the first after it (backward); with `current` this row's own value comes first.
    """
    sums, carry = sums or {}, carry or {}
    marked = ranged(df, key, order)
    marked = marked.select("*", *[v.alias(f"_s_{n}") for n, v in sums.items()], *[v.alias(f"_v_{n}") for n, v in carry.items()])
    pick, ends = (F.last, F.max_by) if forward else (F.first, F.min_by)
    edge = marked.groupBy(*key, "_range").agg(
        *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums], *[ends(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(f"_v_{n}") for n in carry]
    )
    # At most one row for each range of the key.
    across = Window.partitionBy(*key).orderBy("_range")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    beyond = before if forward else across.rowsBetween(1, Window.unboundedFollowing)
    edge = edge.select(*key, "_range", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums], *[pick(f"_v_{n}", ignorenulls=True).over(beyond).alias(f"_o_{n}") for n in carry])
    within = Window.partitionBy(*key, "_range").orderBy(order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if forward:
        inner = within.rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    else:
        inner = within.rowsBetween(Window.currentRow if current else 1, Window.unboundedFollowing)
    inside = marked.select("*", *[F.sum(f"_s_{n}").over(upto).alias(f"_i_{n}") for n in sums], *[pick(f"_v_{n}", ignorenulls=True).over(inner).alias(f"_c_{n}") for n in carry])
    joined = _joined(inside, edge, key)
    total = [(F.col(f"_b_{n}") + F.coalesce(f"_i_{n}", F.lit(0))).alias(n) for n in sums]
    return joined.select(*[c for c in marked.columns if not c.startswith(("_s_", "_v_")) and c not in (*sums, *carry)], *total, *[F.coalesce(f"_c_{n}", f"_o_{n}").alias(n) for n in carry])


def running_sum(df: DataFrame, name: str, value: Column, key: list[str], order: str) -> DataFrame:
    """Adds the sum of `value` over the rows of the key up to and including this one. `order` is unique within the key."""
    return along(df, key, order, sums={name: value}).drop("_range")


def carried(df: DataFrame, values: dict[str, Column], key: list[str], order: str, forward: bool = True, current: bool = True) -> DataFrame:
    """Adds, for each name, the latest value that is not null before this row (forward) or the first after it (backward)."""
    return along(df, key, order, carry=values, forward=forward, current=current).drop("_range")


def positions(df: DataFrame, by: list[Column], name: str = "position") -> DataFrame:
    """Adds the place of each row, from 1, in the order of all rows by `by`, which tells rows apart; no task sorts them all."""
    names = [f"_by{i}" for i in range(len(by))]
    parted = stored(df.select("*", *[b.alias(n) for b, n in zip(by, names)]).repartitionByRange(*names).withColumn("_range", F.spark_partition_id()), "positions")
    # One row for each partition.
    counts = parted.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select(F.col("_range").alias("_r"), (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = parted.withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*names)))
    return inside.join(before, F.col("_range") == F.col("_r")).select(*df.columns, (F.col("_before") + F.col("_in")).alias(name))


def first_rows(df: DataFrame, key: list[str], by: list[Column], keep: list[str]) -> DataFrame:
    """One row for each key, the first by `by`: aggregated before the shuffle, so a hot key costs nothing."""
    least = F.min(F.struct(*[b.alias(f"_b{i}") for i, b in enumerate(by)], F.struct(*keep).alias("_kept")))
    return df.groupBy(*key).agg(least.alias("_m")).select(*key, "_m._kept.*")


def first_n(df: DataFrame, key: list[str], order: str, n: int) -> DataFrame:
    """The first `n` rows of each key. The planner limits the groups before the shuffle too, so that of a hot key only `n`
    rows of each task are sent on."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where(F.col("_n") <= n).drop("_n")
