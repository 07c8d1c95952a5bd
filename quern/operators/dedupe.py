"""Greedy rejection of duplicates by two keys, exact and distributed.

In the order of rows, a row is accepted unless an accepted earlier row has its left key or its right key. Two windows
would be wrong: a row that is itself rejected must not reject others. So acceptance is decided in rounds: a row that is
the earliest undecided one by both keys is accepted, and whoever shares a key with it is decided too. A round halves
what is undecided or better on usual data; the first one decides nearly all. Keys are counted by aggregation before
the shuffle, so a key that a third of all rows share is no burden to any task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import stored


def greedy(rows: DataFrame, order: str, left: str, right: str, registers: str | None = None) -> DataFrame:
    """order, verdict, of: for every row `accepted`, `left` or `right` (the key it shares; left first) or `unregistered`.

    `of` is the accepted row it repeats. `order` must be unique. Null keys are shared with nobody. Rows whose
    `registers` is false are compared with accepted rows before them but never accepted.
    """
    keys = rows.select(F.col(order).alias("o"), F.col(left).alias("l"), F.sha2(F.col(right), 256).alias("r"), (F.coalesce(F.col(registers), F.lit(False)) if registers else F.lit(True)).alias("reg"))
    keys = stored(keys, "dedupe-keys")
    candidates, accepted = keys.where("reg").drop("reg"), None
    # The first undecided row of all is decided in every round, so this ends.
    while True:
        least_left = candidates.where("l IS NOT NULL").groupBy("l").agg(F.min("o").alias("ol"))
        least_right = candidates.where("r IS NOT NULL").groupBy("r").agg(F.min("o").alias("or"))
        leading = candidates.join(least_left, "l", "left").join(least_right, "r", "left")
        now = stored(leading.where("coalesce(ol, o) = o AND coalesce(or, o) = o").select("o", "l", "r"), "dedupe-accepted")
        accepted = now if accepted is None else accepted.unionByName(now)
        # Whoever shares a key with an accepted row is decided; the others stay.
        rest = candidates.join(now.select("o"), "o", "left_anti").join(now.select("l").where("l IS NOT NULL"), "l", "left_anti").join(now.select("r").where("r IS NOT NULL"), "r", "left_anti")
        candidates = stored(rest.select("o", "l", "r"), "dedupe-rest")
        if candidates.isEmpty():
            break
    by_left = accepted.where("l IS NOT NULL").select("l", F.col("o").alias("al"))
    by_right = accepted.where("r IS NOT NULL").select("r", F.col("o").alias("ar"))
    found = keys.join(by_left, "l", "left").join(by_right, "r", "left")
    verdict = F.when((F.col("al") == F.col("o")) | (F.col("ar") == F.col("o")), "accepted").when(F.col("al") < F.col("o"), "left").when(F.col("ar") < F.col("o"), "right").when(F.col("reg"), "accepted").otherwise("unregistered")
    of = F.when(verdict == "left", F.col("al")).when(verdict == "right", F.col("ar"))
    return found.select(F.col("o").alias(order), verdict.alias("verdict"), of.alias("of"))


def first_by_fingerprint(rows: DataFrame, order: str, key: str) -> DataFrame:
    """order, first: for every row the earliest one with its key (itself if it is that)."""
    least = rows.groupBy(key).agg(F.min(order).alias("first"))
    return rows.select(order, key).join(least, key).select(order, "first")
