"""Sets of keys as bitmaps of bounded size, by which large rows are told apart without being shuffled.

A bitmap only ever lets too much through, never too little: what it lets through is settled exactly afterwards. It has
16 places for each key up to 2^27 places (2 million broadcast rows of two numbers, about 80 MB); beyond 8 million keys
it fills up, so that more rows are settled the exact way, with the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import stored

#: Most and fewest words of 64 places, as powers of two.
MOST_BITS, LEAST_BITS = 21, 6


class Marks:
    """The bitmap of a column of 64-bit keys; the keys are counted first, by one pass over their (stored) table."""

    def __init__(self, keys: DataFrame, column: str) -> None:
        count = keys.count()
        self.bits = min(MOST_BITS, max(LEAST_BITS, (count // 4).bit_length()))
        word, bit = self._place(column)
        self.table = keys.selectExpr(f"{word} AS _word", f"{bit} AS bit").groupBy("_word").agg(F.bit_or("bit").alias("_bits"))

    def _place(self, column: str) -> tuple[str, str]:
        return f"int(shiftrightunsigned({column}, {64 - self.bits}))", f"shiftleft(1L, int({column} & 63))"

    def tell(self, rows: DataFrame, column: str) -> DataFrame:
        """Rows with `_in`: false if the key is surely not in the set."""
        word, bit = self._place(column)
        # The bitmap has at most 2^MOST_BITS rows, whatever the data.
        met = rows.selectExpr("*", f"{word} AS _word").join(F.broadcast(self.table), "_word", "left")
        return met.withColumn("_in", F.coalesce(F.expr(f"(_bits & {bit}) <> 0"), F.lit(False))).drop("_word", "_bits")

    def array(self) -> np.ndarray:
        """The bitmap for Python tasks, at most 16 MB: place h >> (64 - bits), bit h & 63 of a key h without sign."""
        found = self.table.toArrow()
        words = np.zeros(1 << self.bits, dtype=np.uint64)
        words[found.column("_word").to_numpy()] = found.column("_bits").to_numpy().view(np.uint64)
        return words


def _hashed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("_h", F.xxhash64(*keys))


def met(rows: DataFrame, keys: list[str], table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without a partner in `table`, as far as the bitmap tells; the others, joined to it from the left).

    `table` is stored and has one row for each key; keys are not null. Only the others are shuffled.
    """
    told = Marks(_hashed(table, keys), "_h").tell(_hashed(rows, keys), "_h").drop("_h")
    return told.where("NOT _in").drop("_in"), told.where("_in").drop("_in").join(table, keys, "left")


def lacking(rows: DataFrame, keys: list[str], gone: DataFrame, name: str) -> DataFrame:
    """The rows whose keys are not in `gone` (stored). Of rows, only their keys are shuffled, and the few whole ones that
    the bitmap takes for members by mistake."""
    told = Marks(_hashed(gone, keys), "_h").tell(_hashed(rows, keys), "_h").drop("_h")
    outside, inside = told.where("NOT _in").drop("_in"), told.where("_in").drop("_in")
    mistaken = stored(inside.select(*keys).join(gone.select(*keys), keys, "left_anti").distinct(), name)
    again = Marks(_hashed(mistaken, keys), "_h").tell(_hashed(inside, keys), "_h").drop("_h").where("_in").drop("_in")
    return outside.unionByName(again.join(mistaken, keys, "left_semi"))
