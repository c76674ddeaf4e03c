"""Shuffle of a stream: a buffer of bounded size that every row passes through.

The first rows fill the places of the buffer.  Every later row draws a place by the hash of seed and
position, goes there, and the row that was in it goes on.  So the row of a place is followed by the
next row that draws the same place, and leaves at the position of that one: a window per place, not
a loop over rows.  Places are drawn evenly, so the windows are of like size whatever the rows hold.

The order depends on seed, buffer and positions alone, not on micro-batches.  Rows that nothing
follows are what the buffer holds: one per place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.frame import HASH, HIDDEN, POS, Frame, Key, quoted
from rowloom.plans.order import HASH_BITS, number

PLACE, FREED = HIDDEN + "place", HIDDEN + "freed"


@dataclass(frozen=True)
class Mixer:
    seed: int
    places: int

    def entered(self, frame: Frame, seen: int = 0, start: int = 0) -> DataFrame:
        """Rows with their position in the stream and their place; ``seen`` rows came before, the buffer began at ``start``."""
        numbered = number(frame)
        rows = numbered.df.select(*[quoted(c) for c in frame.columns], (F.col(POS) + F.lit(seen)).alias(POS))
        code = F.xxhash64(F.lit(self.seed).cast("bigint"), POS)
        hashed = rows.withColumn(HASH, F.shiftrightunsigned(code, 64 - HASH_BITS))
        filling = F.col(POS) - F.lit(start)
        drawn = F.col(HASH) % F.lit(self.places)
        return hashed.withColumn(PLACE, F.when(filling < self.places, filling).otherwise(drawn))

    def freed(self, entered: DataFrame) -> DataFrame:
        """The position at which a row leaves the buffer; null while it is in there."""
        following = F.lead(POS).over(Window.partitionBy(PLACE).orderBy(POS))
        return entered.withColumn(FREED, following)

    def released(self, freed: DataFrame) -> Frame:
        """Rows that have left the buffer."""
        gone = freed.filter(F.col(FREED).isNotNull()).drop(POS, HASH, PLACE)
        return Frame(gone.withColumnRenamed(FREED, POS), (Key(POS),), "position")

    def held(self, freed: DataFrame) -> DataFrame:
        """Rows in the buffer."""
        return freed.filter(F.col(FREED).isNull()).drop(FREED)

    def emptied(self, held: DataFrame) -> Frame:
        """The rows of the buffer at the end, in the order of their hashes."""
        return Frame(held.drop(PLACE), (Key(HASH), Key(POS)), "hash")

    def mixed(self, frame: Frame) -> Frame:
        """All rows of a loaded frame in the order in which a stream of them gives them."""
        freed = self.freed(self.entered(frame)).drop(PLACE)
        return frame.rebuilt(freed, order=(Key(FREED), Key(HASH), Key(POS)), kind="sorted", whole=False, dense_from=None)
