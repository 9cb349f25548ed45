"""How a fleet series is keyed and cut into blocks.

A series row is one unit at one operating cycle, and (unit, cycle) is unique. Cycles are 32-bit
integers, so cutting a unit every ``block_rows`` cycles gives at most ``block_rows`` rows per
(unit, block) and at most 2**31 / block_rows blocks per unit (32,768 by default). Both bounds hold
whatever share of the fleet's rows one unit has; every operator that needs a unit's order works per
block and passes a small carry between blocks, so no task ever receives a whole unit.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "_blk"


@dataclass(frozen=True)
class Layout:
    """Key columns of a series.

    ``contiguous`` states that every unit's cycles are exactly 1..n, so that the cycle is also the
    row position and need not be counted.
    """

    unit: tuple[str, ...] = ("unit_number",)
    cycle: str = "time_cycles"
    contiguous: bool = False
    block_rows: int = 1 << 16

    def with_block(self, df: DataFrame) -> DataFrame:
        """Add the block number of each row, unless the frame already carries it."""
        if BLOCK in df.columns:
            return df
        return df.withColumn(BLOCK, self.block_of(F.col(self.cycle)))

    def block_of(self, cycle: Column) -> Column:
        return F.floor(cycle / F.lit(self.block_rows)).cast("int")

    @property
    def block_keys(self) -> list[str]:
        return [*self.unit, BLOCK]

    def but(self, **changes) -> "Layout":
        return replace(self, **changes)


CONTIGUOUS = Layout(contiguous=True)
