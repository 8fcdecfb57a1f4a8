"""A set of hashes as bits of a fixed number: it lets all members pass, and few others while it is sparse."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class HashFilter:
    """One bit per range of 64-bit hashes; 2 ** `bits` of them, whatever the number of members."""

    def __init__(self, bits: int):
        self.bits = bits
        self.data = np.zeros(1 << bits - 3, np.uint8)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def add(self, members: DataFrame, column: str) -> None:
        """Add the hashes in a long column; no more rows than the filter has bytes come to the driver."""
        at = f"shiftrightunsigned({column}, {64 - self.bits})"
        found = (
            members.groupBy(F.expr(f"shiftrightunsigned({at}, 3)").alias("at"))
            .agg(F.bit_or(F.expr(f"shiftleft(1, cast({at} & 7 as int))")).alias("held"))
            .toArrow()
        )
        self.data[found.column("at").to_numpy()] |= found.column("held").to_numpy().astype(np.uint8)
