"""Sets of hashed identities as bitmaps: bounded, mergeable, and sure about what they do not hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

#: Slots of a set. A row of its table holds 32,768 of them in 4 KB, so a full set is 512 rows.
SLOTS = 1 << 24


def slot(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)) + 1


def has_bit(bitmap: Column, at: Column) -> Column:
    """Whether a slot is set in the bitmap of its bucket; a missing bitmap holds nothing."""
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
