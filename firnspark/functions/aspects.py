"""Circular aspect geometry.

Eight aspects make an 8-bit mask, bit i being the i-th aspect clockwise from
north.  There are only 256 masks, so the components of the largest run of set
bits are a constant table and each row costs one array access per component.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, functions as F

ASPECTS = ("n", "ne", "e", "se", "s", "sw", "w", "nw")
ELEVATIONS = ("alp", "tln", "btl")
SLOTS = (0, 1, 2)
COMPONENTS = ("sin", "cos", "range")

FLAG_NAMES = [f"{aspect}_{elevation}" for aspect in ASPECTS for elevation in ELEVATIONS]
COMPONENT_COLUMNS = [
    f"aspect_{component}_{elevation}_{slot}"
    for slot in SLOTS
    for elevation in ELEVATIONS
    for component in COMPONENTS
]


def largest_run(mask: int) -> tuple[int, int]:
    """(first aspect, length) of the longest circular run of set bits.

    Among equal runs the first one met clockwise from north wins; a run that
    covers north is met first, wherever it begins.
    """
    ring = mask | mask << 8 | mask << 16
    best = (0, 0)
    best_rank = (0, 0)
    for first in range(8):
        if not mask >> first & 1 or mask >> (first - 1) % 8 & 1:
            continue
        length = next(step for step in range(1, 9) if not ring >> (first + step) & 1)
        rank = (length, 0 if first + length > 8 else -first)
        if best[1] == 0 or rank > best_rank:
            best, best_rank = (first, length), rank
    return best


@cache
def component_table() -> dict[str, list[float]]:
    """The three components of every mask, rounded to 12 places."""
    table: dict[str, list[float]] = {name: [] for name in COMPONENTS}
    for mask in range(256):
        if mask in (0, 255):
            values = (0.0, 0.0, 1.0 if mask else 0.0)
        else:
            first, length = largest_run(mask)
            angle = (first + (length - 1) / 2) * math.pi / 4
            values = (round(math.sin(angle), 12) + 0.0, round(math.cos(angle), 12) + 0.0, length / 8)
        for name, value in zip(COMPONENTS, values):
            table[name].append(value)
    return table


def component_sql(component: str, mask: str) -> str:
    """SQL for a component of a mask expression.

    The table is written as one constant text, which the optimizer folds into an array
    literal; wide plans are built from SQL text because each Column call costs a round
    trip to the JVM.
    """
    values = ",".join(repr(value) for value in component_table()[component])
    return f"get(cast(split('{values}', ',') AS array<double>), cast({mask} AS int))"


def flag(value: Column) -> Column:
    """0/1 flag of a number; missing and NaN count as unset."""
    return F.when(F.nanvl(value.cast("double"), F.lit(0.0)) != 0, 1).otherwise(0)


def mask_sql(flags: list[str]) -> str:
    """Eight 0/1 columns, clockwise from north, as one mask."""
    return " + ".join(f"if({name} <> 0, {1 << position}, 0)" for position, name in enumerate(flags))


def aspect_components(flags: list[str]) -> dict[str, Column]:
    """The three components of eight flag columns."""
    return {name: F.expr(component_sql(name, f"({mask_sql(flags)})")) for name in COMPONENTS}


def slot_bits(slot: int) -> Column:
    """The 24 flag columns of a slot packed into one integer, elevation by elevation."""
    return F.expr(mask_sql([f"{aspect}_{elevation}_{slot}" for elevation in ELEVATIONS for aspect in ASPECTS]))


def flag_of_bits_sql(slot: int, aspect: str, elevation: str) -> str:
    position = 8 * ELEVATIONS.index(elevation) + ASPECTS.index(aspect)
    return f"cast(shiftright(_bits_{slot}, {position}) & 1 AS bigint)"


def mask_of_bits_sql(slot: int, elevation: str) -> str:
    return f"(shiftright(_bits_{slot}, {8 * ELEVATIONS.index(elevation)}) & 255)"
