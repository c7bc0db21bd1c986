"""Hashes as plain 64-bit integer arithmetic, so that any SQL engine gives the same numbers.

Products stay below 2**63: both factors have at most 32 and 31 bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = (1 << 32) - 1
# Odd multipliers of the two mixing steps.
MULTIPLIERS = (1103515245, 1566083941)


def mixed32(value: Column, key: int) -> Column:
    """32 well spread bits of a 64-bit integer and a key."""
    h = (value.bitwiseXOR(F.shiftrightunsigned(value, 32)) + F.lit(key)).bitwiseAND(F.lit(MASK))
    for multiplier in MULTIPLIERS:
        h = (h * F.lit(multiplier)).bitwiseAND(F.lit(MASK))
        h = h.bitwiseXOR(F.shiftright(h, 15))
    return h


def mixed32_py(value: int, key: int) -> int:
    value &= (1 << 64) - 1
    h = ((value ^ (value >> 32)) + key) & MASK
    for multiplier in MULTIPLIERS:
        h = (h * multiplier) & MASK
        h ^= h >> 15
    return h


def mixed32_sql(value: str, key: int) -> str:
    """The same in DuckDB for a value that isn't negative."""
    h = f"((xor({value}, ({value}) >> 32) + {key}) & {MASK})"
    for multiplier in MULTIPLIERS:
        product = f"(({h} * {multiplier}) & {MASK})"
        h = f"xor({product}, {product} >> 15)"
    return h


def keys(seed: int, n: int) -> list[int]:
    """``n`` round keys from a seed."""
    return [mixed32_py(seed * 2654435761 + i + 1, 97 * i + 13) for i in range(n)]
