"""A cheap 32-bit hash that is the same in every layout, and in any SQL engine for integer keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = 1 << 32
MULTIPLIERS = (1103515245, 1566083941)


def mixed(value: Column) -> Column:
    """Fold 64 bits into 32 and mix them. Products have 63 bits at most, so nothing overflows."""
    mask = F.lit(RANGE - 1)
    h = value.bitwiseXOR(F.shiftrightunsigned(value, 32)).bitwiseAND(mask)
    for multiplier in MULTIPLIERS:
        h = (h * F.lit(multiplier)).bitwiseAND(mask)
        h = h.bitwiseXOR(F.shiftright(h, 15))
    return h


def key_hash(rows: DataFrame, key: Sequence[str]) -> Column:
    """0 to 2**32 - 1: arithmetic for one integer column, ``xxhash64`` for text and several columns."""
    kinds = [rows.schema[name].dataType for name in key]
    if len(key) == 1 and isinstance(kinds[0], T.IntegralType):
        return mixed(F.coalesce(F.col(key[0]).cast("bigint"), F.lit(-1).cast("bigint")))
    return F.shiftrightunsigned(F.xxhash64(*key), 32)
