"""Ordered multi-branch choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def choose(
    conditions: Sequence[Column], values: Sequence[str], default: str | None = "0"
) -> Column:
    """First condition that holds picks its value.

    A NULL condition does not hold. Rows no branch takes get the string '0', or
    NULL with `default=None`.
    """
    pairs = list(zip(conditions, values, strict=True))
    out = F.when(pairs[0][0], F.lit(pairs[0][1]))
    for condition, value in pairs[1:]:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(default))
