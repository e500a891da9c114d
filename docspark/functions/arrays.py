"""Array helpers for per-row work in time linear in the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often it is used:
    inside other lambdas a plain expression would be evaluated again per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prefix_sums(sizes: Column, block: int = 256) -> Column:
    """Exclusive running sums of an int array: sums of whole blocks, then the rest of
    the own block, so n elements cost about n * (block + n / block) additions."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    n_blocks = F.floor((F.size(sizes) + (block - 1)) / block).cast("int")
    blocks = F.when(n_blocks > 0, F.transform(
        F.sequence(F.lit(0), n_blocks - 1), lambda k: total(F.slice(sizes, k * block + 1, block))))

    def at(sums: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda k: total(F.slice(sums, 1, k)))
        return bind(before, lambda b: F.transform(sizes, lambda x, p: F.get(b, F.floor(p / block).cast("int")) + total(
            F.slice(sizes, F.floor(p / block).cast("int") * block + 1, p % block))))

    return F.when(n_blocks > 0, bind(blocks, at)).otherwise(F.array().cast("array<int>"))
