"""Array functions as Column expressions that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rounds of running_sum, each of which reaches four times as far: over any pieces of a string, which has under 2**31 bytes.
ROUNDS = 14


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def running_sum(numbers: Column) -> Column:
    """The sum of each element and all before it. A fold would copy the sums for each element; here each round adds, to the
    sum of the elements up to a place, those of three stretches before, and so knows four times as many."""

    def widened(step: int) -> Callable[[Column], Column]:
        def of(sums: Column) -> Column:
            def more(x: Column, i: Column) -> Column:
                for k in (1, 2, 3):
                    x = x + F.coalesce(F.when(i >= k * step, F.get(sums, i - k * step)), F.lit(0))
                return x

            return F.when(F.size(sums) > step, F.transform(sums, more)).otherwise(sums)

        return of

    for k in range(ROUNDS):
        numbers = let(numbers, widened(4**k))
    return numbers
