"""Column builders: ladders, code lookups, guarded ratios and as-of literals. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, time
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(value: Column, rungs: Sequence[tuple], rest, test: Callable[[Column, object], Column]) -> Column:
    """First rung whose ``test(value, bound)`` holds gives the label; anything else, NULL included, gives ``rest``."""
    chain = reduce(
        lambda acc, rung: acc.when(test(value, rung[0]), F.lit(rung[1])),
        rungs[1:],
        F.when(test(value, rungs[0][0]), F.lit(rungs[0][1])),
    )
    return chain.otherwise(F.lit(rest))


def below(value: Column, rungs, rest) -> Column:
    return ladder(value, rungs, rest, lambda v, bound: v < bound)


def at_most(value: Column, rungs, rest) -> Column:
    return ladder(value, rungs, rest, lambda v, bound: v <= bound)


def at_least(value: Column, rungs, rest) -> Column:
    return ladder(value, rungs, rest, lambda v, bound: v >= _exact(bound))


def _exact(bound):
    # A fractional bound against a decimal column is compared as a decimal, so 0.3 means exactly 0.3.
    return F.lit(Decimal(str(bound))) if isinstance(bound, float) else bound


def lookup(value: Column, table: Mapping, rest=None) -> Column:
    """Exact-value lookup; a value outside the table gives ``rest`` (NULL by default)."""
    chain = ladder(value, list(table.items()), rest, lambda v, key: v == F.lit(key))
    return chain


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true (NULL does not count)."""
    return F.count_if(condition)


def share_of_rows(condition: Column) -> Column:
    """Fraction of the group's rows meeting the condition, to two decimals."""
    return F.round(count_where(condition) * F.lit(Decimal("1.0")) / F.nullif(F.count("*"), F.lit(0)), 2)


def mean2(value: Column | str) -> Column:
    return F.round(F.avg(value), 2)


def day(as_of: date) -> Column:
    return F.lit(as_of.isoformat()).cast("date")


def instant(as_of: date | datetime) -> Column:
    if not isinstance(as_of, datetime):
        as_of = datetime.combine(as_of, time())
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def years_before(moment: Column, years: int) -> Column:
    return moment - F.make_ym_interval(F.lit(years), F.lit(0))
