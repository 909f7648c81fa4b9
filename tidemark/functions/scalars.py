"""Scalar helpers (F1-F22) built only from JVM-side ``pyspark.sql.functions``.

Each helper returns a Column so it stays inside whole-stage codegen.  The
number rules keep results independent of task order and of the engine that
checks them:

* ``round_half_up`` rounds the scaled double with plain IEEE steps, so the
  DuckDB oracle can use the identical formula.
* money has a declared scale of ``MONEY_DECIMALS``: amounts become whole units
  of that scale, are summed exactly and divided back.  An amount that does not
  fit the scale raises; nothing is rounded away.
* fractions (probabilities) are summed as decimals of 18 places, so a mean
  does not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four ASCII whitespace characters the warehouse trim removes
# (space, tab, newline, carriage return).
WHITESPACE = " \t\n\r"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """``lower(trim(x))``; null stays null."""
    return F.lower(F.btrim(col_(c), F.lit(WHITESPACE)))


def round_half_up(c, n: int) -> Column:
    """round half away from zero to ``n`` decimals."""
    x = col_(c).cast("double")
    scale = float(10 ** n)
    return F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale) * F.signum(x)


def round_half_even(c, n: int) -> Column:
    """numpy-style half-to-even rounding of a probability."""
    return F.bround(col_(c).cast("double"), n)


def safe_divide(a, b) -> Column:
    """null when the divisor is 0 (or null)."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


def ratio_pct(num, den, n: int = 2) -> Column:
    """A10: ``round(num / den * 100, n)`` with a non-zero denominator."""
    return round_half_up(col_(num).cast("double") / col_(den).cast("double") * F.lit(100.0), n)


MONEY_DECIMALS = 6
_UNIT = float(10 ** MONEY_DECIMALS)
# Whole numbers above this are not all representable as a double.
_EXACT = float(2 ** 53)


def money_units(c) -> Column:
    """Money value as whole units of the declared scale; raises if it does not fit (NaN, infinite, finer, huge)."""
    x = col_(c).cast("double")
    units = F.round(x * F.lit(_UNIT))
    fits = ~F.isnan(x) & (F.abs(units) <= F.lit(_EXACT)) & (units / F.lit(_UNIT) == x)
    return (F.when(x.isNull(), F.lit(None).cast("long"))
            .when(fits, units.cast("long"))
            .otherwise(F.raise_error(F.concat(F.lit(f"amount does not fit {MONEY_DECIMALS} decimals: "),
                                              x.cast("string"))).cast("long")))


def unit_sum(units: Column) -> Column:
    """Aggregate: exact sum of money units (room for any number of rows)."""
    return F.sum(units.cast("decimal(19,0)"))


def from_units(total: Column) -> Column:
    """A sum of money units as a double."""
    return total.cast("double") / F.lit(_UNIT)


def mean_from_units(total: Column, n: Column) -> Column:
    """A sum of money units over a count, as a double (null for a count of 0)."""
    return F.try_divide(total.cast("double"), n) / F.lit(_UNIT)


def money_sum(c) -> Column:
    """Aggregate: exact sum of a money column, as double."""
    return from_units(unit_sum(money_units(c)))


def money_avg(c) -> Column:
    """Aggregate: mean of a money column (null for no rows)."""
    return mean_from_units(unit_sum(money_units(c)), F.count(col_(c)))


def exact_avg(c) -> Column:
    """Aggregate: order-independent mean of a fraction-valued column (null for no rows)."""
    return F.try_divide(F.sum(col_(c).cast("double").cast("decimal(28,18)")).cast("double"), F.count(col_(c)))


def count_if(cond: Column) -> Column:
    """Count rows where the condition is true; null is not counted."""
    return F.count_if(cond)


def cond_money_sum(cond: Column, amount) -> Column:
    """``sum(case when cond then x else 0 end)`` over money, exact."""
    return from_units(unit_sum(F.when(cond, money_units(amount)).otherwise(F.lit(0).cast("long"))))


def str_category(c) -> Column:
    """pandas ``astype(str)``: null becomes the category ``None``."""
    return F.coalesce(col_(c).cast("string"), F.lit("None"))


def elapsed_days(start, end) -> Column:
    """whole elapsed 24-hour days from ``start`` to ``end``, floored."""
    micros = F.timestamp_diff("MICROSECOND", col_(start), col_(end))
    return F.floor(micros.cast("double") / F.lit(86400e6)).cast("long")


def ts_literal(value: str) -> Column:
    """A wall-clock timestamp literal (no zone), e.g. ``as_of``."""
    return F.lit(value).cast("timestamp_ntz")
